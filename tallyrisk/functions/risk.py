"""Risk levels, reasons and rule-based texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds and texts of the scorer.
FLAG_ABOVE = 0.3
ALERT_ABOVE = 0.5
LEVELS = [(0.3, "low"), (0.6, "medium"), (0.85, "high")]
TOP_LEVEL = "critical"
NO_SIGNAL = "No single dominant signal — ensemble of weak indicators"
SIGNALS = {
    "velocity": "1. VELOCITY SPIKE — {} txns in 1 hour",
    "amount": "2. UNUSUAL AMOUNT — {} standard deviations",
    "night": "3. NIGHT-TIME TRANSACTION — unusual hours increase fraud risk",
    "customer": "4. HIGH-RISK CUSTOMER — {} fraud rate in last 30 days",
    "round": "5. ROUND AMOUNT — often used in card testing attacks",
    "spike": "6. AMOUNT SPIKE — {}x above customer average",
}
HOLD = "Hold for manual review"
FALLBACK_MODEL = "rule-based-fallback"

# What a missing feature counts as.
MISSING = {"amount_vs_mean_ratio": 1.0}


def _feature(df: DataFrame, name: str) -> Column:
    """The feature as double; null, NaN or absent becomes its default."""
    default = F.lit(MISSING.get(name, 0.0))
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(None)), default) if name in df.columns else default


def fixed(value: Column, digits: int) -> Column:
    """A number with a fixed number of decimals, rounded half up first."""
    return F.format_string(f"%.{digits}f", F.round(value, digits))


def _percent(value: Column) -> Column:
    return F.concat(fixed(value * 100, 1), F.lit("%"))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _filled(template: str, value: Column) -> Column:
    """A fixed text with the value in its place."""
    return _text(*[part for pair in zip(template.split("{}"), [value, ""]) for part in pair])


def risk_level(score: Column) -> Column:
    """low below 0.3, medium below 0.6, high below 0.85, else critical."""
    out = F.when(score < LEVELS[0][0], LEVELS[0][1])
    for bound, name in LEVELS[1:]:
        out = out.when(score < bound, name)
    return out.when(score.isNotNull(), TOP_LEVEL)


def risk_factors_a(df: DataFrame, score_col: str = "score", k: int = 3) -> DataFrame:
    """The first ``k`` scorer reasons of each row as ``top_risk_factors``."""
    f = lambda name: _feature(df, name)
    per_hour = f("customer_tx_count_1h").cast("int").cast("string")
    zscore = f("amount_zscore")
    reasons = F.array_compact(
        F.array(
            F.when(
                f("is_velocity_spike") != 0, _text("High transaction velocity (", per_hour, " tx in 1h)")
            ).when(
                f("customer_tx_count_1h") >= 5, _text("Elevated 1h velocity (", per_hour, " tx in 1h)")
            ),
            F.when(
                f("is_night") != 0,
                _text("Night-time transaction (", F.format_string("%02d", f("hour_of_day").cast("int")), ":00h)"),
            ),
            F.when(
                f("is_round_amount") != 0,
                _text("Round amount ($", fixed(F.expm1(f("amount_log1p")), 2), ")"),
            ),
            F.when(
                f("amount_vs_mean_ratio") >= 2.0,
                _text("Amount ", fixed(f("amount_vs_mean_ratio"), 1), "x above baseline"),
            ),
            F.when(
                f("fraud_rate_30d") > 0.05,
                _text("High historical fraud rate (", _percent(f("fraud_rate_30d")), " over 30d)"),
            ),
            F.when(F.abs(zscore) > 2.5, _text("Unusual amount (z-score=", fixed(zscore, 1), ")")),
        )
    )
    fallback = F.array(_text("Anomalous feature combination (score=", fixed(F.col(score_col), 2), ")"))
    return df.withColumn("_reasons", reasons).withColumn(
        "top_risk_factors", F.when(F.size("_reasons") > 0, F.slice("_reasons", 1, k)).otherwise(fallback)
    ).drop("_reasons")


def risk_factors_b(df: DataFrame) -> DataFrame:
    """The numbered analyst signals: ``signals`` (text) and ``risk_factors`` (without numbers)."""
    f = lambda name: _feature(df, name)
    zscore = f("amount_zscore")
    signed = F.concat(F.when(F.round(zscore, 1) >= 0, "+").otherwise(""), fixed(zscore, 1))
    signals = F.array_compact(
        F.array(
            F.when(
                f("is_velocity_spike") != 0,
                _filled(SIGNALS["velocity"], f("customer_tx_count_1h").cast("int").cast("string")),
            ),
            F.when(F.abs(zscore) > 2, _filled(SIGNALS["amount"], signed)),
            F.when(f("is_night") != 0, F.lit(SIGNALS["night"])),
            F.when(
                f("fraud_rate_30d") > 0.05,
                _filled(SIGNALS["customer"], _percent(f("fraud_rate_30d"))),
            ),
            F.when(f("is_round_amount") != 0, F.lit(SIGNALS["round"])),
            F.when(
                f("amount_vs_mean_ratio") > 3,
                _filled(SIGNALS["spike"], fixed(f("amount_vs_mean_ratio"), 1)),
            ),
        )
    )
    return (
        df.withColumn("_signals", signals)
        .withColumn("_signals", F.when(F.size("_signals") > 0, F.col("_signals")).otherwise(F.array(F.lit(NO_SIGNAL))))
        .withColumn("signals", F.concat_ws("\n", "_signals"))
        .withColumn("risk_factors", F.transform("_signals", lambda s: F.regexp_replace(s, r"^[0-9. ]+", "")))
        .drop("_signals")
    )


def rule_explanation(df: DataFrame, score_col: str = "score") -> DataFrame:
    """One sentence from the score and the first two reasons (needs ``top_risk_factors``)."""
    score = F.col(score_col)
    level = F.when(score > ALERT_ABOVE, "high risk").otherwise("elevated risk")
    return df.withColumn(
        "explanation",
        _text(
            "Transaction flagged as ", level, " (score=", fixed(score, 2), "). Key signals: ",
            F.concat_ws("; ", F.slice("top_risk_factors", 1, 2)), ".",
        ),
    )


def fallback_record(df: DataFrame, score_col: str = "score") -> DataFrame:
    """The record written when no remote explanation exists (needs ``risk_factors``)."""
    score = F.col(score_col)
    return df.withColumns(
        {
            "fraud_score": F.round(score, 4),
            "summary": _text("Transaction flagged at ", _percent(score), " confidence. Manual review required."),
            "recommended_action": F.lit(HOLD),
            "model": F.lit(FALLBACK_MODEL),
        }
    )


def explain_labels(df: DataFrame) -> DataFrame:
    """Readable labels of the flags, and the amount recovered from its logarithm."""
    on = lambda name: _feature(df, name) != 0
    log_amount = _feature(df, "amount_log1p")
    return df.withColumns(
        {
            "night_label": F.when(on("is_night"), "(night-time)").otherwise("(daytime)"),
            "day_label": F.when(on("is_weekend"), "Weekend").otherwise("Weekday"),
            "round_amount_label": F.when(on("is_round_amount"), "Yes (common in fraud testing)").otherwise("No"),
            "velocity_label": F.when(on("is_velocity_spike"), "YES — unusual burst").otherwise("No"),
            "amount": F.when(log_amount > 0, F.round(F.exp(log_amount) - 1, 2)).otherwise(F.lit(0.0)),
        }
    )
