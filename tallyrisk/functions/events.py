"""Per-event features.  Pure projections: the same code runs in batch and in a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Amount bucket upper bounds and names.
AMOUNT_BUCKETS = [(10, "0-10"), (100, "10-100"), (1000, "100-1000")]
LAST_AMOUNT_BUCKET = "1000+"

# Transfer type to channel.
CHANNEL_OF_TYPE = {
    "PAYMENT": "pos",
    "DEBIT": "pos",
    "TRANSFER": "transfer",
    "CASH_OUT": "atm",
    "CASH_IN": "atm",
}


def flag(condition: Column) -> Column:
    """1 where the condition is true, else 0 (also for null)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def weekend(ts: Column) -> Column:
    return flag(F.dayofweek(ts).isin(1, 7))


def map_category(col: Column, mapping: dict[str, str], default: str) -> Column:
    """Map category values; everything else (also null) becomes the default."""
    by_target: dict[str, list[str]] = {}
    for value, target in mapping.items():
        by_target.setdefault(target, []).append(value)
    (first, values), *rest = by_target.items()
    out = F.when(col.isin(values), F.lit(first))
    for target, values in rest:
        out = out.when(col.isin(values), F.lit(target))
    return out.otherwise(F.lit(default))


def temporal_features(df: DataFrame, ts_col: str = "transaction_ts") -> DataFrame:
    """Hour 0-23, weekday 1-7 (Sunday 1), weekend and night (22 to 5 o'clock) flags."""
    ts = F.col(ts_col)
    return df.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
            "is_weekend": weekend(ts),
            "is_night": flag((F.hour(ts) >= 22) | (F.hour(ts) < 6)),
        }
    )


def amount_features(df: DataFrame, amount_col: str = "amount_usd") -> DataFrame:
    """log1p of the non-negative amount, amount bucket, multiple-of-100 flag.

    A null amount gives log1p 0, bucket "1000+" and a null round flag.
    """
    amount = F.col(amount_col)
    bucket = F.when(amount <= AMOUNT_BUCKETS[0][0], AMOUNT_BUCKETS[0][1])
    for bound, name in AMOUNT_BUCKETS[1:]:
        bucket = bucket.when(amount <= bound, name)
    return df.withColumns(
        {
            "amount_log1p": F.log1p(F.greatest(amount, F.lit(0.0))),
            "amount_bucket": bucket.otherwise(LAST_AMOUNT_BUCKET),
            "is_round_amount": (amount % 100 == 0).cast("int"),
        }
    )


def amount_zscore_given(
    df: DataFrame, mean: float | Column, std: float | Column, amount_col: str = "amount_usd"
) -> DataFrame:
    """Z-score from given statistics; the deviation is at least 1e-6."""
    mean = mean if isinstance(mean, Column) else F.lit(float(mean))
    std = std if isinstance(std, Column) else F.lit(float(std))
    return df.withColumn("amount_zscore", (F.col(amount_col) - mean) / F.greatest(std, F.lit(1e-6)))


def velocity_spike(df: DataFrame, threshold: int = 5, count_col: str = "customer_tx_count_1h") -> DataFrame:
    """Spike flag: count above the threshold; 0 without the count column or its value."""
    spike = flag(F.col(count_col) > threshold) if count_col in df.columns else F.lit(0)
    return df.withColumn("is_velocity_spike", spike)
