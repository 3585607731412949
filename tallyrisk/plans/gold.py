"""Feature tables and labels over the silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.functions.events import (
    amount_features,
    amount_zscore_given,
    temporal_features,
    velocity_spike,
    weekend,
)
from tallyrisk.operators.cleaning import entity_means, mean_ratio, new_pair_flag
from tallyrisk.operators.reports import amount_zscore
from tallyrisk.operators.rolling import DAY_S, HOUR_S, SECOND, Rolling, rolling, rolling_by_second, velocity

CUSTOMER_ROLLING = [
    *[Rolling(f"tx_count_{d}d", "count", d * DAY_S) for d in (1, 7, 30)],
    *[Rolling(f"tx_amount_sum_{d}d", "sum", d * DAY_S, "amount_usd") for d in (1, 7, 30)],
    Rolling("tx_amount_mean_7d", "mean", 7 * DAY_S, "amount_usd"),
    Rolling("tx_amount_std_7d", "std", 7 * DAY_S, "amount_usd"),
    Rolling("unique_merchants_7d", "distinct", 7 * DAY_S, "merchant_id"),
    Rolling("fraud_rate_30d", "mean", 30 * DAY_S, "is_fraud"),
    Rolling("avg_tx_hour_7d", "mean", 7 * DAY_S, "_hour"),
    Rolling("weekend_ratio_7d", "mean", 7 * DAY_S, "_weekend"),
]

MERCHANT_ROLLING = [
    Rolling("tx_count_1d", "count", DAY_S),
    Rolling("tx_count_7d", "count", 7 * DAY_S),
    Rolling("fraud_count_30d", "sum", 30 * DAY_S, "is_fraud"),
    Rolling("fraud_rate_30d", "mean", 30 * DAY_S, "is_fraud"),
    Rolling("avg_amount_7d", "mean", 7 * DAY_S, "amount_usd"),
    Rolling("unique_customers_7d", "distinct", 7 * DAY_S, "customer_id"),
]


def with_time_profile(df: DataFrame, ts: str = "transaction_ts") -> DataFrame:
    """Hour and weekend flag as rolling inputs."""
    return df.withColumns({"_hour": F.hour(ts), "_weekend": weekend(F.col(ts))})


def _collapse(per_second: DataFrame, entity: str, peaks: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """One row per entity: peak of the counts, other values as of the newest second.

    All rows of one entity and second share their values, so the newest second
    is the newest row.
    """
    newest = F.max_by(F.struct(*latest), F.coalesce(F.col(SECOND), F.lit(-(2**62)).cast("long")))
    return (
        per_second.groupBy(entity)
        .agg(*[F.max(c).alias(c) for c in peaks], newest.alias("_newest"))
        .select(entity, *peaks, *[F.col("_newest")[c].alias(c) for c in latest])
    )


def customer_features(silver: DataFrame, as_of: Column, include_current: bool = True) -> DataFrame:
    """One row per customer: peak counts, and sums, means, rates as of the last event."""
    df = with_time_profile(silver.filter(F.col("customer_id").isNotNull()))
    per_second = rolling_by_second(df, "customer_id", "transaction_ts", CUSTOMER_ROLLING, include_current)
    names = [r.name for r in CUSTOMER_ROLLING]
    return _collapse(per_second, "customer_id", names[:3], names[3:]).withColumn("feature_date", as_of)


def merchant_features(silver: DataFrame, as_of: Column, include_current: bool = True) -> DataFrame:
    """One row per merchant: peak counts, and the rest as of the last event."""
    df = silver.filter(F.col("merchant_id").isNotNull())
    per_second = rolling_by_second(df, "merchant_id", "transaction_ts", MERCHANT_ROLLING, include_current)
    names = [r.name for r in MERCHANT_ROLLING]
    return _collapse(per_second, "merchant_id", names[:2], names[2:]).withColumn("feature_date", as_of)


def risk_flags(
    df: DataFrame,
    history: DataFrame | None = None,
    threshold: int = 5,
    count_col: str = "customer_tx_count_1h",
) -> DataFrame:
    """Velocity spike and new-merchant flags."""
    return new_pair_flag(velocity_spike(df, threshold, count_col), history)


def batch_transforms(
    df: DataFrame,
    entity_col: str = "customer_id",
    ts_col: str = "transaction_ts",
    amount_col: str = "amount_usd",
    history: DataFrame | None = None,
    hours: Sequence[int] = (1, 6, 24),
    per_entity: DataFrame | None = None,
) -> DataFrame:
    """Temporal, amount, z-score, velocity (if the entity column exists) and risk flags."""
    out = amount_features(temporal_features(df, ts_col), amount_col)
    out = amount_zscore(out, amount_col)
    if entity_col in df.columns:
        out = velocity(out, entity_col, ts_col, amount_col, hours, per_entity=per_entity)
    return risk_flags(out, history)


def stream_transforms(
    df: DataFrame,
    mean: float | Column = 100.0,
    std: float | Column = 200.0,
    ts_col: str = "transaction_ts",
    amount_col: str = "amount_usd",
    history: DataFrame | None = None,
) -> DataFrame:
    """The same features without any aggregation: given statistics, and counts of 0 unless present."""
    out = amount_features(temporal_features(df, ts_col), amount_col)
    out = amount_zscore_given(out, mean, std, amount_col)
    for h in (1, 6, 24):
        if f"customer_tx_count_{h}h" not in out.columns:
            out = out.withColumn(f"customer_tx_count_{h}h", F.lit(0).cast("long"))
    return risk_flags(out, history)


TRANSACTION_INPUTS = ["transaction_id", "customer_id", "merchant_id", "transaction_ts", "amount_usd", "is_fraud"]


def transaction_features(
    silver: DataFrame, as_of: Column, history: DataFrame | None = None
) -> DataFrame:
    """One row per transaction: all batch transforms and the ratio to the customer's mean."""
    df = batch_transforms(silver.select(*TRANSACTION_INPUTS), history=history, per_entity=entity_means(silver))
    return df.withColumns({"amount_vs_customer_mean_ratio": mean_ratio(), "feature_date": as_of}).drop("_entity_mean")


def fraud_labels(silver: DataFrame, as_of: Column) -> DataFrame:
    """Labelled rows only."""
    return silver.filter(F.col("is_fraud").isNotNull()).select(
        "transaction_id", "customer_id", "transaction_ts", "is_fraud", "data_source", as_of.alias("label_ts")
    )


#: Rolling inputs of the model vector: velocity windows and the customer's label rate.
MODEL_ROLLING = [
    *[Rolling(f"customer_tx_count_{h}h", "count", h * HOUR_S) for h in (1, 6, 24)],
    Rolling("customer_tx_count_7d", "count", 7 * DAY_S),
    Rolling("fraud_rate_30d", "mean", 30 * DAY_S, "is_fraud"),
]


def model_inputs(
    silver: DataFrame, include_current: bool = True, mean_history: DataFrame | None = None
) -> DataFrame:
    """Every transaction with all 14 model features (null labels kept).

    ``include_current=False`` keeps a row's own second, and so its own label,
    out of the rolling features; ``mean_history`` limits the customer means.
    """
    df = amount_zscore(amount_features(temporal_features(silver.select(*TRANSACTION_INPUTS))))
    means = entity_means(silver if mean_history is None else mean_history)
    df = rolling(df, "customer_id", "transaction_ts", MODEL_ROLLING, include_current, means)
    return velocity_spike(df).withColumn("amount_vs_mean_ratio", mean_ratio()).drop("_entity_mean")
