"""Row validation with quarantine, null rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Required columns of a stream event and of a scoring row, channel names.
REQUIRED = ["transaction_id", "customer_id", "merchant_id", "amount", "transaction_ts", "producer_ts"]
SCORE_REQUIRED = ["amount", "hour_of_day", "day_of_week", "is_weekend", "is_night", "is_round_amount"]
CHANNELS = ["web", "mobile", "pos", "atm", "transfer", "other"]


def required(*columns: str) -> dict[str, Column]:
    return {f"{c} missing": F.col(c).isNull() for c in columns}


def event_rules() -> dict[str, Column]:
    """What makes a stream event bad, by reason."""
    return {
        **required(*REQUIRED),
        "amount negative": F.col("amount") < 0,
        "channel unknown": ~F.col("channel").isin(CHANNELS),
    }


def score_request_rules() -> dict[str, Column]:
    """What makes a scoring row bad, by reason (weekday is 1..7); NaN is not a positive amount."""
    rules = {
        **required(*SCORE_REQUIRED),
        "amount not positive": ~((F.col("amount") > 0) & ~F.isnan("amount")),
        "hour out of range": ~F.col("hour_of_day").between(0, 23),
        "weekday out of range": ~F.col("day_of_week").between(1, 7),
    }
    for name in ("is_weekend", "is_night", "is_round_amount"):
        rules[f"{name} not a flag"] = ~F.col(name).isin(0, 1)
    return rules


def check_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Column ``reasons``: the names of the broken rules, in rule order."""
    broken = [F.when(cond, F.lit(name)) for name, cond in rules.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*broken)))


def validate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and quarantined rows with their reasons."""
    checked = check_rows(df, rules)
    return (
        checked.filter(F.size("reasons") == 0).drop("reasons"),
        checked.filter(F.size("reasons") > 0),
    )


def quarantine_counts(quarantined: DataFrame) -> DataFrame:
    """Rows per reason."""
    return quarantined.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n")
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``column``, ``null_rate``.  One pass over the data."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "null_rate")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, high: float = 0.5) -> DataFrame:
    """Null rates, highest first, with the number of columns above ``high`` and the median rate.

    The profile has one row per column of the table, whatever the table's size.
    """
    rates = null_rates(df, columns)
    summary = rates.agg(
        F.struct(
            F.count_if(F.col("null_rate") > high).alias("high_null_columns"),
            F.median("null_rate").alias("median_null_rate"),
        )
    )
    return (
        rates.withColumn("_s", summary.scalar())
        .select("column", "null_rate", "_s.high_null_columns", "_s.median_null_rate")
        .orderBy(F.col("null_rate").desc(), "column")
    )
