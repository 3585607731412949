"""Run metrics: what a job measured against its targets, as table rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.schemas import JOB_METRICS


def metric_rows(
    spark: SparkSession,
    job: str,
    measured: Mapping[str, float | None],
    targets: Mapping[str, tuple[str, float]],
    recorded_at: object,
) -> DataFrame:
    """One row per metric; a target is ("min" or "max", value)."""
    rows = []
    for name, value in measured.items():
        direction, target = targets.get(name, (None, None))
        rows.append((job, name, None if value is None else float(value), target, direction, recorded_at))
    return spark.createDataFrame(rows, JOB_METRICS)


def record_metrics(
    spark: SparkSession,
    path: str,
    job: str,
    measured: Mapping[str, float | None],
    targets: Mapping[str, tuple[str, float]],
    recorded_at: object,
) -> None:
    """Append a job's metrics to the metrics table."""
    metric_rows(spark, job, measured, targets, recorded_at).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str, job: str) -> DataFrame:
    return spark.read.schema(JOB_METRICS).parquet(path).filter(F.col("job") == job)


def rows_per_minute(rows: Column, seconds: Column) -> Column:
    """Throughput; null for a job that took no time."""
    return rows * 60 / F.nullif(seconds, F.lit(0))


def metric_status(df: DataFrame) -> DataFrame:
    """Column ``status``: met, below-target, above-target, or not-measured."""
    measured, target = F.col("measured"), F.col("target")
    status = (
        F.when(measured.isNull() | target.isNull(), "not-measured")
        .when(F.col("direction") == "min", F.when(measured >= target, "met").otherwise("below-target"))
        .otherwise(F.when(measured < target, "met").otherwise("above-target"))
    )
    return df.withColumn("status", status)
