"""Windowed rates and latencies over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.operators.ordering import percentile_name
from tallyrisk.operators.reports import windowed_rate


def rate_stream(
    df: DataFrame,
    ts: str,
    width: str = "1 minute",
    delay: str = "10 minutes",
    by: Sequence[str] = (),
    failed: Column | None = None,
) -> DataFrame:
    """Rows (and failed rows) per second in tumbling windows, emitted once a window is closed."""
    return windowed_rate(df.withWatermark(ts, delay), ts, width, by, failed)


def latency_stream(
    df: DataFrame,
    ts: str,
    latency: str = "latency_ms",
    width: str = "5 minutes",
    delay: str = "10 minutes",
    quantiles: Sequence[float] = (0.5, 0.95, 0.99),
) -> DataFrame:
    """Approximate latency percentiles per closed window."""
    picks = [F.percentile_approx(latency, q, 10_000).alias(percentile_name(q)) for q in quantiles]
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, width))
        .agg(F.count(latency).alias("n"), *picks)
        .select(F.col("window.start").alias("window_start"), "n", *[percentile_name(q) for q in quantiles])
    )
