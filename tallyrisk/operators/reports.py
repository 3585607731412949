"""Statistics and report queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrisk.operators.cleaning import MEDIAN_ACCURACY
from tallyrisk.operators.ordering import quantiles

# Upper bounds of the score and latency buckets.
SCORE_BOUNDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
LATENCY_BOUNDS = [0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0]

# The features whose batch and serving means are compared.
SKEW_FEATURES = [
    "amount_log1p",
    "amount_zscore",
    "customer_tx_count_24h",
    "fraud_rate_30d",
    "amount_vs_mean_ratio",
]


def amount_stats(df: DataFrame, amount_col: str = "amount_usd") -> DataFrame:
    """One row ``mean``, ``std``: null mean is 0, null or zero deviation is 1, at least 1e-6."""
    mean = F.coalesce(F.mean(amount_col), F.lit(0.0))
    std = F.coalesce(F.nullif(F.stddev(amount_col), F.lit(0.0)), F.lit(1.0))
    return df.agg(mean.alias("mean"), F.greatest(std, F.lit(1e-6)).alias("std"))


def amount_zscore(df: DataFrame, amount_col: str = "amount_usd", stats: DataFrame | None = None) -> DataFrame:
    """Z-score of the amount over the whole table (or over given one-row statistics)."""
    stats = amount_stats(df, amount_col) if stats is None else stats
    one = stats.select(F.struct("mean", "std")).scalar()
    return (
        df.withColumn("_stats", one)
        .withColumn("amount_zscore", (F.col(amount_col) - F.col("_stats.mean")) / F.col("_stats.std"))
        .drop("_stats")
    )


def label_summary(labels: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows, positives and rate (0 for an empty table), in one pass."""
    total, hits = F.count(F.lit(1)), F.count_if(F.col(label) == 1)
    return labels.agg(
        total.alias("total"),
        hits.alias("fraud_count"),
        (hits / F.greatest(total, F.lit(1))).alias("fraud_rate"),
    )


def class_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows and share per label value."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return value_counts(df, label).withColumn("share", F.col("n") / total)


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def rate_by(df: DataFrame, key: Column, name: str, label: str = "is_fraud") -> DataFrame:
    """Mean label per key value."""
    return df.groupBy(key.alias(name)).agg(F.avg(F.col(label).cast("double")).alias("rate"))


def peak(rates: DataFrame, name: str) -> DataFrame:
    """The key of the highest rate (the smallest one on a tie) and that rate."""
    best = F.max_by(F.struct(name, "rate"), F.struct("rate", -F.col(name)))
    return rates.agg(best.alias("b")).select(F.col("b")[name].alias(name), F.col("b.rate").alias("rate"))


def time_range(df: DataFrame, ts: str = "transaction_ts") -> DataFrame:
    return df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def histogram(
    df: DataFrame, value: Column, by: str, bins: int, lo: float | None = None, hi: float | None = None
) -> DataFrame:
    """Rows per class and equal-width bin 1..bins; the top edge belongs to the last bin.

    Without ``lo`` or ``hi`` the bins span the finite values.  With them, values
    outside count in the first or last bin.  If all values are equal, they are
    in bin 1; nulls and NaN are in none.
    """
    rows = df.select(by, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    finite = F.when(F.abs("_v") < F.lit(float("inf")), F.col("_v"))
    low = rows.agg(F.min(finite)).scalar() if lo is None else F.lit(float(lo))
    high = rows.agg(F.max(finite)).scalar() if hi is None else F.lit(float(hi))
    at = F.least(F.greatest(F.floor((F.col("_v") - low) / F.nullif(high - low, F.lit(0.0)) * bins) + 1, F.lit(1)), F.lit(bins))
    return (
        rows.select(by, at.cast("long").alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy(by, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def le_buckets(df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Cumulative counts: per bound the rows at or below it, and all rows under infinity."""
    names = [f"{b:g}" for b in bounds] + ["inf"]
    counts = [F.count_if(F.col(value) <= b).alias(n) for b, n in zip(bounds, names)]
    counts.append(F.count(value).alias("inf"))
    one = df.groupBy(*by).agg(*counts)
    ids = [F.col(c) for c in by]
    return one.unpivot(ids, [F.col(f"`{n}`") for n in names], "le", "n").withColumn(
        "le", F.col("le").cast("double")
    )


def bucket_quantile(buckets: DataFrame, q: float, by: Sequence[str] = ()) -> DataFrame:
    """Quantile estimate from cumulative buckets by linear interpolation.

    The quantile's bucket is the first whose count reaches ``q * total``; the
    lower bound of the first bucket is 0; in the infinity bucket the highest
    finite bound is the answer.
    """
    order = Window.partitionBy(*by).orderBy("le")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inf = F.lit(float("inf"))
    steps = buckets.withColumns(
        {
            "_rank": F.last("n").over(everything) * F.lit(float(q)),
            "_below": F.coalesce(F.lag("n").over(order), F.lit(0)),
            "_from": F.coalesce(F.lag("le").over(order), F.lit(0.0)),
        }
    )
    inside = F.col("_from") + (F.col("le") - F.col("_from")) * (F.col("_rank") - F.col("_below")) / F.nullif(
        F.col("n") - F.col("_below"), F.lit(0)
    )
    value = F.when(F.col("le") == inf, F.col("_from")).otherwise(inside)
    hit = steps.filter(F.col("n") >= F.col("_rank")).withColumn("_value", value)
    return hit.groupBy(*by).agg(F.min_by("_value", "le").alias("quantile"))


def alert_counts(df: DataFrame, dims: Sequence[str], score: str = "score", above: float = 0.5) -> DataFrame:
    """Requests and alerts (score above the threshold) per combination of dimensions."""
    return df.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col(score) > above).alias("alerts")
    )


def windowed_rate(
    df: DataFrame, ts: str, width: str = "1 minute", by: Sequence[str] = (), failed: Column | None = None
) -> DataFrame:
    """Rows (and failed rows) per second in tumbling windows.  Also works on a stream."""
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    aggs = [F.count(F.lit(1)).alias("n")]
    if failed is not None:
        aggs.append(F.count_if(failed).alias("failed"))
    counted = df.groupBy(F.window(ts, width), *by).agg(*aggs)
    out = [F.col("window.start").alias("window_start"), *by, "n", (F.col("n") / seconds).alias("per_second")]
    if failed is not None:
        out += ["failed", (F.col("failed") / seconds).alias("failed_per_second")]
    return counted.select(*out)


def feature_profile(df: DataFrame, columns: Sequence[str], accuracy: int | None = MEDIAN_ACCURACY) -> DataFrame:
    """One row per feature: mean, sample deviation, median.  One pass over the data, or exact medians if no accuracy."""
    exact = quantiles(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns) if accuracy is None else {}
    one = df.agg(
        *[
            F.struct(
                F.mean(c).alias("mean"),
                F.stddev(c).alias("std"),
                (
                    F.max(F.lit(exact[c]).cast("double"))  # as an aggregate it may be null in every row
                    if accuracy is None
                    else F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy)
                ).alias("p50"),
            ).alias(c)
            for c in columns
        ]
    )
    return one.unpivot([], list(columns), "feature", "_s").select("feature", "_s.mean", "_s.std", "_s.p50")


def skew_report(
    base: DataFrame, other: DataFrame, columns: Sequence[str], limit_pct: float = 1.0
) -> DataFrame:
    """Relative difference of the means of two tables in percent, per feature, with PASS or FAIL.

    Both profiles have one row per feature.
    """
    def means(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(*[F.mean(F.col(c).cast("double")).alias(c) for c in columns])
        return one.unpivot([], list(columns), "feature", name)

    both = means(base, "offline_mean").join(means(other, "online_mean"), "feature")
    off, on = F.col("offline_mean"), F.col("online_mean")
    pct = F.when(F.abs(off) > 1e-10, F.abs(on - off) / F.abs(off) * 100).otherwise(F.lit(0.0))
    return (
        both.withColumn("skew_pct", pct)
        .withColumn("status", F.when(F.col("skew_pct") < limit_pct, "PASS").otherwise("FAIL"))
        .withColumns({"offline_mean": F.round(off, 6), "online_mean": F.round(on, 6)})
        .withColumn("skew_pct", F.round("skew_pct", 4))
    )


def keyed_skew(
    base: DataFrame,
    other: DataFrame,
    key: str,
    columns: Sequence[str],
    limit_pct: float = 1.0,
    tolerance: float = 1e-9,
) -> DataFrame:
    """``skew_report`` row by row: both tables' values of the same key beside each other, per feature.

    Adds n (keys in both), n_offline_only, n_online_only, n_different (values
    apart by more than ``tolerance``, or null on one side) and max_apart.  Equal
    means do not hide rows that differ.  FAIL if the means are ``limit_pct``
    apart (of the base's mean, or of its deviation where that mean is 0) or a key
    is on one side only.  Keys are unique on each side; rows with
    a null key are on one side only.  One join and one pass.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        values = F.struct(*[F.col(c).cast("double").alias(c) for c in columns])
        return df.select(F.col(key).alias(f"{name}_key"), values.alias(name))

    both = side(base, "off").join(side(other, "on"), F.col("off_key") == F.col("on_key"), "full")
    shared = F.col("off").isNotNull() & F.col("on").isNotNull()

    def of(c: str) -> Column:
        off, on = F.col("off")[c], F.col("on")[c]
        apart = F.when(shared, F.abs(on - off))
        different = shared & ((apart > tolerance) | (off.isNull() != on.isNull()))
        return F.struct(
            F.count_if(shared).alias("n"),
            F.count_if(F.col("on").isNull()).alias("n_offline_only"),
            F.count_if(F.col("off").isNull()).alias("n_online_only"),
            F.count_if(F.coalesce(different, F.lit(False))).alias("n_different"),
            F.max(apart).alias("max_apart"),
            F.mean(off).alias("offline_mean"),
            F.mean(on).alias("online_mean"),
            F.stddev(off).alias("spread"),
        ).alias(c)

    rows = both.agg(*[of(c) for c in columns]).unpivot([], list(columns), "feature", "_s").select("feature", "_s.*")
    off, on = F.col("offline_mean"), F.col("online_mean")
    # A mean of 0, as scores have, gives no scale; the deviation does.
    scale = F.when(F.abs(off) > 1e-10, F.abs(off)).otherwise(F.nullif(F.col("spread"), F.lit(0.0)))
    pct = F.coalesce(F.abs(on - off) / scale * 100, F.lit(0.0))
    lost = F.col("n_offline_only") + F.col("n_online_only")
    status = F.when((F.col("skew_pct") < limit_pct) & (lost == 0), "PASS").otherwise("FAIL")
    return rows.withColumn("skew_pct", pct).withColumn("status", status).drop("spread")


def skew_summary(report: DataFrame) -> DataFrame:
    """Largest skew and the failing features, by name."""
    failed = F.array_sort(F.collect_list(F.when(F.col("status") == "FAIL", F.col("feature"))))
    return report.agg(F.max("skew_pct").alias("max_skew_pct"), F.concat_ws(",", failed).alias("failing"))
