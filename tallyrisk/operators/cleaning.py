"""Null handling, imputation, deduplication, enrichment, conforming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrisk.operators.ordering import quantiles

#: Sketch accuracy: relative rank error of a median is 1 / accuracy.
MEDIAN_ACCURACY = 10_000


def add_audit_columns(
    df: DataFrame, source_file: str | Column, batch_id: str, ingest_ts: Column
) -> DataFrame:
    """Load time, source, batch and load date; all given, so a re-run gives the same rows."""
    source = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return df.withColumns(
        {
            "_ingest_ts": ingest_ts,
            "_source_file": source,
            "_batch_id": F.lit(batch_id),
            "_ingest_date": F.date_format(ingest_ts, "yyyy-MM-dd"),
        }
    )


def conform(df: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    """Project onto a target schema."""
    return df.select(*[expr.alias(name) for name, expr in mapping.items()])


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the columns that the frame has."""
    return [c for c in columns if c in df.columns]


def fill_constants(df: DataFrame, values: Mapping[str, float | str]) -> DataFrame:
    """Fill nulls by column; columns the frame lacks are skipped."""
    values = {c: v for c, v in values.items() if c in df.columns}
    return df.na.fill(values) if values else df


def column_medians(df: DataFrame, columns: Sequence[str], accuracy: int | None = MEDIAN_ACCURACY) -> DataFrame:
    """One row with the median of each column: a sketch of the given accuracy in one pass, or exact if it is None."""
    if accuracy is None:
        kinds = {f.name: f.dataType for f in df.schema}
        found = quantiles(df, columns)
        one = df.sparkSession.range(1)
        return one.select(*[F.lit(found[c]).cast(kinds[c]).alias(c) for c in columns])
    return df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in columns])


def impute_median(
    df: DataFrame, columns: Sequence[str], accuracy: int | None = MEDIAN_ACCURACY, default: float = 0.0
) -> DataFrame:
    """Fill nulls with the column's median, or the default if the column is all null.

    The medians enter the plan as one scalar subquery; nothing comes to the driver.
    """
    columns = present(df, columns)
    if not columns:
        return df
    medians = column_medians(df, columns, accuracy).select(F.struct(*columns)).scalar()
    fills = {c: F.coalesce(F.col(c), F.col("_medians")[c], F.lit(default)) for c in columns}
    return df.withColumn("_medians", medians).withColumns(fills).drop("_medians")


def clean_non_finite(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """Null, NaN and both infinities become the value."""
    kinds = dict(df.dtypes)
    fixed = {}
    for c in columns:
        col, bad = F.col(c), F.col(c).isNull()
        if kinds[c] in ("double", "float"):
            bad = bad | F.isnan(col) | (F.abs(col) == F.lit(float("inf")))
        fixed[c] = F.when(bad, F.lit(value).cast(kinds[c])).otherwise(col)
    return df.withColumns(fixed)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key.

    Written as row_number = 1, which Spark cuts to one row per key in each map
    task before the shuffle, so a key with very many copies does not travel.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after, and rows removed."""
    pre, post = before.agg(F.count(F.lit(1))).scalar(), F.count(F.lit(1))
    return after.agg(post.alias("post_count")).select(
        pre.alias("pre_count"), "post_count", (pre - F.col("post_count")).alias("removed")
    )


def enrich(df: DataFrame, side: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join of a few columns of an optional side table (not deduplicated)."""
    return df.join(side.select(key, *columns), key, "left")


def entity_means(df: DataFrame, entity: str = "customer_id", amount: str = "amount_usd") -> DataFrame:
    """Mean amount per (non-null) entity, as ``_entity_mean``."""
    return df.filter(F.col(entity).isNotNull()).groupBy(entity).agg(F.mean(amount).alias("_entity_mean"))


def mean_ratio(amount: str = "amount_usd", default: float = 100.0, eps: float = 1e-6) -> Column:
    """Amount over ``_entity_mean``; an entity without a mean has the default."""
    return F.col(amount) / (F.coalesce(F.col("_entity_mean"), F.lit(default)) + F.lit(eps))


def ratio_to_entity_mean(
    df: DataFrame,
    entity: str = "customer_id",
    amount: str = "amount_usd",
    name: str = "amount_vs_customer_mean_ratio",
    default: float = 100.0,
    eps: float = 1e-6,
    history: DataFrame | None = None,
) -> DataFrame:
    """Amount over the entity's mean amount; ``history`` limits what the mean sees.

    The means grow with the entities, so no broadcast is forced.
    """
    means = entity_means(df if history is None else history, entity, amount)
    joined = df.join(means, entity, "left")
    return joined.withColumn(name, mean_ratio(amount, default, eps)).drop("_entity_mean")


def new_pair_flag(
    df: DataFrame,
    history: DataFrame | None,
    keys: Sequence[str] = ("customer_id", "merchant_id"),
    name: str = "is_new_merchant",
) -> DataFrame:
    """1 if the key pair is not in the history, 0 if it is; 0 without a history."""
    if history is None or any(k not in df.columns for k in keys):
        return df.withColumn(name, F.lit(0))
    seen = history.select(*keys).distinct().withColumn("_seen", F.lit(1))
    return (
        df.join(seen, list(keys), "left")
        .withColumn(name, F.when(F.col("_seen").isNull(), 1).otherwise(0))
        .drop("_seen")
    )
