"""Mergeable sketches: medians kept up to date load by load, distinct counts of windows by slices.

A sketch is a small binary value that an aggregation makes and another merges;
rows are reduced to sketches in each task, and only sketches move or are stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SKETCHES = "column string, n long, sketch binary"

#: Size of a quantile sketch: a quantile's rank is off by 0.1 % of the rows at most, in 99 of 100 cases.
KLL_SIZE = 4096
#: 2^12 registers: a distinct count is off by 1.6 % in the mean, and exact for small sets.
HLL_BITS = 12


def quantile_sketches(df: DataFrame, columns: Sequence[str], size: int = KLL_SIZE) -> DataFrame:
    """A row per column: its number of values and a sketch of them.  One pass; nulls and NaN are left out."""
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns]
    one = df.agg(*[F.struct(F.count(v).alias("n"), F.kll_sketch_agg_double(v, size).alias("sketch")).alias(f"_{k}") for k, v in enumerate(values)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{k}.n"), F.col(f"_{k}.sketch")) for k, c in enumerate(columns)])
    return one.select(F.inline(rows))


def add_load(df: DataFrame, columns: Sequence[str], path: str, load_id: int, size: int = KLL_SIZE) -> None:
    """Store the sketches of one load; a load that is repeated replaces its own."""
    quantile_sketches(df, columns, size).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/load_id={load_id}")


def quantiles_of_loads(spark: SparkSession, path: str, share: float = 0.5, default: float = 0.0) -> DataFrame:
    """column, n and value: the quantile over all stored loads, without reading their rows again.

    A column without any value has the default.
    """
    rows = spark.read.schema(f"{SKETCHES}, load_id long").parquet(path)
    merged = rows.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    value = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share)))
    return merged.select("column", "n", F.coalesce(value, F.lit(default)).alias("value"))


def distinct_by_slices(
    df: DataFrame, entity: str, ts: str, partner: str, slices: int, slice_s: int = 86_400, bits: int = HLL_BITS, name: str = "n_distinct"
) -> DataFrame:
    """entity, slice and the about number of distinct partners in the slice and the ``slices`` - 1 before it.

    A slice is ``slice_s`` seconds of time.  Every (entity, slice) with rows gets
    one sketch, made before rows move; a window is the union of its sketches.
    Rows without entity or time are left out; null partners do not count.
    """
    rows = df.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
    at = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / slice_s).cast("long")
    made = rows.groupBy(entity, at.alias("slice")).agg(F.hll_sketch_agg(F.col(partner).cast("string"), bits).alias("_sketch"))
    window = Window.partitionBy(entity).orderBy("slice").rangeBetween(-(slices - 1), 0)
    return made.select(entity, "slice", F.hll_sketch_estimate(F.hll_union_agg("_sketch").over(window)).alias(name))
