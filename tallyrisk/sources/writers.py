"""Table sinks: append, overwrite, upsert, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    replace_schema: bool = False,
    only_partitions: bool = False,
) -> None:
    """Write a table.

    An overwrite drops everything the new data lacks; with ``only_partitions``
    it replaces just the partitions the new data has.  ``replace_schema``
    replaces the whole table, columns included.
    """
    writer = df.write.format(fmt).mode("overwrite" if replace_schema else mode)
    if replace_schema or mode == "overwrite":
        kept = "dynamic" if only_partitions and not replace_schema else "static"
        writer = writer.option("partitionOverwriteMode", kept).option("overwriteSchema", replace_schema)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def row_count(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    return spark.read.format(fmt).load(path).count()


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two rows share a key."""
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1)
    if not twice.isEmpty():
        raise ValueError(f"duplicate keys {list(keys)} in the source of an upsert")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of equal keys; the rest of both is kept.

    One full outer join.  Column ``_change`` says updated, inserted or kept.
    """
    keys = list(keys)
    t = target.select(F.struct(*target.columns).alias("_t"), *[F.col(k).alias(f"_t_{k}") for k in keys])
    s = source.select(F.struct(*target.columns).alias("_s"), *[F.col(k).alias(f"_s_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"_t_{k}") == F.col(f"_s_{k}"))
    both = t.join(s, same, "full")
    row = F.coalesce("_s", "_t")
    change = (
        F.when(F.col("_s").isNull(), "kept").when(F.col("_t").isNull(), "inserted").otherwise("updated")
    )
    return both.select(*[row[c].alias(c) for c in target.columns], change.alias("_change"))


def upsert(
    spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], out_path: str
) -> dict[str, object]:
    """Merge the source into the table at ``path`` and write the result to ``out_path``.

    The result goes to a new folder, so a failed or repeated job never damages
    the table being read; the caller then points readers at ``out_path``.  The
    counts are observed while writing.  Without a table at ``path`` the source
    is simply written.
    """
    from tallyrisk.sources.readers import path_exists

    assert_unique(source, keys)
    counts = Observation()
    if not path_exists(spark, path):
        source.observe(counts, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(out_path)
        return {"operation": "WRITE", "rows_inserted": counts.get["rows"], "rows_updated": 0}
    merged = merge_rows(spark.read.parquet(path), source, keys).observe(
        counts,
        F.count_if(F.col("_change") == "inserted").alias("inserted"),
        F.count_if(F.col("_change") == "updated").alias("updated"),
    )
    merged.drop("_change").write.mode("overwrite").parquet(out_path)
    return {
        "operation": "MERGE",
        "rows_inserted": counts.get["inserted"],
        "rows_updated": counts.get["updated"],
    }


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, on any file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def compact(
    spark: SparkSession,
    path: str,
    out_path: str,
    cluster_cols: Sequence[str] = (),
    files: int | None = None,
    file_bytes: int = 256 << 20,
) -> None:
    """Rewrite many small files as few large ones, optionally clustered by columns.

    Without ``files`` their number follows from the bytes there are and
    ``file_bytes``.

    Range partitioning clusters the files; a row hash as the last range key
    spreads a value that fills more than one file.
    """
    df = spark.read.parquet(path)
    files = files or max(1, -(-stored_bytes(spark, path) // file_bytes))
    if cluster_cols:
        spread = F.xxhash64(*[F.col(c) for c in df.columns])
        keys = [*[F.col(c) for c in cluster_cols], spread]
        df = df.repartitionByRange(files, *keys).sortWithinPartitions(*cluster_cols)
    else:
        df = df.repartition(files)
    df.write.mode("overwrite").parquet(out_path)


def quantile_edges(df: DataFrame, columns: Sequence[str], bits: int, sample: int = 20_000) -> dict[str, list]:
    """2^bits - 1 cuts of each column, of any type that can be ordered, from about ``sample`` rows.

    They only decide how a table is laid out.
    """
    share = min(1.0, sample / max(1, df.count()))
    rows = df.select(*columns).sample(share, 7).limit(2 * sample).toPandas()
    parts, edges = 1 << bits, {}
    for c in columns:
        values = sorted(rows[c].dropna())
        edges[c] = sorted({values[len(values) * k // parts] for k in range(1, parts)}) if values else []
    return edges


def interleaved(columns: Sequence[str], edges: dict[str, list], schema: StructType, bits: int) -> Column:
    """The bits of the columns' quantile ranks, taken in turn, as one number; null ranks first."""

    def rank_of(c: str) -> Column:
        cuts = F.array(*[F.lit(v).cast(schema[c].dataType) for v in edges[c]])
        above = F.size(F.filter(cuts, lambda edge: edge <= F.col(c))) if edges[c] else F.lit(0)
        # A column of few values has few cuts; its ranks still use the high bits.
        spread = F.floor(above * (1 << bits) / (len(edges[c]) + 1))
        return F.when(F.col(c).isNotNull(), spread).otherwise(0).cast("long")

    z = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        rank = rank_of(c)
        for k in range(bits):
            z = z + F.shiftleft(F.shiftright(rank, k).bitwiseAND(F.lit(1)), k * len(columns) + len(columns) - 1 - j)
    return z


def cluster(
    spark: SparkSession,
    path: str,
    out_path: str,
    columns: Sequence[str],
    files: int | None = None,
    file_bytes: int = 256 << 20,
    bits: int = 6,
) -> None:
    """Rewrite a table so that a filter on any of the columns can skip most of its files.

    Rows are dealt to files along a curve through the columns' quantile ranks, so
    that a file covers a small box in all of them; a sort by one column after the
    other would only help the first.  A row hash as the last range key spreads a
    box that fills more than one file.
    """
    df = spark.read.parquet(path)
    files = files or max(1, -(-stored_bytes(spark, path) // file_bytes))
    z = interleaved(columns, quantile_edges(df, columns, bits), df.schema, bits)
    dealt = df.withColumn("_z", z).repartitionByRange(files, "_z", F.xxhash64(*df.columns))
    dealt.sortWithinPartitions("_z").drop("_z").write.mode("overwrite").parquet(out_path)


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines."""
    df.write.mode("overwrite").json(path)
