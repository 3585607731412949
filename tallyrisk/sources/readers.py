"""Batch and stream readers.  Schemas are always given."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether any file or folder matches the path, on whatever file system it names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    null_value: str = "",
    nan_value: str = "NaN",
    mode: str = "PERMISSIVE",
    optional: bool = False,
    fallback: str | None = None,
    corrupt_column: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header and a fixed schema; quotes inside quoted values are doubled.

    ``multi_line`` reads values with line breaks; a file is then one task.

    A missing path is replaced by ``fallback`` (a glob) if that matches; an
    optional input that is missing altogether gives no rows.  With
    ``corrupt_column`` malformed lines are kept there.
    """
    if not path_exists(spark, path):
        if fallback and path_exists(spark, fallback):
            path = fallback
        elif optional:
            return spark.createDataFrame([], schema)
    reader = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("nullValue", null_value)
        .option("nanValue", nan_value)
        .option("mode", mode)
        .option("escape", '"')
        .option("multiLine", str(multi_line).lower())
    )
    if corrupt_column:
        reader = reader.schema(StructType(list(schema.fields)).add(corrupt_column, "string")).option(
            "columnNameOfCorruptRecord", corrupt_column
        )
    return reader.csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_sample(spark: SparkSession, path: str, key: str, n: int, fmt: str = "parquet") -> DataFrame:
    """The first n rows by key."""
    return read_table(spark, path, fmt).orderBy(key).limit(n)


def read_features(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    optional: Sequence[str] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """The listed columns, and those optional ones the table has."""
    df = read_table(spark, path, fmt)
    return df.select(*[c for c in optional if c in df.columns], *columns)


def read_event_stream(
    spark: SparkSession,
    path: str,
    max_files: int = 100,
) -> DataFrame:
    """Text lines of a growing folder as a stream with one string column ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def read_kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "latest",
    max_offsets: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """A topic as a stream (needs Spark's Kafka package on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.options(**(extra or {})).load()


def parse_rows(
    raw: DataFrame, schema: StructType, value_col: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """JSON payloads to columns, with ``_payload`` and ``_reason``: null for rows that can be used.

    Malformed JSON and events without ``transaction_id`` have a reason.
    ``keep`` names further columns of ``raw`` to pass on.
    """
    corrupt, payload = "_corrupt", F.col(value_col).cast("string")
    with_corrupt = StructType(list(schema.fields)).add(corrupt, "string")
    struct = F.from_json(payload, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    # A generator, unlike a projection, parses once whatever is asked of the fields.
    parsed = raw.select(payload.alias("_payload"), *keep, F.inline(F.array(struct)))
    malformed = F.col(corrupt).isNotNull() | F.col("_payload").isNull()
    reason = F.when(malformed, "malformed").when(F.col("transaction_id").isNull(), "transaction_id missing")
    return parsed.withColumn("_reason", reason).drop(corrupt)


def split_rows(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows as (usable rows, rejected payloads with their reason)."""
    good = parsed.filter(F.col("_reason").isNull()).drop("_payload", "_reason")
    bad = parsed.filter(F.col("_reason").isNotNull())
    return good, bad.select(F.col("_payload").alias("payload"), F.col("_reason").alias("reason"))


def parse_events(raw: DataFrame, schema: StructType, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON payloads to columns: (rows with an id, rejected payloads).

    Malformed JSON and events without ``transaction_id`` are rejected, with the
    payload kept for a quarantine table.
    """
    return split_rows(parse_rows(raw, schema, value_col))
