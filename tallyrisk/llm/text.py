"""Helpers that several operators share: tables, Arrow batches, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrisk.session import shared_dir

#: The ASCII white space that separates words; ``bytes.split()`` splits at exactly these.
SPACE = r"\x20\x09-\x0D"

#: Spark's word splitter for the same words, native form.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; cuts the lineage.

    Spark drops the shuffle files of finished steps when the driver's JVM has
    collected their handles, so a collection is asked for: the next step then
    has that disk.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def with_row_id(docs: DataFrame) -> DataFrame:
    """Rows with a ``_row`` of their own, so repeated ids do not fan out in joins."""
    return docs.withColumn("_row", F.monotonically_increasing_id())


def mapped(
    df: DataFrame, rows: Callable[..., Iterator[tuple]], schema: str, size: int = 2000
) -> DataFrame:
    """Rows that the generator ``rows`` makes from each row of ``df``, in Arrow batches.

    ``rows`` gets an iterator over tuples of Python values, one per row of a
    partition, and yields tuples in the order of ``schema``.  Binary and text
    come as ``bytes`` and ``str``.
    """
    target = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)

        def given() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    yield from zip(*(c.to_pylist() for c in batch.slice(at, 256).columns))

        def packed(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(col), f.type) for col, f in zip(zip(*out), arrow)], schema=arrow
            )

        out: list[tuple] = []
        for row in rows(given()):
            out.append(row)
            if len(out) >= size:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    return df.mapInArrow(run, target)


class WordHashes(dict):
    """64-bit word hashes; the store of known words is emptied at ``limit`` entries."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0xBF58476D1CE4E5B9)
