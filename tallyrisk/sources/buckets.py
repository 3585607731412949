"""A Parquet table dealt in key-hash buckets, of which an upsert rewrites only those it touches.

``path/data`` has a folder for every version and bucket, ``path/versions`` a
small file for every version: the key, the schema, and for each bucket the
version that wrote it.  The newest such file is the table.  An upsert writes new
folders and then puts the next version's file in place with one rename, so a run
that is killed or fails leaves the table as it was, and of two runs at the same
time one is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tallyrisk.sources.readers import path_exists

BUCKET = "_bucket"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a constructor of paths on it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def version(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """What the table's newest version (or the given one) consists of; None without a table."""
    if not path_exists(spark, f"{path}/versions"):
        return None
    files, make = _files(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(make(f"{path}/versions"))]
    known = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))
    if not known:
        return None
    rows = spark.read.option("wholetext", True).text(f"{path}/versions/{known[-1] if number is None else number:010d}.json")
    return json.loads(rows.first()[0])


def read_buckets(spark: SparkSession, path: str, number: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
    """The table as of a version; ``only`` reads some of its buckets."""
    found = version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"no bucketed table at {path}")
    schema = StructType.fromJson(found["schema"])
    wanted = {int(b): v for b, v in found["buckets"].items() if only is None or int(b) in only}
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/version={v}/{BUCKET}={b}" for b, v in sorted(wanted.items())])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_buckets(
    spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], buckets: int = 64, newer: str | None = None
) -> dict[str, object]:
    """Merge the source into the table, rewriting only the buckets that its keys fall into.

    The source runs once: it is written beside the table, dealt in buckets, and
    read from there.  Rows of equal keys meet in one aggregation, which also
    counts inserted and updated keys and finds keys that the source has twice:
    those raise and nothing changes.  With ``newer`` a stored row is replaced
    only by one with a larger value of that column.  Rows with a null key match
    nothing and are added.  ``buckets`` counts when the table is made; choose it
    so that a bucket fits a task.
    """
    keys, now = list(keys), version(spark, path)
    if now and now["keys"] != keys:
        raise ValueError(f"the table is dealt by {now['keys']}, not by {keys}")
    buckets, number = (now["count"], now["version"] + 1) if now else (buckets, 0)
    schema = StructType.fromJson(now["schema"]) if now else source.schema
    columns = schema.fieldNames()

    staged = f"{path}/staged/{uuid.uuid4().hex}"
    source.select(*columns, bucket_of(keys, buckets).alias(BUCKET)).write.partitionBy(BUCKET).parquet(staged)
    typed = StructType([*schema.fields]).add(BUCKET, IntegerType())
    fresh = spark.read.schema(typed).parquet(staged).withColumn("_new", F.lit(1))
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
    stored = read_buckets(spark, path, only=touched) if now else spark.createDataFrame([], schema)
    stored = stored.withColumns({BUCKET: bucket_of(keys, buckets), "_new": F.lit(0)})

    both = stored.unionByName(fresh).repartition(max(1, len(touched)), BUCKET)
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1
    # Rows with a null key stand alone: each is a group of its own.
    alone = F.when(null_key, F.monotonically_increasing_id())
    # Of equal times the stored row stays.
    rank = F.struct(newer, -F.col("_new")) if newer else F.col("_new")
    merged = both.groupBy(BUCKET, *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], alone.alias("_alone")).agg(
        F.max_by(F.struct(*columns, "_new"), rank).alias("_row"),
        F.count_if(F.col("_new") == 1).alias("_given"),
        F.count_if(F.col("_new") == 0).alias("_held"),
    )
    counts = Observation()
    merged = merged.observe(
        counts,
        F.count_if(F.col("_held") == 0).alias("inserted"),
        F.count_if((F.col("_held") > 0) & (F.col("_row._new") == 1)).alias("updated"),
        F.count_if(F.col("_given") > 1).alias("twice"),
    )
    out = f"{path}/data/version={number}"
    merged.select("_row.*", BUCKET).drop("_new").write.mode("overwrite").partitionBy(BUCKET).parquet(out)
    seen = counts.get
    files, make = _files(spark, path)
    files.delete(make(staged), True)
    if seen["twice"]:
        raise ValueError(f"{seen['twice']} duplicate keys {keys} in the source of an upsert")
    held = {**(now["buckets"] if now else {}), **{str(b): number for b in touched}}
    commit(spark, path, {"version": number, "keys": keys, "count": buckets, "schema": schema.jsonValue(), "buckets": held})
    return {
        "operation": "MERGE" if now else "WRITE",
        "rows_inserted": seen["inserted"],
        "rows_updated": seen["updated"],
        "buckets_rewritten": len(touched),
        "version": number,
    }


def commit(spark: SparkSession, path: str, content: dict) -> None:
    """Put a version's file in place; raises if there is one with its number."""
    files, make = _files(spark, path)
    name = make(f"{path}/versions/{content['version']:010d}.json")
    draft = make(f"{path}/versions/_{uuid.uuid4().hex}")
    stream = files.create(draft)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    if files.exists(name) or not files.rename(draft, name):
        files.delete(draft, False)
        raise RuntimeError(f"version {content['version']} of {path} was written by another run")


def drop_unused(spark: SparkSession, path: str) -> int:
    """Delete the folders that the newest version does not use; returns how many. Older versions can then not be read."""
    now = version(spark, path)
    files, make = _files(spark, path)
    gone = 0
    for v in files.listStatus(make(f"{path}/data")):
        for b in files.listStatus(v.getPath()):
            number, name = v.getPath().getName().split("=")[1], b.getPath().getName()
            if name.startswith(BUCKET) and now["buckets"].get(name.split("=")[1]) != int(number):
                gone += bool(files.delete(b.getPath(), True))
    return gone
