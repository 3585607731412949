"""A sink of micro-batches with a commit log, whose closed days can be compacted.

``path/data`` holds a folder per batch, ``path/versions`` the log: a small file
per commit that lists the folders of each day and the last batch.  Readers take
the newest file, so they see whole batches only, each once, and a compacted day
instead of its parts.  Whoever commits second reads the log again: appends and
compactions may run side by side.  A folder that a compaction replaced stays for
readers of older versions until ``drop_replaced``.

Rows without a time, or from a sink without one, lie in the day ``none``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyrisk.sources.buckets import _files, commit, version

DAY, NO_DAY = "_day", "none"
PART = "_part"  # folders: b and the batch's id, or c and a name of a compaction
#: Versions that are kept; older files of the log are deleted.
KEPT = 100
TRIES = 20


def _update(spark: SparkSession, path: str, change: Callable[[dict], dict | None]) -> dict:
    """Commit what ``change`` makes of the newest version; None leaves it.  Started anew if another run commits first."""
    for _ in range(TRIES):
        now = version(spark, path) or {"version": -1, "last": -1, "schema": None, "days": {}, "replaced": []}
        after = change(now)
        if after is None:
            return now
        after = {**after, "version": now["version"] + 1}
        try:
            commit(spark, path, after)
        except RuntimeError:
            continue
        files, make = _files(spark, path)
        files.delete(make(f"{path}/versions/{after['version'] - KEPT:010d}.json"), False)
        return after
    raise RuntimeError(f"{path} was changed by other runs {TRIES} times in a row")


def _write(df: DataFrame, folder: str) -> list[str]:
    """Write rows with a day to a folder; the days they fell on."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DAY).parquet(folder)
    files, make = _files(spark, folder)
    names = [s.getPath().getName() for s in files.listStatus(make(folder))]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{DAY}="))


def append_batch(df: DataFrame, path: str, batch_id: int, times: Sequence[str] = ("transaction_ts", "recorded_at")) -> bool:
    """Write a micro-batch and commit it; False if the log has it, and nothing is written then.

    Batches come in the order of their ids, as one stream's do.  A batch that
    failed before its commit replaces its folder when it runs again.  The day is
    that of the first of ``times`` that the rows have.  All batches need the
    columns of the first one; ``batch_id`` is added.
    """
    spark = df.sparkSession
    now = version(spark, path)
    if now and batch_id <= now["last"]:
        return False
    time = next((t for t in times if t in df.columns), None)
    day = F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(NO_DAY)) if time else F.lit(NO_DAY)
    rows = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if now:
        schema = StructType.fromJson(now["schema"])
        wrong = {(f.name, f.dataType) for f in schema} ^ {(f.name, f.dataType) for f in rows.schema}
        if wrong:
            raise ValueError(f"columns differ from those of {path}: {sorted(name for name, _ in wrong)}")
        rows = rows.select(*schema.fieldNames())
    folder = f"{PART}=b{batch_id}"
    days = _write(rows.withColumn(DAY, day), f"{path}/data/{folder}")

    def add(now: dict) -> dict | None:
        if batch_id <= now["last"]:
            return None
        held = {**now["days"], **{d: [*now["days"].get(d, []), folder] for d in days}}
        return {**now, "last": batch_id, "days": held, "schema": now["schema"] or rows.schema.jsonValue()}

    _update(spark, path, add)
    return True


def _folders(path: str, days: dict[str, list[str]]) -> list[str]:
    return [f"{path}/data/{folder}/{DAY}={d}" for d, folders in sorted(days.items()) for folder in folders]


def read_committed(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None, after: int | None = None
) -> DataFrame:
    """The committed rows, with ``batch_id``; of the days ``first`` to ``last`` if given, of the batches past ``after``."""
    now = version(spark, path)
    if now is None:
        raise FileNotFoundError(f"no committed batch at {path}")
    schema = StructType.fromJson(now["schema"])
    days = {d: f for d, f in now["days"].items() if (first is None or d >= first) and (last is None or d <= last)}
    if after is not None:
        # A batch's folder names its batch; a compacted one may hold any.
        fresh = lambda f: not f.startswith(f"{PART}=b") or int(f.removeprefix(f"{PART}=b")) > after
        days = {d: [f for f in folders if fresh(f)] for d, folders in days.items()}
    folders = _folders(path, days)
    if not folders:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(*folders)
    return df if after is None else df.filter(F.col("batch_id") > after)


def compact_days(spark: SparkSession, path: str, before: str) -> list[str]:
    """Rewrite all days before ``before`` (yyyy-MM-dd) that have several folders, and ``none``; the days rewritten.

    One job for all days.  Rows are rebalanced by day, so a small day is one file
    and a large one is split by size.  Rows that reach a compacted day later are
    added beside it and join it in the next compaction.  A run that finds one of
    its folders replaced by another run leaves that day to the other.
    """
    now = version(spark, path)
    if now is None:
        return []
    many = {d: f for d, f in now["days"].items() if len(f) > 1 and (d < before or d == NO_DAY)}
    if not many:
        return []
    schema = StructType.fromJson(now["schema"])
    # The day is read from the folders' names.
    named = StructType([*schema.fields]).add(PART, "string").add(DAY, "string")
    rows = spark.read.schema(named).option("basePath", f"{path}/data").parquet(*_folders(path, many)).drop(PART)
    folder = f"{PART}=c{uuid.uuid4().hex}"
    _write(rows.hint("rebalance", DAY), f"{path}/data/{folder}")
    done: list[str] = []

    def swap(now: dict) -> dict | None:
        done[:] = [d for d, old in many.items() if set(old) <= set(now["days"].get(d, []))]
        if not done:
            return None
        held = {**now["days"], **{d: [folder, *[f for f in now["days"][d] if f not in many[d]]] for d in done}}
        gone = [f"{f}/{DAY}={d}" for d in done for f in many[d]]
        return {**now, "days": held, "replaced": [*now["replaced"], *gone]}

    _update(spark, path, swap)
    return sorted(done)


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the folders that compactions replaced; returns how many.  Readers of older versions then fail."""
    now = version(spark, path)
    gone = now["replaced"] if now else []
    files, make = _files(spark, path)
    for folder in gone:
        files.delete(make(f"{path}/data/{folder}"), True)
    if gone:
        _update(spark, path, lambda now: {**now, "replaced": [f for f in now["replaced"] if f not in set(gone)]})
    return len(gone)


def commit_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """``append_batch`` as the ``write`` of the ingest jobs."""
    append_batch(df, path, batch_id)
