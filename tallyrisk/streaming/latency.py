"""The latency report kept up to date: each batch of the ingest job's latency sink is read once.

The state is a table of counts per latency, and the id of the last batch in it.
Latencies are whole milliseconds, so the table has a row per distinct value,
grows with their range and not with the events, and the percentiles from it are
exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.operators.ordering import percentile_name, running_totals
from tallyrisk.sources.buckets import _files, commit, version
from tallyrisk.sources.readers import path_exists
from tallyrisk.streaming.commits import read_committed

COUNTS = "latency_ms long, n long"


def new_batches(spark: SparkSession, sink: str, after: int) -> tuple[DataFrame | None, int]:
    """Rows of the batches past ``after``, and the last such batch; None if there is none.

    The sink has a commit log, or a folder per batch.  A folder counts once its
    write has ended; those after one that has not wait with it.
    """
    log = version(spark, sink)
    if log is not None:
        return (read_committed(spark, sink, after=after), log["last"]) if log["last"] > after else (None, after)
    if not path_exists(spark, sink):
        return None, after
    files, make = _files(spark, sink)
    names = [s.getPath().getName() for s in files.listStatus(make(sink))]
    fresh, last = [], after
    for batch in sorted(b for n in names if n.startswith("batch_id=") and (b := int(n.split("=")[1])) > after):
        if not files.exists(make(f"{sink}/batch_id={batch}/_SUCCESS")):
            break
        fresh.append(f"{sink}/batch_id={batch}")
        last = batch
    return (spark.read.parquet(*fresh), last) if fresh else (None, after)


def fold_latencies(spark: SparkSession, sink: str, state: str, column: str = "latency_ms") -> int:
    """Add the batches that are new in the sink to the state; returns the last batch in it, -1 for none.

    The counts of a version are written first and its number is put in place by
    one rename, so a run that fails or repeats adds nothing twice; of two runs at
    the same time one is refused.  Null latencies are left out.
    """
    now = version(spark, state)
    number, done = (now["version"] + 1, now["last"]) if now else (0, -1)
    rows, last = new_batches(spark, sink, done)
    if rows is None:
        return done
    counts = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("long").alias("latency_ms")).agg(F.count("*").alias("n"))
    if now:
        counts = stored_counts(spark, state).unionByName(counts).groupBy("latency_ms").agg(F.sum("n").alias("n"))
    # Named by the batch too: a refused run must not touch the counts of the one that won.
    folder = f"counts/version={number}-{last}"
    if path_exists(spark, f"{state}/versions/{number:010d}.json"):
        raise RuntimeError(f"version {number} of {state} was written by another run")
    counts.write.mode("overwrite").parquet(f"{state}/{folder}")
    commit(spark, state, {"version": number, "last": last, "counts": folder})
    if now:
        files, make = _files(spark, state)
        files.delete(make(f"{state}/versions/{number - 2:010d}.json"), False)
        for old in files.listStatus(make(f"{state}/counts")):
            # The version before stays for readers that have begun.
            if int(old.getPath().getName().split("=")[1].split("-")[0]) < number - 1:
                files.delete(old.getPath(), True)
    return last


def stored_counts(spark: SparkSession, state: str) -> DataFrame:
    """(latency_ms, n) of the newest version; empty without one."""
    now = version(spark, state)
    return spark.read.schema(COUNTS).parquet(f"{state}/{now['counts']}") if now else spark.createDataFrame([], COUNTS)


def latency_report(
    spark: SparkSession, state: str, quantiles: Sequence[float] = (0.5, 0.95, 0.99), target: float = 2000.0, q: float = 0.95
) -> DataFrame:
    """One row: exact percentiles (element floor(n * q), from 0, of the sorted values), ``n``, and whether the target is met.

    Without events the percentiles and ``target_met`` are null and n = 0.
    """
    counts = stored_counts(spark, state)
    n = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    totals = running_totals(counts, "latency_ms", {"n": F.col("n")})
    picks = {percentile_name(p): F.min(F.when(F.col("cum_n") > math.floor(n * p), F.col("latency_ms"))) for p in {*quantiles, q}}
    found = totals.agg(*[c.alias(name) for name, c in picks.items()])
    met = F.col(percentile_name(q)) < target
    return found.select(*[percentile_name(p) for p in quantiles], F.lit(n).cast("long").alias("n"), met.alias("target_met"))
