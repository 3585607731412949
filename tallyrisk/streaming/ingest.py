"""The event stream: parse, enrich, and write each micro-batch to its sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyrisk.functions.timestamps import from_epoch_ms
from tallyrisk.plans.gold import stream_transforms
from tallyrisk.schemas import STREAM_EVENT
from tallyrisk.sources.readers import parse_rows, split_rows

TRIGGER = "10 seconds"


@dataclass(frozen=True)
class Sinks:
    """Folders of the enriched events, their latencies, and the rejected payloads."""

    events: str
    latency: str
    rejects: str


def enrich_events(
    events: DataFrame,
    mean: float | Column = 100.0,
    std: float | Column = 200.0,
    history: DataFrame | None = None,
    statistics: DataFrame | None = None,
) -> DataFrame:
    """Parsed events with decoded time and the stream-safe features.  Batch or stream.

    ``statistics`` has merchant_category (unique), mean and std; a category that it
    lacks, or one without values, goes by ``mean`` and ``std``.
    """
    if statistics is not None:
        given = statistics.select("merchant_category", F.col("mean").alias("_mean"), F.col("std").alias("_std"))
        events = events.join(given, "merchant_category", "left").select(*events.columns, "_mean", "_std")
        mean = F.coalesce("_mean", mean if isinstance(mean, Column) else F.lit(float(mean)))
        std = F.coalesce("_std", std if isinstance(std, Column) else F.lit(float(std)))
    named = events.withColumn("transaction_ts", from_epoch_ms(F.col("transaction_ts"))).withColumnRenamed(
        "amount", "amount_usd"
    )
    return stream_transforms(named, mean, std, history=history).drop("_mean", "_std")


def latency_ms(now: Column) -> Column:
    """Milliseconds from the producer's stamp to ``now``."""
    return F.unix_millis(now) - F.col("producer_ts")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch to its own folder.

    A batch that is run again after a failure replaces its folder, so every
    sink holds each batch once.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch_id={batch_id}")


def fan_out(
    sinks: Sinks,
    mean: float = 100.0,
    std: float = 200.0,
    history: DataFrame | None = None,
    now: Callable[[], Column] = F.current_timestamp,
    statistics: DataFrame | None = None,
    keep: Sequence[str] = (),
    write: Callable[[DataFrame, str, int], None] = write_batch,
) -> Callable[[DataFrame, int], None]:
    """The micro-batch function: three sinks from one parsed, persisted batch.

    ``keep`` names columns of the batch, beside the payload, that the events get.
    ``write`` puts a micro-batch in a sink: a folder of its own, or with
    ``commits.commit_batch`` a sink with a commit log and days to compact.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        parsed = parse_rows(batch, STREAM_EVENT, keep=keep).persist()
        try:
            events, rejects = split_rows(parsed)
            at = now()
            enriched = enrich_events(events, mean, std, history, statistics)
            write(enriched.drop("producer_ts"), sinks.events, batch_id)
            timing = events.select(latency_ms(at).alias("latency_ms"), at.alias("recorded_at"))
            write(timing, sinks.latency, batch_id)
            write(rejects, sinks.rejects, batch_id)
        finally:
            parsed.unpersist()

    return process


def ingest(
    raw: DataFrame,
    sinks: Sinks,
    checkpoint: str,
    mean: float = 100.0,
    std: float = 200.0,
    history: DataFrame | None = None,
    trigger: str | None = TRIGGER,
    write: Callable[[DataFrame, str, int], None] = write_batch,
) -> DataStreamWriter:
    """The configured stream writer; ``trigger=None`` works off what is there and stops."""
    writer = raw.writeStream.foreachBatch(fan_out(sinks, mean, std, history, write=write)).option(
        "checkpointLocation", checkpoint
    )
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
