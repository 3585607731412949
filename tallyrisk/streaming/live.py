"""Ingest with live velocity: per-entity counts of recent seconds, kept in event time.

The stream is keyed before the sinks.  Each task first puts the payloads of one
entity and second together, so state is read and written per second, not per
row.  Entities are dealt in a fixed number of places by hash, because a keyed call
costs much more than the rows it brings; a place's entities are counted together.
The state of a place is the seconds of its entities' longest windows with their
counts.  Time is the events' own: what the watermark has passed by more than the
longest window is dropped, and a timer clears a place that stays silent that
long.  A job that stood still for days finds its state as it left it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

from tallyrisk.functions.timestamps import from_epoch_ms
from tallyrisk.schemas import STREAM_EVENT
from tallyrisk.sources.readers import parse_rows
from tallyrisk.streaming.ingest import TRIGGER, Sinks, fan_out, write_batch
from tallyrisk.streaming.velocity import HOUR_S

#: Keys for payloads without an entity or a time; they need no state, only a place.
SPARE = 64
#: Places of state.  Each micro-batch rewrites the places it has events for.
PLACES = 256


def per_second(keyed: DataFrame) -> DataFrame:
    """Rows (entity, second, value) to (entity, second, at, payloads), put together within each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = pc.sort_indices(batch, sort_keys=[("entity", "ascending"), ("second", "ascending")])
            batch = batch.take(order)
            entity, second = batch["entity"], pc.fill_null(batch["second"], -1)
            differs = pc.or_(pc.not_equal(entity[1:], entity[:-1]), pc.not_equal(second[1:], second[:-1]))
            first = np.concatenate([[0], np.flatnonzero(differs.to_numpy(zero_copy_only=False)) + 1])
            ends = np.append(first, batch.num_rows)
            at = pc.multiply(batch["second"].take(first), 1_000_000).cast(pa.timestamp("us", "UTC"))
            payloads = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch["value"])
            columns = [entity.take(first), batch["second"].take(first), at, payloads]
            yield pa.RecordBatch.from_arrays(columns, names=["entity", "second", "at", "payloads"])

    return keyed.select("entity", "second", "value").mapInArrow(
        run, "entity string, second long, at timestamp, payloads array<string>"
    )


class _EventTimeSeconds(StatefulProcessor):
    """Counts of recent seconds of a place's entities, for rows that hold the payloads of one entity and second."""

    def __init__(self, hours: Sequence[int]):
        self.hours, self.span = list(hours), max(hours) * HOUR_S

    def init(self, handle: StatefulProcessorHandle) -> None:
        packed = StructType([StructField(name, BinaryType()) for name in ("entities", "owners", "seconds", "counts")])
        self.handle = handle
        self.recent = handle.getValueState("recent", packed)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        names = [f"customer_tx_count_{h}h" for h in self.hours]
        timeless = batch["second"].isna()
        if timeless.any():
            # Only the spare entities have no time.
            yield pd.DataFrame({"payloads": batch.loc[timeless, "payloads"]}).assign(**dict.fromkeys(names, 0))
            batch = batch[~timeless].reset_index(drop=True)
            if batch.empty:
                return
        known, owners, seconds, counts = self._load()
        # A dictionary, because pandas ends a string at its first zero character.
        place = {entity: k for k, entity in enumerate(known)}
        codes = np.concatenate([owners, np.array([place.setdefault(e, len(place)) for e in batch["entity"]], "int64")])
        entities = list(place)
        old = len(seconds)
        second = np.concatenate([seconds, batch["second"].to_numpy("int64")])
        # Entity and second as one number, in the order of both: 2^62 holds 2^18 entities over all times there are.
        low = second.min()
        width = second.max() - low + 1
        merged, where = np.unique(codes * width + (second - low), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate([counts, batch["payloads"].map(len)])).astype("int64")
        upto = np.concatenate([[0], np.cumsum(total)])
        code, now = codes[old:], second[old:]
        last = np.searchsorted(merged, code * width + (now - low), side="right")
        out = pd.DataFrame({"payloads": batch["payloads"]})
        for name, h in zip(names, self.hours):
            since = code * width + (np.maximum(now - h * HOUR_S, low) - low)
            out[name] = upto[last] - upto[np.searchsorted(merged, since, side="left")]
        # A row that may still come is at or after the watermark.
        owner, second = merged // width, merged % width + low
        keep = second >= timerValues.getCurrentWatermarkInMs() // 1000 - self.span
        if keep.any():
            left, owner = np.unique(owner[keep], return_inverse=True)
            listed = json.dumps([entities[k] for k in left]).encode()
            self.recent.update((listed, owner.astype("int64").tobytes(), second[keep].tobytes(), total[keep].tobytes()))
            self._clear_after(int(second[keep].max()))
        elif self.recent.exists():
            self.recent.clear()
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forget a place whose newest second no later row can see."""
        self.recent.clear()
        yield from ()

    def _clear_after(self, newest: int) -> None:
        due = (newest + self.span + 1) * 1000
        for old in list(self.handle.listTimers()):
            if old != due:
                self.handle.deleteTimer(old)
        self.handle.registerTimer(due)

    def _load(self) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        if not self.recent.exists():
            return [], *[np.empty(0, "int64")] * 3
        listed, *numbers = self.recent.get()
        return json.loads(bytes(listed)), *[np.frombuffer(bytes(x), "int64") for x in numbers]

    def close(self) -> None:
        pass


def live_counts(raw: DataFrame, hours: Sequence[int] = (1, 6, 24), late: str = "2 days") -> DataFrame:
    """The payloads of a stream (column ``value``) with their entity's counts over the last k hours.

    Counts include the row's own second.  They see every row that came in this or
    an earlier micro-batch with a time inside the window, so for input in time
    order they equal the batch window.  Rejected payloads, and events without a
    customer or a time, pass with counts of 0 and count for nobody.  The engine
    drops events that are more than ``late`` behind the newest and reports their
    number in the query's progress.  Needs the RocksDB state store provider.
    """
    parsed = parse_rows(raw, STREAM_EVENT)
    usable = F.col("_reason").isNull() & F.col("customer_id").isNotNull() & F.col("transaction_ts").isNotNull()
    spare = F.concat(F.lit("\0"), F.pmod(F.xxhash64("_payload"), F.lit(SPARE)).cast("string"))
    keyed = parsed.select(
        F.when(usable, F.concat(F.lit("c"), "customer_id")).otherwise(spare).alias("entity"),
        F.when(usable, F.floor(F.unix_micros(from_epoch_ms(F.col("transaction_ts"))) / 1_000_000).cast("long")).alias("second"),
        F.col("_payload").alias("value"),
    )
    counts = [f"customer_tx_count_{h}h" for h in hours]
    rows = per_second(keyed).withColumn("place", F.pmod(F.xxhash64("entity"), F.lit(PLACES))).withWatermark("at", late).groupBy("place")
    counted = rows.transformWithStateInPandas(
        statefulProcessor=_EventTimeSeconds(hours),
        outputStructType="payloads array<string>, " + ", ".join(f"{c} long" for c in counts),
        outputMode="Append",
        timeMode="EventTime",
    )
    return counted.select(F.explode("payloads").alias("value"), *counts)


def ingest_live(
    raw: DataFrame,
    sinks: Sinks,
    checkpoint: str,
    mean: float = 100.0,
    std: float = 200.0,
    history: DataFrame | None = None,
    statistics: DataFrame | None = None,
    trigger: str | None = TRIGGER,
    hours: Sequence[int] = (1, 6, 24),
    late: str = "2 days",
    write: Callable[[DataFrame, str, int], None] = write_batch,
) -> DataStreamWriter:
    """The ingest job with live counts and spikes; ``trigger=None`` works off what is there and stops."""
    counted = live_counts(raw, hours, late)
    keep = [f"customer_tx_count_{h}h" for h in hours]
    process = fan_out(sinks, mean, std, history, statistics=statistics, keep=keep, write=write)
    writer = counted.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
