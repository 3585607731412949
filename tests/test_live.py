"""Ingest with live velocity: against the batch window, over restarts, silence and late rows."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyrisk.operators.rolling import velocity
from tallyrisk.schemas import STREAM_EVENT
from tallyrisk.sources.readers import parse_events, read_event_stream
from tallyrisk.streaming.ingest import Sinks, enrich_events
from tallyrisk.streaming.live import ingest_live, live_counts

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
COUNTS = [f"customer_tx_count_{h}h" for h in (1, 6, 24)]


def payload(name, customer, seconds, amount=10.0, category="food"):
    ms = int((START + timedelta(seconds=seconds)).timestamp() * 1000)
    event = {"transaction_id": name, "customer_id": customer, "merchant_id": "m", "amount": amount, "currency": "USD",
             "merchant_category": category, "transaction_ts": ms, "producer_ts": ms}
    return json.dumps(event)


def drain(spark, tmp_path, files, late="2 days", **given):
    """Append the files, one micro-batch each, to the input and run the job to its end."""
    (tmp_path / "in").mkdir(exist_ok=True)
    have = len(list((tmp_path / "in").iterdir()))
    for k, lines in enumerate(files, have):
        path = tmp_path / "in" / f"part-{k:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        # Files are read in the order of their times.
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    sinks = Sinks(*[str(tmp_path / n) for n in ("events", "latency", "rejects")])
    stream = read_event_stream(spark, str(tmp_path / "in"), max_files=1)
    query = ingest_live(stream, sinks, str(tmp_path / "cp"), trigger=None, late=late, **given).start()
    assert query.awaitTermination(240)
    return sinks, query


def counts_of(spark, sinks):
    rows = spark.read.parquet(sinks.events).select("transaction_id", *COUNTS, "is_velocity_spike").collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def test_counts_equal_the_batch_window(spark, tmp_path):
    seconds = [0, 0, 0, 1, 600, 700, 800, 3600, 3600, 3601, 7200, 90_000, 90_000, 90_001, 100_000]
    lines = [payload(f"a{i}", "c", s) for i, s in enumerate(seconds)] + [payload(f"b{i}", "d", 10 * i) for i in range(4)]
    lines.sort(key=lambda x: json.loads(x)["transaction_ts"])
    odd = ["{broken", "", json.dumps({"customer_id": "c"}), payload("n", None, 5), json.dumps({"transaction_id": "t", "customer_id": "c"})]
    sinks, _ = drain(spark, tmp_path, [lines[:5], lines[5:9] + odd, lines[9:]])
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    good = enrich_events(parse_events(raw, STREAM_EVENT)[0])
    want = {r[0]: tuple(r[1:]) for r in velocity(good.drop(*COUNTS)).select("transaction_id", *COUNTS).collect()}
    got = counts_of(spark, sinks)
    assert {k: v[:3] for k, v in got.items() if k not in ("n", "t")} == want
    assert got["n"][:3] == got["t"][:3] == (0, 0, 0)
    assert {k for k, v in got.items() if v[3]} == {k for k, v in want.items() if v[0] > 5} != set()
    rejects = [r["reason"] for r in spark.read.parquet(sinks.rejects).collect()]
    assert sorted(rejects) == ["malformed", "transaction_id missing", "transaction_id missing"]


def test_rows_out_of_order_see_what_has_come(spark, tmp_path):
    sinks, _ = drain(spark, tmp_path, [[payload("x", "c", 50_000)], [payload("y", "c", 49_000), payload("z", "c", 20_000)]])
    assert counts_of(spark, sinks) == {"x": (1, 1, 1, 0), "y": (1, 1, 2, 0), "z": (1, 1, 1, 0)}


def test_a_stop_loses_no_count_and_a_repeated_batch_no_row(spark, tmp_path):
    first, _ = drain(spark, tmp_path, [[payload(f"a{i}", "c", i) for i in range(4)]])
    sinks, _ = drain(spark, tmp_path, [[payload(f"b{i}", "c", 10 + i) for i in range(3)]])
    assert counts_of(spark, sinks)["b2"] == (7, 7, 7, 1)
    again, _ = drain(spark, tmp_path, [])
    assert len(counts_of(spark, again)) == 7


def test_after_two_silent_days_nothing_is_lost_and_old_state_goes(spark, tmp_path):
    day = 86_400
    busy = [[payload(f"a{i}", f"c{i}", i) for i in range(20)]]
    later = [[payload("b", "c0", 2 * day + 5)], [payload("c", "c0", 6 * day)], [payload("d", "c0", 6 * day + 9)], [payload("e", "c1", 6 * day + 10)]]
    sinks, query = drain(spark, tmp_path, busy + later)
    got = counts_of(spark, sinks)
    assert len(got) == 24 and got["b"][:3] == got["c"][:3] == (1, 1, 1) and got["d"][:3] == (2, 2, 2)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) >= 20 and kept[-1] < 10


def test_statistics_come_from_a_table(spark, tmp_path):
    stats = spark.createDataFrame([("food", 5.0, 2.0), ("none", None, None)], "merchant_category string, mean double, std double")
    lines = [payload("f", "c", 1), payload("n", "c", 2, category="none"), payload("o", "c", 3, category="other")]
    sinks, _ = drain(spark, tmp_path, [lines], mean=20.0, std=5.0, statistics=stats)
    z = {r[0]: r[1] for r in spark.read.parquet(sinks.events).select("transaction_id", "amount_zscore").collect()}
    assert z == {"f": 2.5, "n": -2.0, "o": -2.0}


@pytest.mark.parametrize("rows", [3000])
def test_a_busy_entity_is_put_together_before_the_state(spark, tmp_path, rows):
    lines = [payload(f"a{i}", "hot", i // 1000) for i in range(rows)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.txt").write_text("\n".join(lines) + "\n")
    counted = live_counts(read_event_stream(spark, str(tmp_path / "in")))
    writer = counted.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert query.awaitTermination(240)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.groupBy("customer_tx_count_1h").count().orderBy(F.col("customer_tx_count_1h")).collect() == [(1000, 1000), (2000, 1000), (3000, 1000)]
    # The state operator got a row for each second and task, not for each event.
    seen = sum(op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"])
    assert seen <= 20


def test_live_counts_deal_entities_in_places(monkeypatch):
    """One keyed call counts many entities, apart from each other, over calls and after the watermark."""
    import numpy as np
    import pandas as pd

    from tallyrisk.streaming import live

    class Value:
        now = None
        exists = lambda self: self.now is not None
        get = lambda self: self.now
        update = lambda self, value: setattr(self, "now", value)
        clear = lambda self: setattr(self, "now", None)

    class Handle:
        value, timers = Value(), []
        getValueState = lambda self, *_: self.value
        listTimers = lambda self: self.timers
        deleteTimer = lambda self, t: self.timers.remove(t)
        registerTimer = lambda self, t: self.timers.append(t)

    class Times:
        mark = 0
        getCurrentWatermarkInMs = lambda self: self.mark

    rng, seen, times = np.random.default_rng(4), [], Times()
    counter = live._EventTimeSeconds((1, 6))
    counter.init(Handle())
    for call in range(4):
        seconds = np.sort(rng.integers(call * 20_000, call * 20_000 + 30_000, 60))
        rows = [(f"c\u00e9\x00{rng.integers(7)}", int(s)) for s in seconds]
        rows = list(dict.fromkeys(rows))
        given = pd.DataFrame([(e, s, [f"{e} {s} {j}" for j in range(1 + s % 3)]) for e, s in rows] + [("\x001", None, ["odd"])], columns=["entity", "second", "payloads"])
        got = pd.concat(list(counter.handleInputRows((1,), iter([given[:20], given[20:]]), times)))
        seen += [(e, s, 1 + s % 3) for e, s in rows]
        by_payload = {p: (a, b) for p, a, b in zip(got["payloads"].map(tuple), got["customer_tx_count_1h"], got["customer_tx_count_6h"])}
        assert by_payload.pop(("odd",)) == (0, 0) and len(by_payload) == len(rows)
        for e, s, p in zip(given["entity"][:-1], given["second"][:-1].astype(int), given["payloads"][:-1].map(tuple)):
            assert by_payload[p] == tuple(sum(n for x, at, n in seen if x == e and s - h * 3600 <= at <= s) for h in (1, 6))
        times.mark = int(seconds[0]) * 1000
    assert len(Handle.timers) == 1 and live.PLACES < 1000
    times.mark = 10**12
    list(counter.handleInputRows((1,), iter([given[:3]]), times))
    assert not Handle.value.exists()
