"""Committed micro-batches, their compaction, and the latency report that reads each once."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from tallyrisk.catalog.inputs import payloads
from tallyrisk.schemas import STREAM_EVENT
from tallyrisk.sources import buckets
from tallyrisk.sources.readers import parse_events, read_event_stream
from tallyrisk.streaming import commits
from tallyrisk.streaming.commits import append_batch, commit_batch, compact_days, drop_replaced, read_committed
from tallyrisk.streaming.ingest import Sinks, enrich_events, ingest, write_batch
from tallyrisk.streaming.latency import fold_latencies, latency_report, stored_counts

SCHEMA = "id long, transaction_ts timestamp"


def batch(spark, number):
    days = F.expr("timestamp '2024-01-01' + make_interval(0, 0, 0, cast(id % 4 as int))")
    rows = spark.range(number * 10, number * 10 + 10)
    return rows.select("id", F.when(F.col("id") % 7 != 0, days).alias("transaction_ts"))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_any_order_of_batches_repeats_and_compactions(spark, tmp_path):
    steps = [("a", 0), ("a", 1), ("a", 1), ("c", "2024-01-03"), ("a", 2), ("a", 0), ("c", "2024-02-01")]
    for k, move in enumerate(itertools.permutations([3, 4, 5, 6])):
        if k % 6:
            continue  # four orders of the last steps
        path = str(tmp_path / str(k))
        seen = set()
        for kind, value in [*steps[:3], *[steps[i] for i in move]]:
            if kind == "c":
                compact_days(spark, path, value)
            else:
                assert append_batch(batch(spark, value), path, value) == (value not in seen)
                seen.add(value)
            assert ids(read_committed(spark, path)) == sorted(v * 10 + i for v in seen for i in range(10))
        assert drop_replaced(spark, path) > 0 and drop_replaced(spark, path) == 0
        assert ids(read_committed(spark, path)) == list(range(30))


def test_compaction_only_touches_closed_days_and_old_readers_go_on(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(3):
        append_batch(batch(spark, k), path, k)
    before = read_committed(spark, path)
    assert compact_days(spark, path, "2024-01-03") == ["2024-01-01", "2024-01-02", "none"]
    days = buckets.version(spark, path)["days"]
    assert {d: len(f) for d, f in days.items()} == {"2024-01-01": 1, "2024-01-02": 1, "none": 1, "2024-01-03": 3, "2024-01-04": 3}
    assert ids(before) == ids(read_committed(spark, path)) == list(range(30))
    assert compact_days(spark, path, "2024-01-03") == []
    wanted = [r["id"] for r in before.filter("transaction_ts = timestamp '2024-01-02'").collect()]
    assert ids(read_committed(spark, path, "2024-01-02", "2024-01-02")) == sorted(wanted)
    # A late batch lies beside the compacted part, and is found by its number also after it was compacted.
    append_batch(batch(spark, 3), path, 3)
    assert ids(read_committed(spark, path, after=2)) == list(range(30, 40))
    compact_days(spark, path, "2024-02-01")
    assert ids(read_committed(spark, path, after=2)) == list(range(30, 40))
    assert read_committed(spark, path, after=3).count() == 0


def test_uncommitted_work_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_batch(batch(spark, 0), path, 0)
    append_batch(batch(spark, 1), path, 1)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(commits, "commit", killed)
    for work in (lambda: append_batch(batch(spark, 2), path, 2), lambda: compact_days(spark, path, "2024-02-01")):
        with pytest.raises(KeyboardInterrupt):
            work()
    monkeypatch.undo()
    assert ids(read_committed(spark, path)) == list(range(20))
    assert append_batch(batch(spark, 2), path, 2)
    assert ids(read_committed(spark, path)) == list(range(30))


def test_append_and_compaction_side_by_side(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_batch(batch(spark, 0), path, 0)
    append_batch(batch(spark, 1), path, 1)
    write, turn = commits._write, []

    def slow(df, folder):
        if "=c" in folder and not turn:
            turn.append(1)
            append_batch(batch(spark, 2), path, 2)  # commits while the compaction runs
        return write(df, folder)

    monkeypatch.setattr(commits, "_write", slow)
    assert compact_days(spark, path, "2024-02-01")
    assert ids(read_committed(spark, path)) == list(range(30))

    other = []

    def twice(df, folder):
        if "=c" in folder and not other:
            other.append(1)
            compact_days(spark, path, "2024-02-01")  # another compaction is first
        return write(df, folder)

    monkeypatch.setattr(commits, "_write", twice)
    assert compact_days(spark, path, "2024-02-01") == []
    assert ids(read_committed(spark, path)) == list(range(30))


def test_empty_batches_odd_columns_and_short_logs(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_committed(spark, path)
    assert compact_days(spark, path, "2024-02-01") == []
    assert append_batch(spark.createDataFrame([], SCHEMA), path, 0)
    assert read_committed(spark, path).count() == 0
    with pytest.raises(ValueError, match="extra"):
        append_batch(batch(spark, 1).withColumn("extra", F.lit(1)), path, 1)
    monkeypatch.setattr(commits, "KEPT", 2)
    for k in range(1, 5):
        append_batch(batch(spark, k), path, k)
    assert len([p for p in (tmp_path / "t" / "versions").iterdir() if p.suffix == ".json"]) == 2
    assert ids(read_committed(spark, path)) == list(range(10, 50))


def test_ingest_with_a_commit_log(spark, sf, tmp_path):
    raw = payloads(spark, sf)
    rows = [r["value"] for r in raw.orderBy("ts").select("value").collect()]
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"part-{i}.txt").write_text("\n".join(rows[i::3]) + "\n")
    sinks = Sinks(*[str(tmp_path / n) for n in ("events", "latency", "rejects")])
    state = str(tmp_path / "state")
    good, bad = parse_events(raw, STREAM_EVENT)
    twin = enrich_events(good, 100.0, 250.0).drop("producer_ts")
    for _ in range(2):
        stream = read_event_stream(spark, str(tmp_path / "in"), max_files=1)
        query = ingest(stream, sinks, str(tmp_path / "cp"), 100.0, 250.0, trigger=None, write=commit_batch).start()
        assert query.awaitTermination(240)
        fold_latencies(spark, sinks.latency, state)
        for path in (sinks.events, sinks.latency, sinks.rejects):
            compact_days(spark, path, "9999-01-01")
        got = read_committed(spark, sinks.events)
        assert sorted(map(str, got.select(*twin.columns).collect())) == sorted(map(str, twin.collect()))
        assert read_committed(spark, sinks.rejects).count() == bad.count() > 0
        assert latency_report(spark, state).first()["n"] == twin.filter("transaction_id is not null").count()


def values(spark, state):
    return {r.latency_ms: r.n for r in stored_counts(spark, state).collect()}


def test_latencies_count_once(spark, tmp_path):
    sink, state = str(tmp_path / "latency"), str(tmp_path / "state")
    assert fold_latencies(spark, sink, state) == -1
    assert latency_report(spark, state).first().asDict() == {"p50": None, "p95": None, "p99": None, "n": 0, "target_met": None}
    parts = [[5, 5, 900, None], [7, 2500], [], [5, 10_000_000]]
    seen = []
    for k, part in enumerate(parts):
        write_batch(spark.createDataFrame([(v,) for v in part], "latency_ms long"), sink, k)
        seen += [v for v in part if v is not None]
        for _ in range(2):  # reading twice counts each event once
            assert fold_latencies(spark, sink, state) == k
            got = latency_report(spark, state).first()
            at = sorted(seen)
            assert [got.p50, got.p95, got.p99] == [at[math.floor(len(at) * q)] for q in (0.5, 0.95, 0.99)]
            assert (got.n, got.target_met) == (len(at), got.p95 < 2000)
    assert values(spark, state) == {5: 3, 7: 1, 900: 1, 2500: 1, 10_000_000: 1}
    assert len(list((tmp_path / "state" / "counts").iterdir())) == 2


def test_a_batch_that_is_being_written_waits(spark, tmp_path):
    sink, state = str(tmp_path / "latency"), str(tmp_path / "state")
    for k in range(3):
        write_batch(spark.createDataFrame([(k,)], "latency_ms long"), sink, k)
    mark = tmp_path / "latency" / "batch_id=1" / "_SUCCESS"
    mark.unlink()
    assert fold_latencies(spark, sink, state) == 0 and values(spark, state) == {0: 1}
    mark.touch()
    assert fold_latencies(spark, sink, state) == 2 and values(spark, state) == {0: 1, 1: 1, 2: 1}
