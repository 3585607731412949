"""Streams against their batch twins."""

import json
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyrisk.catalog.inputs import payloads, silver
from tallyrisk.operators.reports import windowed_rate
from tallyrisk.operators.rolling import velocity
from tallyrisk.plans.scoring import assess
from tallyrisk.schemas import STREAM_EVENT
from tallyrisk.sources.readers import parse_events, read_event_stream
from tallyrisk.streaming.ingest import Sinks, enrich_events, ingest
from tallyrisk.streaming.monitoring import latency_stream, rate_stream
from tallyrisk.streaming.velocity import velocity_stream


def run(writer, name=None):
    query = writer.start()
    done = query.awaitTermination(240)
    if not done:
        query.stop()
    assert done


def write_in_time_order(df, path, files=3):
    """Text files of JSON payloads, one after the other in time."""
    rows = [r["value"] for r in df.orderBy("ts").select("value").collect()]
    size = -(-len(rows) // files)
    path.mkdir(exist_ok=True)
    for i in range(files):
        (path / f"part-{i:03d}.txt").write_text("\n".join(rows[i * size : (i + 1) * size]) + "\n")


def sinks_in(tmp_path):
    return Sinks(*[str(tmp_path / n) for n in ("events", "latency", "rejects")])


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf, tmp_path):
    raw = payloads(spark, sf)
    write_in_time_order(raw, tmp_path / "in")
    sinks = sinks_in(tmp_path)

    def go():
        stream = read_event_stream(spark, str(tmp_path / "in"), max_files=1)
        run(ingest(stream, sinks, str(tmp_path / "cp"), 100.0, 250.0, trigger=None))

    go()
    good, bad = parse_events(raw, STREAM_EVENT)
    twin = enrich_events(good, 100.0, 250.0).drop("producer_ts")
    got = spark.read.parquet(sinks.events)
    assert got.select("batch_id").distinct().count() == 3
    assert sorted(map(str, got.select(*twin.columns).collect())) == sorted(map(str, twin.collect()))
    assert spark.read.parquet(sinks.rejects).count() == bad.count() > 0
    assert spark.read.parquet(sinks.latency).count() == twin.count()

    go()
    assert spark.read.parquet(sinks.events).count() == twin.count()


def test_repeated_batch_replaces_its_folder(spark, sf, tmp_path):
    from tallyrisk.streaming.ingest import fan_out

    sinks = sinks_in(tmp_path)
    process = fan_out(sinks, now=lambda: F.lit("2024-02-01").cast("timestamp"))
    batch = payloads(spark, sf)
    process(batch, 7)
    first = spark.read.parquet(sinks.events).count()
    process(batch, 7)
    assert spark.read.parquet(sinks.events).count() == first
    assert spark.read.parquet(sinks.latency).filter("latency_ms is null").count() == 0
    process(batch.limit(0), 8)
    assert spark.read.parquet(sinks.events).select("batch_id").distinct().count() == 1


def test_velocity_state_equals_batch_window(spark, sf, tmp_path):
    base = silver(spark, sf).select("transaction_id", "customer_id", "transaction_ts", "amount_usd")
    for i in range(3):
        day = F.dayofmonth("transaction_ts")
        part = base.filter((day > 10 * i) & (day <= 10 * i + 10))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    writer = (
        velocity_stream(stream, expire=False)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
    )
    run(writer)
    names = ["transaction_id"] + [f"customer_tx_count_{h}h" for h in (1, 6, 24)]
    got = spark.read.parquet(str(tmp_path / "out")).select(*names)
    want = velocity(base).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_velocity_state_with_peers_gaps_and_a_busy_second(spark, tmp_path):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    seconds = [0, 0, 0, 1, 3600, 3600, 3601, 7200, 90000, 90000, 90001]
    rows = [(str(i), "c", start + timedelta(seconds=s), 1.0) for i, s in enumerate(seconds)]
    base = spark.createDataFrame(rows, "transaction_id string, customer_id string, transaction_ts timestamp, amount_usd double")
    (tmp_path / "in").mkdir()
    for i, cut in enumerate([rows[:4], rows[4:8], rows[8:]]):
        spark.createDataFrame(cut, base.schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i}"))
    stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    writer = (
        velocity_stream(stream, expire=False)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
    )
    run(writer)
    names = ["transaction_id"] + [f"customer_tx_count_{h}h" for h in (1, 6, 24)]
    got = spark.read.parquet(str(tmp_path / "out")).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, velocity(base).select(*names).collect()))


def test_velocity_state_with_expiry_runs_on_a_timed_trigger(spark, tmp_path):
    rows = [(str(i), "c", datetime(2024, 1, 1, 0, i, tzinfo=timezone.utc)) for i in range(5)]
    base = spark.createDataFrame(rows, "transaction_id string, customer_id string, transaction_ts timestamp")
    base.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
    query = (
        velocity_stream(stream, hours=(1,))
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        # Batches go on without data, so wait for the progress report of the rows.
        deadline = time.monotonic() + 90
        while sum(p["numInputRows"] for p in query.recentProgress) < 5 and time.monotonic() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("transaction_ts").collect()
    assert [r["customer_tx_count_1h"] for r in got] == [1, 2, 3, 4, 5]


def test_windowed_rate_and_latency_streams(spark, sf, tmp_path):
    base = silver(spark, sf).select(
        "transaction_ts", "merchant_id", (F.col("transaction_id").cast("long") % 900).alias("latency_ms")
    )
    base.coalesce(1).sortWithinPartitions("transaction_ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
    failed = F.col("merchant_id") == "error"
    for name, df in (
        ("rate", rate_stream(stream, "transaction_ts", "1 hour", failed=failed)),
        ("late", latency_stream(stream, "transaction_ts", width="1 hour")),
    ):
        writer = (
            df.writeStream.format("parquet")
            .option("path", str(tmp_path / name))
            .option("checkpointLocation", str(tmp_path / f"cp-{name}"))
            .trigger(availableNow=True)
        )
        run(writer)
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "rate")).collect()}
    want = {tuple(r) for r in windowed_rate(base, "transaction_ts", "1 hour", failed=failed).collect()}
    # The newest windows stay open until the watermark passes them.
    assert got <= want and len(want) - len(got) <= 2
    late = spark.read.parquet(str(tmp_path / "late"))
    assert late.count() == len(got)
    assert late.filter("p50 > p95 or p95 > p99").count() == 0


def test_all_nullable_fields_null(spark):
    event = {"transaction_id": "t", "customer_id": "c", "merchant_id": "m", "amount": 5.0,
             "transaction_ts": 1704067200000, "producer_ts": 1704067200000}
    raw = spark.createDataFrame([(json.dumps(event),), ("{oops",), ("{}",)], "value string")
    good, bad = parse_events(raw, STREAM_EVENT)
    row = enrich_events(good).collect()[0]
    assert row["amount_bucket"] == "0-10" and row["lat"] is None and row["hour_of_day"] == 0
    assert {r["reason"] for r in bad.collect()} == {"malformed", "transaction_id missing"}


def test_scored_stream(spark, sf, tmp_path):
    from tallyrisk.models import classifier
    from tallyrisk.plans.training import training_set

    data = training_set(silver(spark, sf))
    model = classifier.train_classifier(data, params={"trees": 2, "depth": 3})
    data.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    writer = (
        assess(classifier.score(stream, model))
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
    )
    run(writer)
    got = spark.read.parquet(str(tmp_path / "out"))
    twin = assess(classifier.score(data, model))
    columns = ["transaction_id", "score", "risk_level", "top_risk_factors", "explanation"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, twin.select(*columns).collect()))


def test_kafka_source_is_configured(spark):
    from tallyrisk.sources.readers import read_kafka_stream

    with pytest.raises(Exception, match="kafka"):
        read_kafka_stream(spark, "localhost:1", "events")
