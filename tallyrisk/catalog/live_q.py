"""Streams run to the end of their input, and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyrisk.catalog.features_q import AMOUNT_SQL, TEMPORAL_SQL
from tallyrisk.catalog.inputs import event_stream, payloads, silver, table
from tallyrisk.catalog.reports_q import pick_sql
from tallyrisk.catalog.registry import query, rounded, rs, sql, text_ts, text_ts_sql
from tallyrisk.models import boosting
from tallyrisk.models.isolation_forest import anomaly_table, fit_isolation_forest, score_isolation_forest
from tallyrisk.operators.rolling import rolling
from tallyrisk.plans.gold import CUSTOMER_ROLLING
from tallyrisk.plans.jobs import train_and_evaluate
from tallyrisk.plans.replay import as_transactions, stream_batch_skew
from tallyrisk.plans.scoring import assess
from tallyrisk.plans.training import training_set
from tallyrisk.session import shared_dir
from tallyrisk.streaming.commits import append_batch, compact_days, drop_replaced, read_committed
from tallyrisk.streaming.ingest import Sinks, ingest, write_batch
from tallyrisk.streaming.latency import fold_latencies, latency_report
from tallyrisk.streaming.live import ingest_live
from tallyrisk.streaming.monitoring import rate_stream
from tallyrisk.streaming.velocity import velocity_stream

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _run(writer: DataStreamWriter) -> None:
    writer.start().awaitTermination()


def _drain(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """All rows of a stream, through a table."""
    out = shared_dir(spark, "stream")
    writer = stream.writeStream.format("parquet").option("path", out)
    _run(writer.option("checkpointLocation", shared_dir(spark, "checkpoint")).trigger(availableNow=True))
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "stream_ingest",
    sql(
        f"""SELECT transaction_id, customer_id, merchant_id, amount_usd, {text_ts_sql('transaction_ts')} AS ts,
  {TEMPORAL_SQL}, {AMOUNT_SQL.format(a='amount_usd', log1p=rs('ln(1 + greatest(amount_usd, 0))'))},
  {rs('(amount_usd - 100) / 250')} AS amount_zscore, is_fraud
  FROM (SELECT * EXCLUDE (transaction_ts, ts, amount), amount AS amount_usd,
  make_timestamp(transaction_ts * 1000) AS transaction_ts FROM payloads
  WHERE well_formed AND transaction_id IS NOT NULL)""",
        "payloads",
    ),
)
def _(spark, sf):
    names = ("events", "latency", "rejects")
    sinks = Sinks(*[shared_dir(spark, name) for name in names])
    raw = payloads(spark, sf, event_stream(spark, sf)).select("value")
    _run(ingest(raw, sinks, shared_dir(spark, "checkpoint"), 100.0, 250.0, trigger=None))
    columns = ["hour_of_day", "day_of_week", "is_weekend", "is_night", "amount_log1p", "amount_bucket"]
    df = spark.read.parquet(sinks.events).select(
        "transaction_id",
        "customer_id",
        "merchant_id",
        "amount_usd",
        text_ts("transaction_ts").alias("ts"),
        *columns,
        "is_round_amount",
        "amount_zscore",
        "is_fraud",
    )
    return rounded(df, "amount_log1p", "amount_zscore")


@query(
    "stream_velocity",
    sql(
        "SELECT transaction_id, "
        + ", ".join(
            f"""count(*) OVER (PARTITION BY customer_id ORDER BY s RANGE BETWEEN {h * 3600} PRECEDING AND CURRENT ROW)
  AS customer_tx_count_{h}h"""
            for h in (1, 6, 24)
        )
        + " FROM silver",
        "silver",
    ),
)
def _(spark, sf):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = silver(spark, sf, event_stream(spark, sf)).select("transaction_id", "customer_id", "transaction_ts")
    counted = velocity_stream(rows, expire=False)
    return _drain(spark, counted).select("transaction_id", *[f"customer_tx_count_{h}h" for h in (1, 6, 24)])


def _count_sql(hours: int) -> str:
    return f"""count(*) OVER (PARTITION BY customer_id ORDER BY s RANGE BETWEEN {hours * 3600} PRECEDING AND CURRENT ROW)"""


@query(
    "stream_ingest_velocity",
    sql(
        f"""SELECT transaction_id, customer_id, {text_ts_sql('transaction_ts')} AS ts,
  {', '.join(f'{_count_sql(h)} AS customer_tx_count_{h}h' for h in (1, 6, 24))},
  cast({_count_sql(24)} > 5 AS integer) AS busy_day, cast({_count_sql(1)} > 5 AS integer) AS is_velocity_spike,
  {rs('(amount_usd - mean) / std')} AS amount_zscore
  FROM (SELECT transaction_id, customer_id, merchant_category, amount AS amount_usd, transaction_ts // 1000 AS s,
  make_timestamp(transaction_ts * 1000) AS transaction_ts FROM payloads
  WHERE well_formed AND transaction_id IS NOT NULL)
  JOIN (SELECT event_type AS merchant_category, avg(value) AS mean, stddev_samp(value) AS std FROM events GROUP BY 1)
  USING (merchant_category)""",
        "payloads",
    ),
)
def _(spark, sf):
    """The ingest job on all events as a stream: counts from keyed state, statistics per category from a table."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    sinks = Sinks(*[shared_dir(spark, name) for name in ("events", "latency", "rejects")])
    stats = silver(spark, sf).groupBy("merchant_category").agg(F.mean("amount_usd").alias("mean"), F.stddev("amount_usd").alias("std"))
    path = shared_dir(spark, "statistics")
    stats.write.parquet(path)
    raw = payloads(spark, sf, event_stream(spark, sf)).select("value")
    statistics = spark.read.parquet(path)
    _run(ingest_live(raw, sinks, shared_dir(spark, "checkpoint"), statistics=statistics, trigger=None, late="60 days"))
    df = spark.read.parquet(sinks.events).select(
        "transaction_id",
        "customer_id",
        text_ts("transaction_ts").alias("ts"),
        *[f"customer_tx_count_{h}h" for h in (1, 6, 24)],
        (F.col("customer_tx_count_24h") > 5).cast("int").alias("busy_day"),
        "is_velocity_spike",
        "amount_zscore",
    )
    return rounded(df, "amount_zscore")


_SKEW_SQL = {
    "amount_log1p": ("ln(1 + greatest(a, 0))", "ln(1 + greatest(a, 0))"),
    "amount_zscore": ("(a - mean) / std", "(a - mean) / std"),
    "customer_tx_count_24h": ("n24", "n24"),
    "fraud_rate_30d": ("rate", "coalesce(CASE WHEN epoch_us(ts) - epoch_us(since) <= 604800000000 THEN known END, 0)"),
    "amount_vs_mean_ratio": ("a / (m + 1e-6)", "a / (m + 1e-6)"),
}


@query(
    "stream_batch_skew",
    sql(
        """, good AS (SELECT transaction_id, customer_id, amount AS a, make_timestamp(transaction_ts * 1000) AS ts,
  transaction_ts // 1000 AS s, is_fraud, event_id FROM payloads WHERE well_formed AND transaction_id IS NOT NULL),
  rated AS (SELECT *, avg(is_fraud) OVER (PARTITION BY customer_id ORDER BY s RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW) AS rate,
  count(*) OVER (PARTITION BY customer_id ORDER BY s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS n24,
  avg(a) OVER () AS mean, stddev_samp(a) OVER () AS std, avg(a) OVER (PARTITION BY customer_id) AS m FROM good),
  daily AS (SELECT customer_id, rate AS known, date_trunc('day', ts) + INTERVAL 1 DAY AS since FROM rated
  QUALIFY row_number() OVER (PARTITION BY customer_id, date_trunc('day', ts) ORDER BY ts DESC, event_id DESC) = 1),
  sides AS (SELECT r.*, d.known, d.since FROM rated r ASOF LEFT JOIN daily d ON r.customer_id = d.customer_id AND r.ts >= d.since)
  """
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, count(*) AS n, 0::BIGINT AS n_offline_only, 0::BIGINT AS n_online_only,
  count(*) FILTER (abs(({off}) - ({on})) > 1e-9) AS n_different, {rs(f'max(abs(({off}) - ({on})))')} AS max_apart,
  {rs(f'avg({off})', 4)} AS offline_mean, {rs(f'avg({on})', 4)} AS online_mean,
  CASE WHEN coalesce(abs(avg({on}) - avg({off})) / nullif(abs(avg({off})), 0) * 100, 0) < 1 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM sides"""
            for c, (off, on) in _SKEW_SQL.items()
        ),
        "payloads",
    ).replace("\n, good AS", ", good AS"),
)
def _(spark, sf):
    """All events through the live ingest job, its features held against the batch's."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    raw = payloads(spark, sf).select("value")
    rows = as_transactions(raw)
    rolled = rolling(rows, "customer_id", "transaction_ts", [r for r in CUSTOMER_ROLLING if r.name == "fraud_rate_30d"])
    day = F.date_trunc("day", "transaction_ts")
    newest = F.max_by("fraud_rate_30d", F.struct("transaction_ts", F.col("transaction_id").cast("long")))
    days = rolled.groupBy("customer_id", day.alias("_day")).agg(newest.alias("fraud_rate_30d"))
    customers = days.select("customer_id", (F.col("_day") + F.expr("INTERVAL 1 DAY")).alias("feature_date"), "fraud_rate_30d")
    stream = payloads(spark, sf, event_stream(spark, sf)).select("value")
    report = stream_batch_skew(spark, raw, stream, customers, late="60 days").drop("skew_pct")
    report = rounded(report, "max_apart")
    return rounded(report, "offline_mean", "online_mean", digits=4)


@query(
    "committed_batches",
    sql(
        f"SELECT transaction_id, customer_id, amount_usd, {text_ts_sql('transaction_ts')} AS ts, event_id % 3 AS batch_id FROM silver",
        "silver",
    ),
)
def _(spark, sf):
    """Three micro-batches over all days, one of them repeated, with compactions between; each event is there once."""
    path = shared_dir(spark, "committed")
    rows = silver(spark, sf).select("transaction_id", "customer_id", "transaction_ts", "amount_usd")
    for batch, before in ((0, None), (1, "2024-01-20"), (1, "2024-01-20"), (2, "2024-01-10")):
        append_batch(rows.filter(F.col("transaction_id").cast("long") % 3 == batch), path, batch)
        if before:
            compact_days(spark, path, before)
    drop_replaced(spark, path)
    df = read_committed(spark, path)
    return df.select("transaction_id", "customer_id", "amount_usd", text_ts("transaction_ts").alias("ts"), "batch_id")


@query(
    "latency_incremental",
    sql(
        f"""SELECT {pick_sql(0.5)} AS p50, {pick_sql(0.95)} AS p95, {pick_sql(0.99)} AS p99, count(ms) AS n,
  {pick_sql(0.95)} < 2000 AS target_met FROM latency_ms""",
        "latency_ms",
    ),
)
def _(spark, sf):
    """Latencies in three batches, each folded into the state when it is there, and once more without news."""
    sink, state = shared_dir(spark, "latency"), shared_dir(spark, "latency-state")
    e = F.col("event_id")
    ms = e * 37 % 5003 + F.when(e % 3 == 0, 0).otherwise(250)
    rows = table(spark, sf, "events").select("event_id", F.when(e % 17 != 0, ms).alias("latency_ms"))
    for batch in range(3):
        write_batch(rows.filter(e % 3 == batch).select("latency_ms"), sink, batch)
        fold_latencies(spark, sink, state)
    fold_latencies(spark, sink, state)
    return latency_report(spark, state)


@query(
    "stream_windowed_rate",
    f"""SELECT {text_ts_sql('w')} AS window_start, count(*) AS n, {rs('count(*) / 3600.0')} AS per_second
  FROM (SELECT date_trunc('hour', ts) AS w, max(ts) OVER () AS newest FROM events)
  WHERE w + INTERVAL 1 HOUR <= newest - INTERVAL 10 MINUTE GROUP BY w""",
)
def _(spark, sf):
    """Windows closed by the watermark."""
    rows = silver(spark, sf, event_stream(spark, sf))
    df = _drain(spark, rate_stream(rows, "transaction_ts", "1 hour"))
    return rounded(df, "per_second").withColumn("window_start", text_ts("window_start"))


@query("forest_anomaly_scores")
def _(spark, sf):
    df = training_set(silver(spark, sf))
    path = shared_dir(spark, "training")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    scored = score_isolation_forest(df, fit_isolation_forest(df))
    return anomaly_table(spark, scored, shared_dir(spark, "scores"))


@query("classifier_scores")
def _(spark, sf):
    path = shared_dir(spark, "training")
    training_set(silver(spark, sf)).write.parquet(path)
    df = spark.read.parquet(path)
    saved = shared_dir(spark, "model")
    train_and_evaluate(spark, df, saved, together=16)
    return assess(boosting.score(df, boosting.load(spark, saved))).select(
        "transaction_id", "score", "risk_level", F.concat_ws("|", "top_risk_factors").alias("reasons"), "explanation"
    )


