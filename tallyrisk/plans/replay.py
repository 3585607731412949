"""Batch features against what the stream made of the same events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.functions.timestamps import from_epoch_ms
from tallyrisk.operators.asof import asof_join
from tallyrisk.operators.cleaning import entity_means, mean_ratio
from tallyrisk.operators.reports import SKEW_FEATURES, keyed_skew
from tallyrisk.plans.feature_store import CUSTOMER_VIEW
from tallyrisk.plans.gold import model_inputs
from tallyrisk.schemas import STREAM_EVENT
from tallyrisk.session import shared_dir
from tallyrisk.sources.readers import parse_events
from tallyrisk.streaming.ingest import Sinks
from tallyrisk.streaming.live import ingest_live


def as_transactions(raw: DataFrame) -> DataFrame:
    """The usable events of JSON payloads, named as in the transaction table."""
    good, _ = parse_events(raw, STREAM_EVENT)
    return good.withColumn("transaction_ts", from_epoch_ms(F.col("transaction_ts"))).withColumnRenamed("amount", "amount_usd")


def served(events: DataFrame, customers: DataFrame, means: DataFrame) -> DataFrame:
    """Streamed events with what a scorer looks up beside them: the customer's newest rate and mean amount.

    ``customers`` has customer_id, feature_date and fraud_rate_30d; a customer
    without a fresh row has rate 0.
    """
    rates = customers.select("customer_id", "feature_date", "fraud_rate_30d")
    found = asof_join(events, rates, ["customer_id"], "transaction_ts", "feature_date", ["fraud_rate_30d"], CUSTOMER_VIEW.ttl_s)
    joined = found.fillna(0.0, ["fraud_rate_30d"]).join(means, "customer_id", "left")
    return joined.withColumn("amount_vs_mean_ratio", mean_ratio())


def stream_batch_skew(
    spark: SparkSession,
    raw: DataFrame,
    stream: DataFrame,
    customers: DataFrame,
    limit_pct: float = 1.0,
    mean: float | None = None,
    std: float | None = None,
    late: str = "2 days",
) -> DataFrame:
    """Run the events of ``stream`` through the live ingest job and compare its features with the batch's, row by row.

    ``raw`` holds the same payloads (column ``value``) as a table.  The stream
    gets the batch's mean and deviation of the amount unless others are given.
    """
    path = shared_dir(spark, "replay-batch")
    as_transactions(raw).write.parquet(path)
    table = spark.read.parquet(path)
    offline = model_inputs(table).select("transaction_id", *SKEW_FEATURES)
    known = table.agg(F.mean("amount_usd").alias("mean"), F.stddev("amount_usd").alias("std")).first()
    sinks = Sinks(*[shared_dir(spark, f"replay-{name}") for name in ("events", "latency", "rejects")])
    ingest_live(
        stream,
        sinks,
        shared_dir(spark, "replay-checkpoint"),
        known["mean"] if mean is None else mean,
        known["std"] if std is None else std,
        trigger=None,
        late=late,
    ).start().awaitTermination()
    online = served(spark.read.parquet(sinks.events), customers, entity_means(table))
    return keyed_skew(offline, online, "transaction_id", SKEW_FEATURES, limit_pct)
