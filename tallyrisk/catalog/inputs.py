"""The tables the queries run on: transaction data derived from the given tables.

Each frame has a common table expression of the same name for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.catalog.registry import cte
from tallyrisk.functions.timestamps import CARD_EPOCH
from tallyrisk.operators.cleaning import conform

AS_OF = "2024-02-01 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream."""
    return spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events.parq*")


def silver(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Events (given or the table) as the cleaned transaction table."""
    label = (
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("int"))
        .when(F.col("event_id") % 20 == 0, F.lit(1))
        .otherwise(F.lit(0))
    )
    ts = F.col("ts").cast("timestamp")
    return conform(
        table(spark, sf, "events") if events is None else events,
        {
            "transaction_id": F.col("event_id").cast("string"),
            "customer_id": F.col("user_id").cast("string"),
            "merchant_id": F.col("event_type"),
            "transaction_ts": ts,
            "amount_usd": F.col("value"),
            "currency": F.lit("USD"),
            "channel": F.lit("web"),
            "merchant_category": F.col("event_type"),
            "card_type": F.lit("debit"),
            "is_fraud": label,
            "data_source": F.lit("events"),
            "_ingest_ts": ts,
            "_silver_ts": ts,
        },
    )


cte(
    "silver",
    """SELECT cast(event_id AS varchar) AS transaction_id, cast(user_id AS varchar) AS customer_id,
  event_type AS merchant_id, ts AS transaction_ts, value AS amount_usd, 'USD' AS currency, 'web' AS channel,
  event_type AS merchant_category, 'debit' AS card_type,
  cast(CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 20 = 0 THEN 1 ELSE 0 END AS integer) AS is_fraud,
  'events' AS data_source, cast(floor(epoch(ts)) AS bigint) AS s, event_id FROM events""",
)

#: A repeatable score in [0, 1) with many ties and no value on a rounding edge.
_SCORE = "(event_id * 7919 % 997) / 997.0"


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a repeatable score and risk features."""
    return silver(spark, sf).withColumn("_e", F.col("transaction_id").cast("long")).select(
        "transaction_id",
        "customer_id",
        "merchant_id",
        "transaction_ts",
        "is_fraud",
        ((F.col("_e") * 7919 % 997).cast("double") / 997.0).alias("score"),
        (F.col("_e") % 10 == 0).cast("int").alias("is_velocity_spike"),
        (F.col("_e") % 8).alias("customer_tx_count_1h"),
        F.hour("transaction_ts").alias("hour_of_day"),
        F.dayofweek("transaction_ts").alias("day_of_week"),
        F.dayofweek("transaction_ts").isin(1, 7).cast("int").alias("is_weekend"),
        ((F.hour("transaction_ts") >= 22) | (F.hour("transaction_ts") < 6)).cast("int").alias("is_night"),
        (F.col("_e") % 15 == 0).cast("int").alias("is_round_amount"),
        F.log1p("amount_usd").alias("amount_log1p"),
        F.when(F.col("_e") % 17 != 0, (F.col("_e") % 50).cast("double") / 10.0).alias("amount_vs_mean_ratio"),
        ((F.col("_e") % 21).cast("double") / 200.0).alias("fraud_rate_30d"),
        (((F.col("_e") % 81) - 40).cast("double") / 10.0).alias("amount_zscore"),
    )


cte(
    "scored",
    f"""SELECT transaction_id, customer_id, merchant_id, transaction_ts, is_fraud, {_SCORE} AS score,
  cast(event_id % 10 = 0 AS integer) AS is_velocity_spike, event_id % 8 AS customer_tx_count_1h,
  cast(hour(transaction_ts) AS integer) AS hour_of_day, cast(dayofweek(transaction_ts) + 1 AS integer) AS day_of_week,
  cast(dayofweek(transaction_ts) IN (0, 6) AS integer) AS is_weekend,
  cast(hour(transaction_ts) >= 22 OR hour(transaction_ts) < 6 AS integer) AS is_night,
  cast(event_id % 15 = 0 AS integer) AS is_round_amount, ln(1 + amount_usd) AS amount_log1p,
  CASE WHEN event_id % 17 <> 0 THEN (event_id % 50) / 10.0 END AS amount_vs_mean_ratio,
  (event_id % 21) / 200.0 AS fraud_rate_30d, ((event_id % 81) - 40) / 10.0 AS amount_zscore FROM silver""",
    ("silver",),
)


def cards(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as the raw card source; keys repeat, several columns have nulls."""
    part = F.col("l_partkey")

    def unless(divisor: int, value: str):
        return F.when(part % divisor != 0, F.col(value))

    ship = F.col("l_shipdate").cast("timestamp")
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("TransactionID"),
        (part % 20 == 0).cast("int").alias("isFraud"),
        (F.unix_seconds(ship) - CARD_EPOCH).alias("TransactionDT"),
        F.col("l_extendedprice").alias("TransactionAmt"),
        unless(13, "l_returnflag").alias("ProductCD"),
        F.col("l_suppkey").cast("int").alias("card1"),
        unless(5, "l_linestatus").alias("card4"),
        unless(9, "l_linestatus").alias("card6"),
        unless(6, "l_quantity").alias("C1"),
        F.when(F.col("l_suppkey") % 4 != 0, F.col("l_extendedprice")).alias("D1"),
        unless(7, "l_discount").alias("V1"),
        F.lit(None).cast("double").alias("V2"),
        unless(3, "l_tax").alias("V3"),
        ship.alias("_ingest_ts"),
    )


cte(
    "cards",
    f"""SELECT l_orderkey * 10 + l_linenumber AS "TransactionID", cast(l_partkey % 20 = 0 AS integer) AS "isFraud",
  cast(epoch(l_shipdate) AS bigint) - {CARD_EPOCH} AS "TransactionDT", l_extendedprice AS "TransactionAmt",
  CASE WHEN l_partkey % 13 <> 0 THEN l_returnflag END AS "ProductCD", cast(l_suppkey AS integer) AS card1,
  CASE WHEN l_partkey % 5 <> 0 THEN l_linestatus END AS card4, CASE WHEN l_partkey % 9 <> 0 THEN l_linestatus END AS card6,
  CASE WHEN l_partkey % 6 <> 0 THEN l_quantity END AS "C1", CASE WHEN l_suppkey % 4 <> 0 THEN l_extendedprice END AS "D1",
  CASE WHEN l_partkey % 7 <> 0 THEN l_discount END AS "V1", cast(NULL AS double) AS "V2",
  CASE WHEN l_partkey % 3 <> 0 THEN l_tax END AS "V3", l_shipdate AS ingest FROM lineitem""",
)


def identity(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of one status as the optional side table."""
    return (
        table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .select(
            (F.col("o_orderkey") * 10 + 1).alias("TransactionID"),
            F.col("o_orderpriority").alias("DeviceType"),
            F.col("o_orderstatus").alias("DeviceInfo"),
        )
    )


cte(
    "identity",
    """SELECT o_orderkey * 10 + 1 AS "TransactionID", o_orderpriority AS "DeviceType", o_orderstatus AS "DeviceInfo"
  FROM orders WHERE o_orderstatus = 'F'""",
)

_TYPES = {"1-URGENT": "PAYMENT", "2-HIGH": "TRANSFER", "3-MEDIUM": "CASH_OUT", "4-NOT SPECIFIED": "DEBIT"}


def transfers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the raw transfer source; month-wide steps give repeated keys."""
    kind = F.lit("OTHER")
    for value, name in _TYPES.items():
        kind = F.when(F.col("o_orderpriority") == value, name).otherwise(kind)
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf, "orders").select(
        ((F.unix_seconds(month) - 788918400) / 3600).cast("int").alias("step"),
        kind.alias("type"),
        (F.floor(F.col("o_totalprice") / 100000) * 100000).cast("double").alias("amount"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("nameOrig"),
        F.concat(F.lit("M"), F.col("o_orderkey") % 97).alias("nameDest"),
        (F.col("o_orderkey") % 50 == 0).cast("int").alias("isFraud"),
    )


cte(
    "transfers",
    """SELECT cast((epoch(date_trunc('month', o_orderdate)) - 788918400) / 3600 AS integer) AS step,
  CASE o_orderpriority """
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _TYPES.items())
    + """ ELSE 'OTHER' END AS type, floor(o_totalprice / 100000) * 100000 AS amount,
  'C' || o_custkey AS "nameOrig", 'M' || (o_orderkey % 97) AS "nameDest",
  cast(o_orderkey % 50 = 0 AS integer) AS "isFraud" FROM orders""",
)


def payloads(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Events (given or the table) as JSON payloads; some malformed, some without an id, some invalid."""
    e = F.col("event_id")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    body = F.to_json(
        F.struct(
            F.when(e % 13 != 0, e.cast("string")).alias("transaction_id"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.when(e % 19 != 0, F.col("event_type")).alias("merchant_id"),
            F.when(e % 23 == 0, -F.col("value")).otherwise(F.col("value")).alias("amount"),
            F.lit("USD").alias("currency"),
            F.when(e % 29 == 0, "fax").otherwise("web").alias("channel"),
            F.col("event_type").alias("merchant_category"),
            ms.alias("transaction_ts"),
            (ms + e % 700).alias("producer_ts"),
            F.when(e % 20 == 0, 1).otherwise(0).alias("is_fraud"),
        )
    )
    return (table(spark, sf, "events") if events is None else events).select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(e % 31 == 0, F.concat(F.lit("{broken "), e.cast("string"))).otherwise(body).alias("value"),
    )


cte(
    "payloads",
    """SELECT event_id, event_id % 31 <> 0 AS well_formed,
  CASE WHEN event_id % 13 <> 0 THEN cast(event_id AS varchar) END AS transaction_id,
  cast(user_id AS varchar) AS customer_id, CASE WHEN event_id % 19 <> 0 THEN event_type END AS merchant_id,
  CASE WHEN event_id % 23 = 0 THEN -value ELSE value END AS amount, 'USD' AS currency,
  CASE WHEN event_id % 29 = 0 THEN 'fax' ELSE 'web' END AS channel, event_type AS merchant_category,
  epoch_us(ts) // 1000 AS transaction_ts, epoch_us(ts) // 1000 + event_id % 700 AS producer_ts, ts,
  CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END AS is_fraud FROM events""",
)
