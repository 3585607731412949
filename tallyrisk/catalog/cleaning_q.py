"""Source, sink, cleaning and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrisk.catalog.inputs import as_of, cards, identity, payloads, scored, silver, table, transfers
from tallyrisk.catalog.registry import cte, query, r, rounded, rs, sql, text_ts, text_ts_sql
from tallyrisk.functions.events import CHANNEL_OF_TYPE, map_category
from tallyrisk.functions.risk import FLAG_ABOVE
from tallyrisk.functions.timestamps import (
    CARD_EPOCH,
    TRANSFER_EPOCH,
    from_epoch_ms,
    from_offset_seconds,
    from_step_hours,
)
from tallyrisk.operators import cleaning, quality, sketches
from tallyrisk.plans import silver as silver_plan
from tallyrisk.plans.gold import fraud_labels
from tallyrisk.plans.scoring import flagged_only
from tallyrisk.schemas import STREAM_EVENT
from tallyrisk.session import shared_dir
from tallyrisk.sources import buckets as writers_b
from tallyrisk.sources import job_metrics, readers, writers

#: Medians as exact as the given tables need; the sketch keeps all their values.
EXACT = None


# --- sources and sinks -------------------------------------------------------

_EVENT_SQL = f"SELECT event_id, {text_ts_sql('ts')} AS ts, user_id, event_type, value, props FROM events"


@query("csv_roundtrip", _EVENT_SQL)
def _(spark, sf):
    path = shared_dir(spark, "csv")
    df = table(spark, sf, "events").withColumn("ts", text_ts(F.col("ts").cast("timestamp")))
    df.write.option("header", "true").option("escape", '"').csv(path)
    return readers.read_csv(spark, path, df.schema)


@query(
    "csv_scan",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END AS flag FROM lineitem""",
)
def _(spark, sf):
    path = shared_dir(spark, "csv")
    part = F.col("l_partkey")
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(part % 7 != 0, F.col("l_extendedprice")).alias("price"),
        F.when(part % 11 != 0, F.col("l_returnflag")).alias("flag"),
    )
    df.write.option("header", "true").csv(path)
    return readers.read_csv(spark, path, df.schema)


@query("sample_head", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 1000")
def _(spark, sf):
    return readers.read_sample(spark, f"{sf}/events.parquet", "event_id", 1000).select(
        "event_id", "event_type", "value"
    )


@query(
    "bronze_append",
    """SELECT o_orderkey, o_totalprice, day AS _ingest_date FROM (SELECT *, unnest(['2024-01-01', '2024-01-02'])
  AS day FROM orders)""",
)
def _(spark, sf):
    path = shared_dir(spark, "bronze")
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    for day in ("2024-01-01", "2024-01-02"):
        stamped = cleaning.add_audit_columns(df, "orders.parquet", "batch001", F.lit(day).cast("timestamp"))
        writers.write_table(stamped, path, "append", ["_ingest_date"])
    back = spark.read.option("recursiveFileLookup", "false").schema(
        "o_orderkey long, o_totalprice double, _ingest_date string"
    )
    return back.parquet(path)


@query(
    "audit_columns",
    """SELECT o_orderkey, '2024-01-01 06:30:00.000000' AS _ingest_ts, 'orders.parquet' AS _source_file,
  'batch001' AS _batch_id, '2024-01-01' AS _ingest_date FROM orders""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey")
    at = F.lit("2024-01-01 06:30:00").cast("timestamp")
    out = cleaning.add_audit_columns(df, "orders.parquet", "batch001", at)
    return out.withColumn("_ingest_ts", text_ts("_ingest_ts"))


@query(
    "gold_overwrite_roundtrip",
    sql("SELECT merchant_id, count(*) AS n FROM silver WHERE is_fraud = 1 GROUP BY merchant_id", "silver"),
)
def _(spark, sf):
    path = shared_dir(spark, "gold")
    df = silver(spark, sf).select("transaction_id", "merchant_id", "is_fraud")
    writers.write_table(df, path, "overwrite", ["is_fraud"])
    # The second overwrite must leave nothing of the first.
    writers.write_table(df.filter(F.col("is_fraud") == 1), path, "overwrite", ["is_fraud"])
    return spark.read.parquet(path).groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "upsert_merge",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  (SELECT count(*) FROM orders WHERE o_orderkey % 6 = 0) AS updated,
  (SELECT count(*) FROM orders WHERE o_orderkey % 6 = 3) AS inserted
  FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0""",
)
def _(spark, sf):
    first, second = shared_dir(spark, "upsert"), shared_dir(spark, "upsert")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    key = F.col("o_orderkey")
    writers.upsert(spark, orders.filter(key % 2 == 0), first, ["o_orderkey"], first)
    source = orders.filter(key % 3 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    counts = writers.upsert(spark, source, first, ["o_orderkey"], second)
    return spark.read.parquet(second).withColumns(
        {
            "updated": F.lit(counts["rows_updated"]).cast("long"),
            "inserted": F.lit(counts["rows_inserted"]).cast("long"),
        }
    )


@query(
    "upsert_buckets",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 300 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  (SELECT count(*) FROM orders WHERE o_orderkey % 300 = 0 AND o_orderkey % 7 <> 1) AS updated,
  (SELECT count(*) FROM orders WHERE o_orderkey % 300 = 0 AND o_orderkey % 7 = 1) AS inserted, true AS rest_untouched
  FROM orders WHERE o_orderkey % 7 <> 1 OR o_orderkey % 300 = 0""",
)
def _(spark, sf):
    """A table in buckets, then a small change to it; only buckets of changed keys are of the new version."""
    path = shared_dir(spark, "buckets")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    writers_b.upsert_buckets(spark, orders.filter(key % 7 != 1), path, ["o_orderkey"], 256)
    changed = orders.filter(key % 300 == 0).withColumn("o_totalprice", price + 1)
    counts = writers_b.upsert_buckets(spark, changed, path, ["o_orderkey"])
    named = changed.select(writers_b.bucket_of(["o_orderkey"], 256).alias("b")).distinct().collect()
    now = writers_b.version(spark, path)["buckets"]
    untouched = {int(b) for b, v in now.items() if v == 1} == {r["b"] for r in named}
    return writers_b.read_buckets(spark, path).withColumns(
        {
            "updated": F.lit(counts["rows_updated"]).cast("long"),
            "inserted": F.lit(counts["rows_inserted"]).cast("long"),
            "rest_untouched": F.lit(untouched),
        }
    )


_CLUSTERED = ["user_id", "ts"]


def _clustered(spark, sf):
    small, large = shared_dir(spark, "small"), shared_dir(spark, "large")
    table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).repartition(8, "event_id").write.parquet(small)
    writers.cluster(spark, small, large, _CLUSTERED, files=64)
    return spark.read.parquet(large)


@query("cluster_roundtrip", f"SELECT event_id, user_id, event_type, value, {text_ts_sql('ts')} AS ts FROM events")
def _(spark, sf):
    return _clustered(spark, sf).select("event_id", "user_id", "event_type", "value", text_ts("ts").alias("ts"))


@query("cluster_skips_files", "SELECT unnest(['user_id', 'ts']) AS filtered, true AS half_skipped")
def _(spark, sf):
    """For a filter on one value of a column: whether on average over all rows at least half of the files can be skipped."""
    df = _clustered(spark, sf).withColumn("file", F.input_file_name())
    ends = df.groupBy("file").agg(*[f(c).alias(f"{n}_{c}") for c in _CLUSTERED for n, f in (("lo", F.min), ("hi", F.max))])
    out = None
    for c in _CLUSTERED:
        values = df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        # 64 rows, one for each file.
        met = values.join(F.broadcast(ends), F.col("value").between(F.col(f"lo_{c}"), F.col(f"hi_{c}")))
        share = F.sum("n") / (ends.agg(F.count(F.lit(1))).scalar() * df.agg(F.count(F.lit(1))).scalar())
        part = met.agg((share <= 0.5).alias("half_skipped")).select(F.lit(c).alias("filtered"), "half_skipped")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "medians_by_load",
    """SELECT 'l_quantity' AS "column", count(l_quantity) AS n, true AS within FROM lineitem
  UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), true FROM lineitem
  UNION ALL SELECT 'l_tax', count(l_tax), true FROM lineitem""",
)
def _(spark, sf):
    """Medians of three columns from four loads' sketches; within: half a percent of the rows from the exact rank."""
    path, columns = shared_dir(spark, "sketches"), ["l_quantity", "l_extendedprice", "l_tax"]
    rows = table(spark, sf, "lineitem")
    for load in range(4):
        sketches.add_load(rows.filter(F.col("l_orderkey") % 4 == load), columns, path, load)
    found = sketches.quantiles_of_loads(spark, path).collect()
    below = [
        rows.agg(
            F.lit(r["column"]).alias("column"),
            F.lit(r["n"]).cast("long").alias("n"),
            ((F.avg((F.col(r["column"]) < r["value"]).cast("double")) <= 0.505)
             & (F.avg((F.col(r["column"]) <= r["value"]).cast("double")) >= 0.495)).alias("within"),
        )
        for r in found
    ]
    return below[0].unionByName(below[1]).unionByName(below[2])


@query("compact_roundtrip", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    small, large = shared_dir(spark, "small"), shared_dir(spark, "large")
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    df.repartition(16).write.parquet(small)
    writers.compact(spark, small, large, ["user_id", "event_type"], files=2)
    return spark.read.parquet(large)


@query("table_row_count", "SELECT 'events' AS name, count(*) AS n FROM events UNION ALL SELECT 'orders', count(*) FROM orders")
def _(spark, sf):
    counts = [
        table(spark, sf, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name in ("events", "orders")
    ]
    return counts[0].unionByName(counts[1])


@query(
    "job_metrics_status",
    f"""SELECT event_type AS job, {rs('count(*) * 60 / ((max(epoch(ts)) - min(epoch(ts))))')} AS measured,
  cast(0.046 AS double) AS target, CASE WHEN count(*) * 60 / (max(epoch(ts)) - min(epoch(ts))) >= 0.046 THEN 'met'
  ELSE 'below-target' END AS status FROM events GROUP BY event_type""",
)
def _(spark, sf):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = (F.max(micros) - F.min(micros)) / 1_000_000
    jobs = table(spark, sf, "events").groupBy(F.col("event_type").alias("job")).agg(
        job_metrics.rows_per_minute(F.count(F.lit(1)), seconds).alias("measured")
    )
    jobs = jobs.withColumns({"target": F.lit(0.046), "direction": F.lit("min")})
    return job_metrics.metric_status(jobs).select("job", r("measured").alias("measured"), "target", "status")


# --- decoding and projections --------------------------------------------------


@query(
    "decode_offset_seconds",
    sql(f"""SELECT "TransactionID", {text_ts_sql('make_timestamp(("TransactionDT" + 1512000000) * 1000000)')} AS ts FROM cards""", "cards"),
)
def _(spark, sf):
    return cards(spark, sf).select(
        "TransactionID", text_ts(from_offset_seconds(F.col("TransactionDT"), CARD_EPOCH)).alias("ts")
    )


@query(
    "decode_step_hours",
    sql(
        f"""SELECT "nameOrig", step, {text_ts_sql('make_timestamp((step::bigint * 3600 + 1483228800) * 1000000)')} AS ts FROM transfers""",
        "transfers",
    ),
)
def _(spark, sf):
    return transfers(spark, sf).select(
        "nameOrig", "step", text_ts(from_step_hours(F.col("step"), TRANSFER_EPOCH)).alias("ts")
    )


@query("decode_epoch_ms", f"SELECT event_id, {text_ts_sql('date_trunc($$milliseconds$$, ts)')} AS ts FROM events")
def _(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", text_ts(from_epoch_ms(ms)).alias("ts"))


@query(
    "channel_map",
    sql(
        """SELECT type, CASE WHEN type IN ('PAYMENT', 'DEBIT') THEN 'pos' WHEN type = 'TRANSFER' THEN 'transfer'
  WHEN type IN ('CASH_OUT', 'CASH_IN') THEN 'atm' ELSE 'other' END AS channel, count(*) AS n FROM transfers GROUP BY 1, 2""",
        "transfers",
    ),
)
def _(spark, sf):
    df = transfers(spark, sf).withColumn("channel", map_category(F.col("type"), CHANNEL_OF_TYPE, "other"))
    return df.groupBy("type", "channel").agg(F.count(F.lit(1)).alias("n"))


CONFORM_A_SQL = f"""SELECT cast("TransactionID" AS varchar) AS transaction_id, cast(card1 AS varchar) AS customer_id,
  'merchant_' || "ProductCD" AS merchant_id,
  {text_ts_sql('make_timestamp(("TransactionDT" + 1512000000) * 1000000)')} AS transaction_ts, "TransactionAmt" AS amount_usd,
  'USD' AS currency, 'card' AS channel, "ProductCD" AS merchant_category, card6 AS card_type, "isFraud" AS is_fraud,
  'ieee_cis' AS data_source, {text_ts_sql('ingest')} AS _ingest_ts, '2024-02-01 00:00:00.000000' AS _silver_ts"""


def as_text(df):
    """Timestamps as text."""
    return df.withColumns({c: text_ts(c) for c in ("transaction_ts", "_ingest_ts", "_silver_ts")})


@query("conform_a", sql(CONFORM_A_SQL + " FROM cards", "cards"))
def _(spark, sf):
    df = cards(spark, sf).withColumn("transaction_ts", from_offset_seconds(F.col("TransactionDT")))
    return as_text(silver_plan.conform_cards(df, as_of()))


CONFORM_B_SQL = f"""SELECT 'PS_' || sha256('["' || "nameOrig" || '","' || step || '","' || cast(amount AS varchar) || '"]')
  AS transaction_id, "nameOrig" AS customer_id, "nameDest" AS merchant_id,
  {text_ts_sql('make_timestamp((step::bigint * 3600 + 1483228800) * 1000000)')} AS transaction_ts, amount AS amount_usd,
  'USD' AS currency, CASE WHEN type IN ('PAYMENT', 'DEBIT') THEN 'pos' WHEN type = 'TRANSFER' THEN 'transfer'
  WHEN type IN ('CASH_OUT', 'CASH_IN') THEN 'atm' ELSE 'other' END AS channel, type AS merchant_category,
  'transfer' AS card_type, "isFraud" AS is_fraud, 'paysim' AS data_source,
  '2024-02-01 00:00:00.000000' AS _ingest_ts, '2024-02-01 00:00:00.000000' AS _silver_ts"""


@query("conform_b", sql(CONFORM_B_SQL + " FROM transfers", "transfers"))
def _(spark, sf):
    df = transfers(spark, sf).withColumns(
        {
            "transaction_ts": from_step_hours(F.col("step")),
            "channel": map_category(F.col("type"), CHANNEL_OF_TYPE, "other"),
        }
    )
    return as_text(silver_plan.conform_transfers(df, as_of()))


@query("filter_not_null", sql("SELECT transaction_id, is_fraud FROM silver WHERE is_fraud IS NOT NULL", "silver"))
def _(spark, sf):
    return silver(spark, sf).filter(F.col("is_fraud").isNotNull()).select("transaction_id", "is_fraud")


@query("filter_label", sql("SELECT transaction_id, amount_usd FROM silver WHERE is_fraud = 1", "silver"))
def _(spark, sf):
    return silver(spark, sf).filter("is_fraud = 1").select("transaction_id", "amount_usd")


@query("flagged_only", sql(f"SELECT transaction_id, score FROM scored WHERE score > {FLAG_ABOVE}", "scored"))
def _(spark, sf):
    return flagged_only(scored(spark, sf)).select("transaction_id", "score")


@query("drop_null_label", sql("SELECT transaction_id, amount_usd, is_fraud FROM silver WHERE is_fraud IS NOT NULL", "silver"))
def _(spark, sf):
    return silver(spark, sf).dropna(subset=["is_fraud"]).select("transaction_id", "amount_usd", "is_fraud")


@query(
    "fill_constants",
    sql(
        """SELECT "TransactionID", "TransactionAmt", coalesce("C1", -999) AS "C1", coalesce("ProductCD", 'UNKNOWN')
  AS "ProductCD", coalesce(card6, 'UNKNOWN') AS card6, "V1" FROM cards""",
        "cards",
    ),
)
def _(spark, sf):
    fills = {"C1": -999.0, "C2": -999.0, "ProductCD": "UNKNOWN", "card6": "UNKNOWN", "DeviceType": "UNKNOWN"}
    df = cleaning.fill_constants(cards(spark, sf), fills)
    return df.select("TransactionID", "TransactionAmt", "C1", "ProductCD", "card6", "V1")


MEDIAN_COLS = ["V1", "V2", "V3", "D1"]


@query(
    "column_medians",
    sql("SELECT " + ", ".join(f'quantile_disc("{c}", 0.5) AS "{c}"' for c in MEDIAN_COLS) + " FROM cards", "cards"),
)
def _(spark, sf):
    return cleaning.column_medians(cards(spark, sf), MEDIAN_COLS, EXACT)


@query(
    "impute_median",
    sql(
        'SELECT "TransactionID", "TransactionAmt", '
        + ", ".join(
            f'coalesce("{c}", (SELECT quantile_disc("{c}", 0.5) FROM cards), 0.0) AS "{c}"' for c in MEDIAN_COLS
        )
        + " FROM cards",
        "cards",
    ),
)
def _(spark, sf):
    df = cleaning.impute_median(cards(spark, sf), [*MEDIAN_COLS, "V9"], EXACT)
    return df.select("TransactionID", "TransactionAmt", *MEDIAN_COLS)


@query(
    "clean_non_finite",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 10 < 4 THEN 0.0 ELSE l_extendedprice END AS x,
  CASE WHEN l_partkey % 6 = 0 THEN 0 ELSE l_linenumber END AS k FROM lineitem""",
)
def _(spark, sf):
    part = F.col("l_partkey")
    x = (
        F.when(part % 10 == 0, F.lit(float("inf")))
        .when(part % 10 == 1, F.lit(float("-inf")))
        .when(part % 10 == 2, F.lit(float("nan")))
        .when(part % 10 > 3, F.col("l_extendedprice"))
    )
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        x.alias("x"),
        F.when(part % 6 != 0, F.col("l_linenumber")).alias("k"),
    )
    return cleaning.clean_non_finite(df, ["x", "k"])


# --- joins, deduplication, whole cleaning paths ---------------------------------

@query(
    "enrich_left_join",
    sql(
        """SELECT "TransactionID", "TransactionAmt", "DeviceType", "DeviceInfo" FROM cards
  LEFT JOIN identity USING ("TransactionID")""",
        "cards",
        "identity",
    ),
)
def _(spark, sf):
    df = cleaning.enrich(cards(spark, sf), identity(spark, sf), "TransactionID", ["DeviceType", "DeviceInfo"])
    return df.select("TransactionID", "TransactionAmt", "DeviceType", "DeviceInfo")


_FIRST = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    "dedup_keep_first",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_FIRST)}) = 1""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_FIRST)
    first = cleaning.dedup_first(df, ["l_orderkey", "l_linenumber"], _FIRST)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "dedup_stats",
    """SELECT count(*) AS pre_count, count(DISTINCT (l_orderkey, l_linenumber)) AS post_count,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed FROM lineitem""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    after = cleaning.dedup_first(df, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return cleaning.dedup_stats(df, after)


_U3 = """QUALIFY row_number() OVER (PARTITION BY "nameOrig", step, amount
  ORDER BY type, "nameDest", "isFraud") = 1"""


@query(
    "dedup_subset",
    sql(f'SELECT "nameOrig", step, amount, type, "nameDest", "isFraud" FROM transfers {_U3}', "transfers"),
)
def _(spark, sf):
    df = silver_plan.dedup_transfers(transfers(spark, sf))
    return df.select("nameOrig", "step", "amount", "type", "nameDest", "isFraud")


cte(
    "clean_cards",
    """SELECT * FROM (SELECT "TransactionID", "TransactionDT", "TransactionAmt",
  coalesce("ProductCD", 'UNKNOWN') AS "ProductCD", card1, coalesce(card6, 'UNKNOWN') AS card6, "isFraud", ingest
  FROM cards LEFT JOIN identity USING ("TransactionID"))
  QUALIFY row_number() OVER (PARTITION BY "TransactionID"
  ORDER BY "TransactionDT", "TransactionAmt", "ProductCD", card1, card6, "isFraud", ingest) = 1""",
    ("cards", "identity"),
)
cte("clean_transfers", f"SELECT * FROM transfers {_U3}", ("transfers",))


# Every other column of the card table, filled and enriched.
cte(
    "wide",
    """SELECT "TransactionID", "TransactionDT", "TransactionAmt", coalesce("ProductCD", 'UNKNOWN') AS "ProductCD",
  coalesce(card4, 'UNKNOWN') AS card4, coalesce(card6, 'UNKNOWN') AS card6, coalesce("C1", -999) AS "C1", "D1", "V1",
  "V2", "V3", coalesce("DeviceType", 'UNKNOWN') AS "DeviceType", "DeviceInfo"
  FROM cards LEFT JOIN identity USING ("TransactionID")""",
    ("cards", "identity"),
)
_WIDE = ["TransactionID", "TransactionAmt", "ProductCD", "card4", "card6", "C1", "DeviceType", "DeviceInfo"]


@query(
    "prepare_a",
    sql(
        "SELECT "
        + ", ".join(f'"{c}"' for c in _WIDE)
        + ", "
        + ", ".join(f'coalesce("{c}", (SELECT quantile_disc("{c}", 0.5) FROM wide), 0.0) AS "{c}"' for c in MEDIAN_COLS)
        + f""", {text_ts_sql('make_timestamp(("TransactionDT" + 1512000000) * 1000000)')} AS transaction_ts FROM wide""",
        "wide",
    ),
)
def _(spark, sf):
    df = silver_plan.prepare_cards(cards(spark, sf), identity(spark, sf), accuracy=EXACT)
    return df.select(*_WIDE, *MEDIAN_COLS, text_ts("transaction_ts").alias("transaction_ts"))


@query("clean_a", sql(CONFORM_A_SQL + " FROM clean_cards", "clean_cards"))
def _(spark, sf):
    return as_text(silver_plan.clean_cards(cards(spark, sf), as_of()))


@query("clean_b", sql(CONFORM_B_SQL + " FROM clean_transfers", "clean_transfers"))
def _(spark, sf):
    return as_text(silver_plan.clean_transfers(transfers(spark, sf), as_of()))


@query(
    "silver_union",
    sql(
        f"{CONFORM_A_SQL} FROM clean_cards UNION ALL BY NAME {CONFORM_B_SQL} FROM clean_transfers",
        "clean_cards",
        "clean_transfers",
    ),
)
def _(spark, sf):
    a = silver_plan.clean_cards(cards(spark, sf), as_of())
    b = silver_plan.clean_transfers(transfers(spark, sf), as_of())
    return as_text(silver_plan.silver_table(a, b))


@query(
    "fraud_labels",
    sql(
        f"""SELECT transaction_id, customer_id, {text_ts_sql('transaction_ts')} AS transaction_ts, is_fraud, data_source,
  '2024-02-01 00:00:00.000000' AS label_ts FROM silver WHERE is_fraud IS NOT NULL""",
        "silver",
    ),
)
def _(spark, sf):
    df = fraud_labels(silver(spark, sf), as_of())
    return df.withColumns({c: text_ts(c) for c in ("transaction_ts", "label_ts")})


# --- validation ------------------------------------------------------------------

_REQUIRED_SQL = """FROM payloads WHERE well_formed AND transaction_id IS NOT NULL"""


@query(
    "json_expand",
    sql(
        f"""SELECT transaction_id, customer_id, merchant_id, amount, currency, channel, merchant_category,
  transaction_ts, producer_ts, is_fraud {_REQUIRED_SQL}""",
        "payloads",
    ),
)
def _(spark, sf):
    good, _bad = readers.parse_events(payloads(spark, sf), STREAM_EVENT)
    return good.drop("lat", "lon", "device_fingerprint")


@query(
    "json_rejects",
    sql(
        """SELECT CASE WHEN NOT well_formed THEN 'malformed' ELSE 'transaction_id missing' END AS reason, count(*) AS n
  FROM payloads WHERE NOT well_formed OR transaction_id IS NULL GROUP BY 1""",
        "payloads",
    ),
)
def _(spark, sf):
    _good, bad = readers.parse_events(payloads(spark, sf), STREAM_EVENT)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _validated(spark, sf):
    good, _bad = readers.parse_events(payloads(spark, sf), STREAM_EVENT)
    return quality.validate(good, quality.event_rules())


cte(
    "reasons",
    f"""SELECT transaction_id, list_filter([CASE WHEN merchant_id IS NULL THEN 'merchant_id missing' END,
  CASE WHEN amount < 0 THEN 'amount negative' END, CASE WHEN channel = 'fax' THEN 'channel unknown' END],
  lambda x: x IS NOT NULL) AS reasons {_REQUIRED_SQL}""",
    ("payloads",),
)


@query(
    "validate_rows",
    sql("SELECT transaction_id, list_aggregate(reasons, 'string_agg', ';') AS reasons FROM reasons WHERE len(reasons) > 0", "reasons"),
)
def _(spark, sf):
    _good, bad = _validated(spark, sf)
    return bad.select("transaction_id", F.concat_ws(";", "reasons").alias("reasons"))


@query(
    "valid_rows",
    sql("SELECT transaction_id FROM reasons WHERE len(reasons) = 0", "reasons"),
)
def _(spark, sf):
    good, _bad = _validated(spark, sf)
    return good.select("transaction_id")


@query(
    "quarantine_counts",
    sql("SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM reasons) GROUP BY reason", "reasons"),
)
def _(spark, sf):
    _good, bad = _validated(spark, sf)
    return quality.quarantine_counts(bad)


@query(
    "score_request_checks",
    sql(
        """SELECT transaction_id, concat_ws(';', CASE WHEN NOT (amount_zscore > 0) THEN 'amount not positive' END,
  CASE WHEN hour_of_day - 1 NOT BETWEEN 0 AND 23 THEN 'hour out of range' END,
  CASE WHEN day_of_week + 1 NOT BETWEEN 1 AND 7 THEN 'weekday out of range' END,
  CASE WHEN is_night * 2 NOT IN (0, 1) THEN 'is_night not a flag' END) AS reasons FROM scored""",
        "scored",
    ),
)
def _(spark, sf):
    df = scored(spark, sf).withColumns(
        {
            "amount": F.col("amount_zscore"),
            "hour_of_day": F.col("hour_of_day") - 1,
            "day_of_week": F.col("day_of_week") + 1,
            "is_night": F.col("is_night") * 2,
        }
    )
    checked = quality.check_rows(df, quality.score_request_rules())
    return checked.select("transaction_id", F.concat_ws(";", "reasons").alias("reasons"))


NULL_COLS = ["ProductCD", "card4", "card6", "C1", "D1", "V1", "V2", "V3", "TransactionAmt"]
cte(
    "null_rates",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", avg(CASE WHEN "{c}" IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate FROM cards"""
        for c in NULL_COLS
    ),
    ("cards",),
)


@query("null_rates", sql(f'SELECT "column", {rs("null_rate")} AS null_rate FROM null_rates', "null_rates"))
def _(spark, sf):
    return rounded(quality.null_rates(cards(spark, sf), NULL_COLS), "null_rate")


@query(
    "null_profile",
    sql(
        f"""SELECT "column", {rs('null_rate')} AS null_rate,
  (SELECT count(*) FROM null_rates WHERE null_rate > 0.5) AS high_null_columns,
  (SELECT {rs('median(null_rate)')} FROM null_rates) AS median_null_rate FROM null_rates""",
        "null_rates",
    ),
)
def _(spark, sf):
    df = quality.null_profile(cards(spark, sf), NULL_COLS)
    return rounded(df, "null_rate", "median_null_rate")
