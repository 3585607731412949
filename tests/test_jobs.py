"""The batch jobs end to end on small raw files."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tallyrisk.operators.rolling import velocity
from tallyrisk.plans import jobs
from tallyrisk.plans.gold import merchant_features, transaction_features
from tallyrisk.plans.silver import clean_cards, impute_cards, prepare_cards
from tallyrisk.schemas import (
    CARD_IDENTITY,
    CARD_TRANSACTIONS,
    CUSTOMER_FEATURES,
    MERCHANT_FEATURES,
    SILVER,
    TRANSACTION_FEATURES,
    TRANSFERS,
    conforms,
)
from tallyrisk.sources.job_metrics import metric_status, read_metrics

AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def write_inputs(tmp_path):
    names = CARD_TRANSACTIONS.fieldNames()
    header, lines = ",".join(names), []
    for i in range(100):
        values = {"TransactionID": i + 1, "isFraud": int(i < 10), "TransactionDT": 3600 * i,
                  "TransactionAmt": 10 + 5.0 * i, "ProductCD": "W", "card1": 1000 + i % 7,
                  "V1": "" if i % 2 else i}
        lines.append(",".join(str(values.get(n, "")) for n in names))
        if i < 5:  # A copy one second later.
            values["TransactionDT"] += 1
            lines.append(",".join(str(values.get(n, "")) for n in names))
    (tmp_path / "cards.csv").write_text("\n".join([header, *lines]) + "\n")
    ident = ["1", *[""] * 38, "mobile", "phone"]
    (tmp_path / "identity.csv").write_text(",".join(CARD_IDENTITY.fieldNames()) + "\n" + ",".join(ident) + "\n")
    rows = [
        f"{i + 1},PAYMENT,{100 + 10.0 * i},C{i},0,0,M{i},0,0,{int(i < 2)},0" for i in range(50)
    ] + ["1,PAYMENT,100.0,C0,5,5,M9,0,0,0,0"]
    (tmp_path / "log-2017.csv").write_text(",".join(TRANSFERS.fieldNames()) + "\n" + "\n".join(rows) + "\n")


def test_all_batch_jobs(spark, tmp_path):
    write_inputs(tmp_path)
    raw, metrics = tmp_path / "raw", str(tmp_path / "metrics")

    def land(name, schema, **more):
        return jobs.land_csv(
            spark, f"{tmp_path}/{name}.csv", schema, str(raw / name), "b1", AT, metrics_path=metrics, **more
        )

    assert land("cards", CARD_TRANSACTIONS) == 105
    assert land("identity", CARD_IDENTITY) == 1
    assert land("transfers", TRANSFERS, fallback=f"{tmp_path}/log*.csv") == 51
    assert land("absent", TRANSFERS) == 0

    silver_path = str(tmp_path / "silver")
    paths = [str(raw / n) for n in ("cards", "transfers")]
    assert jobs.build_silver(spark, *paths, silver_path, AT, metrics) == 150
    table = spark.read.parquet(silver_path)
    assert not conforms(table.schema, SILVER)
    assert table.filter("data_source = 'ieee_cis'").count() == 100
    assert table.filter("transaction_id = '1'").first()["transaction_ts"] == datetime(2017, 11, 30)
    assert table.select("transaction_id").distinct().count() == 150

    jobs.build_wide_cards(spark, str(raw / "cards"), str(raw / "identity"), str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    assert wide.count() == 105
    assert wide.filter("V1 IS NULL OR V2 <> 0.0 OR C1 <> -999.0 OR card4 <> 'UNKNOWN'").count() == 0
    assert {r["DeviceType"] for r in wide.filter("TransactionID < 3").collect()} == {"mobile", "UNKNOWN"}

    counts = jobs.build_gold(spark, silver_path, str(tmp_path / "gold"), AT, metrics)
    assert counts == {"customer_features": 57, "merchant_features": 51, "transaction_features": 150}
    wanted = {
        "customer_features": CUSTOMER_FEATURES,
        "merchant_features": MERCHANT_FEATURES,
        "transaction_features": TRANSACTION_FEATURES,
    }
    for name, schema in wanted.items():
        assert not conforms(spark.read.parquet(str(tmp_path / "gold" / name)).schema, schema)

    summary = jobs.build_labels(spark, silver_path, str(tmp_path / "labels"), AT).first()
    assert (summary["total"], summary["fraud_count"], summary["fraud_rate"]) == (150, 12, 12 / 150)

    status = metric_status(read_metrics(spark, metrics, "silver")).collect()
    assert {r["metric"]: r["measured"] for r in status}["rows"] == 150.0
    assert {r["status"] for r in status if r["metric"] == "rows"} == {"not-measured"}
    assert {r["status"] for r in status if r["metric"] == "rows_per_minute"} <= {"met", "below-target"}


def test_median_is_taken_before_deduplication(spark):
    """Copies count in the median, as they do in the original order of steps."""
    rows = [(1, 0, 0, 1.0, "W", 1, None, 1.0), (1, 0, 5, 1.0, "W", 1, None, 1.0), (1, 0, 9, 1.0, "W", 1, None, 1.0),
            (2, 0, 0, 2.0, "W", 1, None, 5.0), (3, 0, 0, 3.0, "W", 1, None, None)]
    schema = (
        "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, ProductCD string, card1 int, "
        "card6 string, V1 double"
    )
    df = spark.createDataFrame(rows, schema)
    assert impute_cards(df).filter("TransactionID = 3").first()["V1"] == 1.0
    side = spark.createDataFrame([(1, "d", "i"), (1, "d2", "i")], "TransactionID long, DeviceType string, DeviceInfo string")
    assert prepare_cards(df, side).count() == 8
    stamped = df.withColumn("_ingest_ts", F.lit(AT).cast("timestamp"))
    out = clean_cards(stamped, F.lit(AT).cast("timestamp"))
    assert out.count() == 3
    assert out.filter("transaction_id = '1'").first()["transaction_ts"] == datetime(2017, 11, 30)


def test_null_entities_and_empty_input(spark):
    schema = (
        "transaction_id string, customer_id string, merchant_id string, transaction_ts timestamp, amount_usd double, "
        "is_fraud int"
    )
    rows = [("a", None, "m", AT, 5.0, 1), ("b", None, None, AT, 7.0, None), ("c", "x", "m", AT, None, 0)]
    df = spark.createDataFrame(rows, schema)
    at = F.lit(AT).cast("timestamp")
    got = {r["transaction_id"]: r for r in transaction_features(df, at).collect()}
    assert got["a"]["customer_tx_count_1h"] == got["b"]["customer_tx_count_1h"] == 2
    assert abs(got["a"]["amount_vs_customer_mean_ratio"] - 5.0 / 100.000001) < 1e-12
    assert got["c"]["amount_bucket"] == "1000+" and got["c"]["amount_log1p"] == 0.0
    shops = merchant_features(df, at).collect()
    assert [(r["merchant_id"], r["unique_customers_7d"], r["fraud_rate_30d"]) for r in shops] == [("m", 1, 0.5)]
    none = df.limit(0)
    assert transaction_features(none, at).count() == velocity(none).count() == merchant_features(none, at).count() == 0


def test_prepare_cards_joins_once(spark):
    """Medians are taken from the enriched table as written, so no pass joins again; copies of the side table count."""
    rows = [(k, 100, None if k == 3 else float(k)) for k in range(5)]
    tx = spark.createDataFrame(rows, "TransactionID long, TransactionDT long, V1 double")
    side = spark.createDataFrame([(4, "a", "b"), (4, "c", "d"), (4, "e", "f")], "TransactionID long, DeviceType string, DeviceInfo string")
    for accuracy in (None, 10_000):
        out = prepare_cards(tx, side, accuracy=accuracy)
        assert "Join" not in out._jdf.queryExecution().toString()
        assert sorted((r.TransactionID, r.V1) for r in out.collect()) == [(0, 0), (1, 1), (2, 2), (3, 2), (4, 4), (4, 4), (4, 4)]
