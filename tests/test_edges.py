"""Inputs that the given tables do not hold: decimals, NaN, null keys, quotes, large columns."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyrisk.functions import risk
from tallyrisk.models.isolation_forest import fit_isolation_forest, score_isolation_forest, tree_samples
from tallyrisk.operators import reports
from tallyrisk.operators.ordering import percentile_name, quantiles, running_totals, values_at
from tallyrisk.operators.rolling import HOUR_S, Rolling, rolling
from tallyrisk.plans import jobs
from tallyrisk.plans.silver import clean_transfers
from tallyrisk.session import shared_dir
from tallyrisk.sources.readers import read_csv
from tallyrisk.sources.writers import compact, write_json

START = datetime(2024, 1, 1)


def test_rolling_decimals_are_exact(spark):
    rnd = random.Random(8)
    rows = [
        (k, f"c{rnd.randrange(3)}", START + timedelta(minutes=rnd.randrange(600)), Decimal(rnd.randrange(-9999, 9999)) / 100)
        for k in range(200)
    ]
    df = spark.createDataFrame(rows, "id long, who string, at timestamp, amount decimal(10,2)")
    specs = [Rolling(f, f, HOUR_S, "amount") for f in ("sum", "mean", "std")]
    got = {r.id: r for r in rolling(df, "who", "at", specs).collect()}
    for k, who, at, _ in rows:
        near = [a for _, w, t, a in rows if w == who and timedelta(0) <= at - t <= timedelta(hours=1)]
        assert got[k]["sum"] == sum(near)
        mean = float(sum(near)) / len(near)
        assert got[k]["mean"] == pytest.approx(mean, abs=1e-9)
        if len(near) > 1:
            spread = (sum((float(a) - mean) ** 2 for a in near) / (len(near) - 1)) ** 0.5
            assert got[k]["std"] == pytest.approx(spread, abs=1e-6)
        else:
            assert got[k]["std"] is None


def test_rolling_refuses_other_types(spark):
    df = spark.createDataFrame([("c", START, "1.5")], "who string, at timestamp, amount string")
    with pytest.raises(TypeError):
        rolling(df, "who", "at", [Rolling("s", "sum", HOUR_S, "amount")])


def test_transfer_ids_follow_the_key(spark):
    base = ("PAYMENT", "a", 0.0, 0.0, "m", 0.0, 0.0, 0, 0)
    amounts = [10.001, 10.002, float("nan"), None, 10.001]
    rows = [(1, base[0], x, *base[1:]) for x in amounts]
    schema = (
        "step int, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, "
        "nameDest string, oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int"
    )
    out = clean_transfers(spark.createDataFrame(rows, schema), F.lit(START).cast("timestamp"))
    assert out.count() == 4 and out.select("transaction_id").distinct().count() == 4


def test_nan_gives_no_reason(spark):
    names = ["amount_vs_mean_ratio", "fraud_rate_30d", "amount_zscore", "is_night", "customer_tx_count_1h"]
    df = spark.createDataFrame([(0.9, *[float("nan")] * 5)], "score double, " + ", ".join(f"{n} double" for n in names))
    assert risk.risk_factors_a(df).first()["top_risk_factors"] == ["Anomalous feature combination (score=0.90)"]
    assert risk.risk_factors_b(df).first()["risk_factors"] == [risk.NO_SIGNAL]


def test_gold_keeps_earlier_days(spark, tmp_path):
    silver = [
        (f"t{k}", f"c{k % 2}", "m", START + timedelta(hours=k), 5.0 + k, "USD", "web", "x", "card", k % 2, "s", START, START)
        for k in range(6)
    ]
    schema = (
        "transaction_id string, customer_id string, merchant_id string, transaction_ts timestamp, amount_usd double, "
        "currency string, channel string, merchant_category string, card_type string, is_fraud int, data_source string, "
        "_ingest_ts timestamp, _silver_ts timestamp"
    )
    path, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    spark.createDataFrame(silver, schema).write.parquet(path)
    for day in (2, 3, 3):
        jobs.build_gold(spark, path, out, datetime(2024, 1, day))
    kept = spark.read.parquet(f"{out}/customer_features").groupBy("feature_date").count().collect()
    assert [r["count"] for r in kept] == [2, 2]


def test_csv_quotes_and_breaks(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b\n"say ""hi"", ok",1\n"two\nlines",2\n')
    df = read_csv(spark, str(path), spark.createDataFrame([], "a string, b int").schema, multi_line=True)
    assert [tuple(r) for r in df.orderBy("b").collect()] == [('say "hi", ok', 1), ("two\nlines", 2)]


def test_landing_names_the_file_that_was_read(spark, tmp_path):
    (tmp_path / "other.csv").write_text("a\nx\n")
    schema = spark.createDataFrame([], "a string").schema
    out = str(tmp_path / "raw")
    jobs.land_csv(spark, str(tmp_path / "gone.csv"), schema, out, "b", START, fallback=str(tmp_path / "other.csv"))
    assert spark.read.parquet(out).first()["_source_file"] == "other.csv"


def test_quantiles_are_exact_beyond_the_sketch(spark):
    n = 60_001
    df = spark.range(n).select(
        ((F.col("id") * 7919) % n).cast("double").alias("a"), (F.col("id") % 3).alias("b"), F.lit(None).cast("double").alias("c")
    )
    for q in (0.0, 0.25, 0.5, 0.999, 1.0):
        got = quantiles(df, ["a", "b", "c"], q, accuracy=100)
        at = max(1, math.ceil(Fraction(str(q)) * n)) - 1
        assert got == {"a": float(at), "b": sorted(k % 3 for k in range(n))[at], "c": None}


def test_quantiles_of_balanced_heavy_values(spark):
    """A rank between two heavy values is settled by counting, at any accuracy."""
    n = 20_000
    df = spark.range(n).select(
        (F.col("id") % 2).alias("a"),
        F.when(F.col("id") % 2 == 0, -0.5).when(F.col("id") == 77, 0.25).otherwise(float("nan")).alias("b"),
        F.when(F.col("id") < 3, F.col("id")).otherwise(9).alias("c"),
    )
    for rank, want in ((1, [0, -0.5, 0]), (3, [0, -0.5, 2]), (4, [0, -0.5, 9]), (n // 2, [0, -0.5, 9]), (n // 2 + 1, [1, 0.25, 9])):
        found, sizes = values_at(df, {c: (c, lambda _: rank) for c in "abc"}, accuracy=50)
        assert [found[c] for c in "abc"] == want and sizes == dict.fromkeys("abc", n)
    found, _ = values_at(df, {c: (c, lambda n: n) for c in "abc"}, accuracy=50)
    assert (found["a"], found["c"]) == (1, 9) and math.isnan(found["b"])


def test_ranges_and_names(spark):
    df = spark.range(500).select((F.col("id") % 97).alias("v"))
    got = {r.v: r.cum_k for r in running_totals(df, "v", {"k": F.lit(1).cast("long")}, ranges=8).collect()}
    assert got[96] == 500 and got[0] == sum(k % 97 == 0 for k in range(500))
    with pytest.raises(ValueError):
        running_totals(df, "v", {"k": F.lit(1)}, ranges=6)
    assert [percentile_name(q) for q in (0.5, 0.99, 0.994, 0.999)] == ["p50", "p99", "p99_4", "p99_9"]


def test_histogram_spans_the_data(spark):
    df = spark.createDataFrame([(0, -5.0), (0, 0.0), (1, 5.0), (1, float("nan")), (0, None)], "is_fraud int, v double")
    got = {(r.is_fraud, r.bin): r.n for r in reports.histogram(df, F.col("v"), "is_fraud", 10).collect()}
    assert got == {(0, 1): 1, (0, 6): 1, (1, 10): 1}


@pytest.mark.parametrize("rows", [40, 300, 2100, 3000])
def test_every_tree_gets_its_rows(spark, rows):
    df = spark.range(rows).select(F.col("id").cast("string").alias("transaction_id"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    got = tree_samples(df, ["a"], "transaction_id", 30, 256, 1).groupBy("_tree").count().collect()
    assert len(got) == 30 and min(r["count"] for r in got) >= min(256, rows)
    forest = fit_isolation_forest(df, ["a", "b"], trees=10).cache()
    assert {r["size"] for r in forest.select("size").distinct().collect()} == {min(256, rows)}
    scores = score_isolation_forest(df, forest, ["a", "b"]).agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0 < scores[0] < scores[1] < 1


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key.rsplit(".", 2)[-2] + key.rsplit(".", 1)[-1], default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    with pytest.raises(ValueError):
        shared_dir(Session(sparkmaster="spark://host:7077"), "x")
    with pytest.raises(ValueError):
        shared_dir(Session(sparkmaster="local-cluster[2,1,1024]"), "x")
    assert shared_dir(Session(sparkmaster="local[4]"), "x")
    assert shared_dir(Session(sparkmaster="yarn", checkpointdir="hdfs:///s"), "x").startswith("hdfs:///s/x-")


def test_compact_derives_files_from_size(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(20_000).repartition(12).write.parquet(path)
    compact(spark, path, str(tmp_path / "few"))
    compact(spark, path, str(tmp_path / "more"), ["id"], file_bytes=40_000)
    few, more = (len(list((tmp_path / d).glob("part-*"))) for d in ("few", "more"))
    assert few == 1 < more < 12


def test_write_json(spark, tmp_path):
    write_json(spark.createDataFrame([(1, "a")], "k int, v string"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().asDict() == {"k": 1, "v": "a"}
