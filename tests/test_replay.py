"""Stream output against batch output, row by row."""

import pytest

from tallyrisk.catalog.inputs import event_stream, payloads
from tallyrisk.operators.reports import SKEW_FEATURES, keyed_skew
from tallyrisk.plans.replay import stream_batch_skew


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([], "customer_id string, feature_date timestamp, fraud_rate_30d double")


def test_a_wrong_statistic_in_the_stream_is_found(spark, sf, customers):
    def report(**given):
        stream = payloads(spark, sf, event_stream(spark, sf)).select("value")
        rows = stream_batch_skew(spark, payloads(spark, sf).select("value"), stream, customers, late="60 days", **given)
        return {r["feature"]: r for r in rows.collect()}

    good, wrong = report(), report(mean=50.0, std=10.0)
    assert set(good) == set(SKEW_FEATURES) and all(r["n"] > 0 for r in good.values())
    assert {f for f, r in good.items() if r["n_different"]} == {"fraud_rate_30d"}
    assert {f for f, r in wrong.items() if r["n_different"]} == {"fraud_rate_30d", "amount_zscore"}
    assert wrong["amount_zscore"]["status"] == "FAIL" and wrong["amount_zscore"]["n_different"] == wrong["amount_zscore"]["n"]
    assert good["amount_log1p"]["status"] == wrong["customer_tx_count_24h"]["status"] == "PASS"


def test_rows_that_differ_or_are_missing_are_counted_though_the_means_agree(spark):
    schema = "k string, x double, y double"
    base = spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, None), ("c", 3.0, 1.0), (None, 5.0, 1.0)], schema)
    other = spark.createDataFrame([("b", 1.0, 1.0), ("a", 2.0, 1.0), ("c", 3.0, 1.0), ("d", 5.0, 1.0)], schema)
    x, y = sorted(keyed_skew(base, other, "k", ["x", "y"]).collect(), key=lambda r: r["feature"])
    assert (x["n"], x["n_offline_only"], x["n_online_only"], x["n_different"], x["max_apart"]) == (3, 1, 1, 2, 1.0)
    assert x["skew_pct"] == 0 and x["status"] == "FAIL"
    assert (y["n_different"], y["max_apart"]) == (1, 0.0)
    same = keyed_skew(base.where("k <> 'd'"), base.where("k IS NOT NULL"), "k", ["x"]).first()
    assert (same["status"], same["n_different"]) == ("PASS", 0)
    assert keyed_skew(base.limit(0), other.limit(0), "k", ["x"]).first()["n"] == 0
