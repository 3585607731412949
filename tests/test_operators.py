"""Single operators on small frames with known answers."""

import math
import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyrisk.functions import events, risk, timestamps
from tallyrisk.operators import asof, cleaning, ordering, quality, ranking, reports, sampling
from tallyrisk.operators.asof import Side, asof_join, asof_many
from tallyrisk.plans import gold, scoring

START = datetime(2024, 1, 14, tzinfo=timezone.utc)  # A Sunday.


# --- event features -------------------------------------------------------------


def test_temporal_edges(spark):
    hours = [0, 5, 6, 14, 21, 22, 23]
    rows = [(h, START + timedelta(hours=h)) for h in hours] + [(99, None), (100, START + timedelta(days=1, hours=12))]
    got = {
        r["id"]: r
        for r in events.temporal_features(spark.createDataFrame(rows, "id int, transaction_ts timestamp")).collect()
    }
    assert [got[h]["is_night"] for h in hours] == [1, 1, 0, 0, 0, 1, 1]
    assert got[14]["hour_of_day"] == 14 and got[14]["day_of_week"] == 1 and got[14]["is_weekend"] == 1
    assert got[100]["day_of_week"] == 2 and got[100]["is_weekend"] == 0
    assert got[99]["hour_of_day"] is None and got[99]["is_night"] == 0 and got[99]["is_weekend"] == 0


def test_amount_edges(spark):
    amounts = [5.0, 10.0, 10.01, 100.0, 1000.0, 1000.01, -100.0, 0.0, None, float("nan"), 250.0, 200.0]
    df = spark.createDataFrame(list(enumerate(amounts)), "id int, amount_usd double")
    got = [tuple(r)[2:] for r in events.amount_features(df).orderBy("id").collect()]
    buckets = ["0-10", "0-10", "10-100", "10-100", "100-1000", "1000+", "0-10", "0-10", "1000+", "1000+"]
    assert [g[1] for g in got[:10]] == buckets
    assert got[6][0] == 0.0 and got[6][2] == 1
    assert got[8][0] == 0.0 and got[8][2] is None
    assert math.isnan(got[9][0]) and got[9][2] == 0
    assert got[10][2] == 0 and got[11][2] == 1
    assert math.isclose(got[3][0], math.log1p(100))


def test_zscore_guards(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "amount_usd double")
    assert {r["amount_zscore"] for r in reports.amount_zscore(df).collect()} == {0.0}
    empty = reports.amount_stats(df.filter("amount_usd > 9")).first()
    assert (empty["mean"], empty["std"]) == (0.0, 1.0)
    tiny = events.amount_zscore_given(df, 4.0, 0.0).first()
    assert math.isclose(tiny["amount_zscore"], 1e6)


def test_spike_and_new_merchant(spark):
    df = spark.createDataFrame(
        [("c", "m", 3), ("c", "n", 6), ("d", "m", 10), (None, "m", None)],
        "customer_id string, merchant_id string, customer_tx_count_1h long",
    )
    history = spark.createDataFrame([("c", "m"), ("c", "m"), ("d", "q")], "customer_id string, merchant_id string")
    got = {
        (r["customer_id"], r["merchant_id"]): (r["is_velocity_spike"], r["is_new_merchant"])
        for r in gold.risk_flags(df, history).collect()
    }
    assert got == {("c", "m"): (0, 0), ("c", "n"): (1, 1), ("d", "m"): (1, 1), (None, "m"): (0, 1)}
    bare = gold.risk_flags(df.drop("customer_tx_count_1h")).collect()
    assert {(r["is_velocity_spike"], r["is_new_merchant"]) for r in bare} == {(0, 0)}


def test_decoding(spark):
    row = spark.range(1).select(
        timestamps.from_offset_seconds(F.lit(86400)).alias("a"),
        timestamps.from_step_hours(F.lit(2_000_000)).alias("b"),
        timestamps.from_epoch_ms(F.lit(1704067200123)).alias("c"),
    ).first()
    assert row["a"] == datetime(2017, 12, 1)
    assert row["b"] == datetime(2017, 1, 1) + timedelta(hours=2_000_000)
    assert row["c"] == datetime(2024, 1, 1, 0, 0, 0, 123000)


# --- cleaning -------------------------------------------------------------------


def test_impute_and_fill(spark):
    df = spark.createDataFrame(
        [(1.0, None, None), (3.0, None, "x"), (None, None, None), (100.0, None, None)], "a double, b double, c string"
    )
    got = cleaning.fill_constants(cleaning.impute_median(df, ["a", "b", "z"]), {"c": "UNKNOWN", "z": -999.0})
    rows = sorted(map(tuple, got.collect()))
    assert rows == [(1.0, 0.0, "UNKNOWN"), (3.0, 0.0, "UNKNOWN"), (3.0, 0.0, "x"), (100.0, 0.0, "UNKNOWN")]


def test_clean_non_finite(spark):
    values = [1.0, None, float("nan"), math.inf, -math.inf]
    df = spark.createDataFrame([(v, i or None) for i, v in enumerate(values)], "a double, b int")
    assert [tuple(r) for r in cleaning.clean_non_finite(df, ["a", "b"]).collect()] == [
        (1.0, 0), (0.0, 1), (0.0, 2), (0.0, 3), (0.0, 4)
    ]


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS at")
    out = cleaning.dedup_first(df, ["k"], ["at"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    before, after = plan.rindex("WindowGroupLimit"), plan.rindex("Exchange")
    assert before > after and "Partial" in plan[before:]
    assert sorted(map(tuple, out.collect())) == [(0, 0), (1, 1), (2, 2)]


def test_validation_reasons(spark):
    df = spark.createDataFrame(
        [(10.0, 3, 1, 0, 1, 0), (0.0, 24, 0, 2, 1, 0), (None, 3, 7, 0, 0, 0), (float("nan"), 3, 7, 0, 0, 0)],
        "amount double, hour_of_day int, day_of_week int, is_weekend int, is_night int, is_round_amount int",
    )
    good, bad = quality.validate(df, quality.score_request_rules())
    assert good.count() == 1
    assert {tuple(r.reasons) for r in bad.collect() if len(r.reasons) == 1} == {("amount missing",), ("amount not positive",)}
    assert bad.filter("amount = 0").first()["reasons"] == [
        "amount not positive", "hour out of range", "weekday out of range", "is_weekend not a flag"
    ]


def test_a_missing_required_field_is_a_reason(spark):
    df = spark.createDataFrame([("t", None)], "transaction_id string, amount double")
    checked = quality.check_rows(df, quality.required("transaction_id", "amount"))
    assert checked.first()["reasons"] == ["amount missing"]


# --- point-in-time join -----------------------------------------------------------


@pytest.mark.parametrize("ttl", [None, 3600])
def test_asof_equals_brute_force(spark, ttl):
    rnd = random.Random(3)

    def when():
        return START + timedelta(seconds=rnd.choice([rnd.randrange(20_000), 900 * rnd.randrange(20)]))

    keys = ["hot"] * 5 + ["a", None]
    left = [(i, rnd.choice(keys), rnd.choice([None, when(), when(), when()])) for i in range(200)]
    right = [(i, rnd.choice(keys), rnd.choice([None, when(), when(), when()]), rnd.choice([None, 1.5])) for i in range(200)]
    got = asof_join(
        spark.createDataFrame(left, "id int, k string, ts timestamp"),
        spark.createDataFrame(right, "rid int, k string, ts timestamp, v double"),
        ["k"], "ts", "ts", ["rid", "v"], ttl_s=ttl, prefix="r_", tie=["rid"],
    )
    assert got.columns == ["id", "k", "ts", "r_rid", "r_v"]
    rows = {r["id"]: (r["r_rid"], r["r_v"]) for r in got.collect()}
    assert len(rows) == len(left)
    for i, k, ts in left:
        best = (None, None)
        fits = [
            r for r in right
            if None not in (k, ts, r[2]) and r[1] == k and r[2] <= ts and (ttl is None or (ts - r[2]).total_seconds() <= ttl)
        ]
        if fits:
            newest = max(fits, key=lambda r: (r[2], r[0]))
            best = (newest[0], newest[3])
        assert rows[i] == best


def test_asof_window_is_cut_in_time(spark):
    df = spark.range(10).selectExpr("'hot' k", "timestamp_seconds(id) ts", "id v")
    plan = asof_join(df, df, ["k"], "ts", "ts", ["v"])._jdf.queryExecution().executedPlan().toString()
    row_windows = [line for line in plan.splitlines() if "Window [" in line and "_hit" in line]
    assert row_windows and all("_slice" in line.rsplit("[", 2)[1] for line in row_windows)


def _many_sides(spark, tables, ttl):
    a, b, c = tables
    return [
        Side("first", a, ("k",), "ts", ("rid", "v"), ttl, ("rid",)),
        Side("second", b, ("k",), "ts", ("rid", "v"), None, ("v", "rid")),
        Side("third", c, ("k", "other"), "ts", ("v",), 3600),
    ]


@pytest.mark.parametrize("ttl", [None, 600])
def test_asof_of_many_tables_equals_one_after_the_other(spark, ttl):
    rnd = random.Random(11)

    def rows(n):
        when = lambda: START + timedelta(seconds=rnd.choice([rnd.randrange(20_000), 900 * rnd.randrange(20)]))
        keys = ["hot"] * 5 + ["a", None]
        return [(i, rnd.choice(keys), rnd.choice([None, when(), when(), when()]), rnd.choice([None, 1.5, 2.0]), rnd.choice("xy")) for i in range(n)]

    frame = lambda n, id: spark.createDataFrame(rows(n), f"{id} int, k string, ts timestamp, v double, other string")
    left, tables = frame(200, "id"), [frame(150, "rid"), frame(90, "rid"), frame(60, "rid").dropDuplicates(["k", "other", "ts"])]
    sides = _many_sides(spark, tables, ttl)
    got = asof_many(left, "id", "ts", sides)
    want = left
    for s in sides:
        want = asof_join(want, s.table, s.by, "ts", "ts", list(s.features), s.ttl_s, f"{s.name}_", s.tie)
    flat = got.select(*left.columns, *[F.col(s.name)[c].alias(f"{s.name}_{c}") for s in sides for c in s.features])
    assert flat.columns == want.columns and flat.count() == 200
    assert sorted(map(str, flat.collect())) == sorted(map(str, want.collect()))
    assert asof_many(left.limit(0), "id", "ts", sides).count() == 0
    alone = asof_many(left, "id", "ts", [Side(s.name, s.table.limit(0), s.by, s.ts, s.features) for s in sides])
    assert alone.count() == alone.where("first IS NULL AND second IS NULL AND third IS NULL").count() == 200


def test_asof_of_many_tables_moves_wide_rows_once(spark):
    df = spark.range(10).selectExpr("'hot' k", "'x' other", "timestamp_seconds(id) ts", "id v", "id rid")
    left = spark.range(10).selectExpr("id", "'hot' k", "'x' other", "timestamp_seconds(id) ts", "repeat('wide', 9) wide")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = asof_many(left, "id", "ts", _many_sides(spark, [df, df, df], 60))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = []
    for line in plan.splitlines():
        if "Exchange hashpartitioning(" in line:
            exchanges.append(line.split("hashpartitioning(")[1].split("#")[0])
    # Per set of keys one exchange by slice; wide rows and hits meet by row id.
    assert sum(e.startswith("id") for e in exchanges) == 1
    windows = [line for line in plan.splitlines() if "Window [" in line and "_slice" in line.rsplit("[", 2)[1]]
    assert len(windows) == 2


def test_asof_of_many_tables_deals_by_the_number_of_rows(spark, monkeypatch):
    """More rows make more tasks, not larger ones, whatever the session's number of partitions."""
    monkeypatch.setattr(asof, "TASK_ROWS", 10)
    df = spark.range(10).selectExpr("'k' || id k", "'x' || id % 2 other", "timestamp_seconds(id) ts", "id v", "id rid")
    left = spark.range(195).selectExpr("id", "'k' || id % 10 k", "'x' || id % 2 other", "timestamp_seconds(id) ts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = asof_many(left, "id", "ts", _many_sides(spark, [df, df, df], None))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = {int(n) for n in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", plan)}
    assert dealt == {20}
    assert found.where("first IS NOT NULL").count() == 195


# --- global order ------------------------------------------------------------------


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rnd = random.Random(5)
    values = [rnd.choice([0.5, 0.25, rnd.random(), rnd.random() ** 9]) for _ in range(3000)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = ordering.running_totals(df, "v", {"k": F.lit(1).cast("long")}, descending).collect()
    want, total = {}, 0
    known = [v for v in values if v is not None]
    for v in sorted(set(known), reverse=descending):
        total += known.count(v)
        want[v] = (known.count(v), total)
    assert {r["v"]: (r["k"], r["cum_k"]) for r in got} == want


def test_floor_percentiles(spark):
    rnd = random.Random(42)
    values = [int(rnd.gauss(300, 50)) for _ in range(100)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "ms long")
    row = ordering.floor_percentiles(df, "ms", [0.5, 0.95, 0.99]).first()
    ranked = sorted(values)
    assert tuple(row) == (ranked[50], ranked[95], ranked[99], 100)
    empty = ordering.floor_percentiles(df.filter("ms < 0"), "ms", [0.5]).first()
    assert tuple(empty) == (None, 0)


@pytest.mark.parametrize("n, fraction, distinct", [(1000, 0.01, 1000), (1000, 0.05, 3), (7, 0.01, 7), (500, 0.5, 1)])
def test_top_fraction_is_exact(spark, n, fraction, distinct):
    df = spark.range(n).selectExpr("cast(id AS string) id", f"pmod(xxhash64(id), {distinct}) / 7.0D s")
    flagged = ordering.top_fraction_flag(df, "s", "id", fraction)
    top = max(1, int(n * fraction))
    rows = flagged.collect()
    assert len(rows) == n and sum(r["anomaly_label"] for r in rows) == top
    lowest = min(r["s"] for r in rows if r["anomaly_label"])
    assert all(r["anomaly_label"] for r in rows if r["s"] > lowest)
    again = ordering.top_fraction_flag(df.repartition(5), "s", "id", fraction)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in rows}


def test_split_and_sample_sizes(spark):
    df = spark.range(5000).selectExpr("cast(id AS string) transaction_id", "int(id % 50 = 0) is_fraud")
    split = sampling.stratified_split(df)
    counts = {(r["is_fraud"], r["split"]): r["count"] for r in split.groupBy("is_fraud", "split").count().collect()}
    assert counts == {(0, "test"): 980, (0, "train"): 3920, (1, "test"): 20, (1, "train"): 80}
    sample = {r["is_fraud"]: r["count"] for r in sampling.balanced_sample(df).groupBy("is_fraud").count().collect()}
    assert sample == {1: 100, 0: 500}
    # More wanted than there are: all of them.
    assert sampling.balanced_sample(df, ratio=99).count() == 5000


# --- score quality --------------------------------------------------------------------


def test_curves_on_a_hand_made_case(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.4, 0), (0.1, 0), (None, 1), (0.3, None)]
    df = spark.createDataFrame(rows, "score double, is_fraud int")
    # Pairs: positive 0.9 beats three; positive 0.8 beats two and ties with one.
    assert math.isclose(ranking.roc_auc(df).first()[0], 5.5 / 6)
    assert math.isclose(ranking.average_precision(df).first()[0], 0.5 * 1 + 0.5 * 2 / 3)
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in ranking.roc_points(df).collect()}
    assert points[0.8] == (1 / 3, 1.0) and points[0.1] == (1.0, 1.0)
    report = {r["threshold"]: (r["tp"], r["fp"], r["fn"]) for r in ranking.threshold_report(df, [0.5, 0.95]).collect()}
    assert report == {0.5: (2, 1, 0), 0.95: (0, 0, 2)}
    assert ranking.roc_auc(df.filter("is_fraud = 1")).first()[0] is None


def test_bucket_quantile_edges(spark):
    df = spark.createDataFrame([(0.02,)] * 5 + [(0.07,)] * 4 + [(9.0,)], "s double")
    buckets = reports.le_buckets(df, "s", reports.LATENCY_BOUNDS)
    assert {r["le"]: r["n"] for r in buckets.collect()}[0.05] == 5
    assert math.isclose(reports.bucket_quantile(buckets, 0.25).first()[0], 0.025)
    assert math.isclose(reports.bucket_quantile(buckets, 0.7).first()[0], 0.05 + 0.05 * 2 / 4)
    assert reports.bucket_quantile(buckets, 0.99).first()[0] == 5.0


def test_skew_report(spark):
    base = spark.createDataFrame([(1.0, 0.0), (3.0, 0.0)], "a double, b double")
    other = spark.createDataFrame([(2.1, 9.0)], "a double, b double")
    got = {r["feature"]: (r["skew_pct"], r["status"]) for r in reports.skew_report(base, other, ["a", "b"]).collect()}
    assert got == {"a": (5.0, "FAIL"), "b": (0.0, "PASS")}


# --- reasons and texts ------------------------------------------------------------------

REQUEST = {
    "score": 0.91, "hour_of_day": 2, "is_night": 1, "is_weekend": 1, "amount_log1p": math.log1p(500.0),
    "amount_zscore": 3.14, "is_round_amount": 1, "customer_tx_count_1h": 8, "fraud_rate_30d": 0.125,
    "is_velocity_spike": 1, "amount_vs_mean_ratio": 3.2,
}


def one(spark, **changes):
    values = {**REQUEST, **changes}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def test_reasons_in_priority_order(spark):
    got = risk.risk_factors_a(one(spark), k=9).first()["top_risk_factors"]
    assert got == [
        "High transaction velocity (8 tx in 1h)",
        "Night-time transaction (02:00h)",
        "Round amount ($500.00)",
        "Amount 3.2x above baseline",
        "High historical fraud rate (12.5% over 30d)",
        "Unusual amount (z-score=3.1)",
    ]
    assert risk.risk_factors_a(one(spark)).first()["top_risk_factors"] == got[:3]
    calm = dict(is_velocity_spike=0, is_night=0, is_round_amount=0, amount_vs_mean_ratio=None, fraud_rate_30d=0.05)
    got = risk.risk_factors_a(one(spark, **calm, amount_zscore=-2.5, customer_tx_count_1h=5)).first()
    assert got["top_risk_factors"] == ["Elevated 1h velocity (5 tx in 1h)"]
    got = risk.risk_factors_a(one(spark, **calm, amount_zscore=0.0, customer_tx_count_1h=0)).first()
    assert got["top_risk_factors"] == ["Anomalous feature combination (score=0.91)"]


def test_signals_and_fallback(spark):
    row = risk.fallback_record(risk.risk_factors_b(one(spark))).first()
    assert row["signals"].split("\n")[:2] == [
        "1. VELOCITY SPIKE — 8 txns in 1 hour",
        "2. UNUSUAL AMOUNT — +3.1 standard deviations",
    ]
    assert row["risk_factors"][-1] == "AMOUNT SPIKE — 3.2x above customer average"
    assert row["summary"] == "Transaction flagged at 91.0% confidence. Manual review required."
    quiet = one(
        spark, is_velocity_spike=0, amount_zscore=-2.0, is_night=0, fraud_rate_30d=0.0, is_round_amount=0,
        amount_vs_mean_ratio=3.0,
    )
    assert risk.risk_factors_b(quiet).first()["risk_factors"] == [risk.NO_SIGNAL]
    low = risk.risk_factors_b(one(spark, amount_zscore=-3.14)).first()["signals"]
    assert "— -3.1 standard" in low


@pytest.mark.parametrize("score, level", [(0.0, "low"), (0.3, "medium"), (0.6, "high"), (0.85, "critical"), (1.0, "critical")])
def test_levels(spark, score, level):
    row = scoring.assess(one(spark, score=score)).first()
    assert row["risk_level"] == level
    assert (row["explanation"] is None) == (score <= 0.3)
    if score > 0.5:
        assert row["explanation"].startswith("Transaction flagged as high risk (score=")
