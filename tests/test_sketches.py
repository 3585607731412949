"""Stored quantile sketches and distinct windows from slices, against exact results."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyrisk.operators.sketches import add_load, distinct_by_slices, quantile_sketches, quantiles_of_loads

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.mark.parametrize("share", [0.05, 0.5, 0.99])
def test_quantiles_of_loads_are_near_the_exact_rank(spark, tmp_path, share):
    rnd = random.Random(4)
    loads = [[(rnd.random() ** 9, float(rnd.randrange(5)), None) for _ in range(n)] for n in (20_000, 5, 0, 30_000)]
    for k, rows in enumerate(loads):
        df = spark.createDataFrame([*rows, (None, float("nan"), None)], "x double, y double, z double")
        add_load(df, ["x", "y", "z"], str(tmp_path), k)
    add_load(spark.createDataFrame(loads[0], "x double, y double, z double"), ["x", "y", "z"], str(tmp_path), 0)
    got = {r["column"]: r for r in quantiles_of_loads(spark, str(tmp_path), share).collect()}
    for j, c in enumerate("xy"):
        values = [r[j] for rows in loads for r in rows]
        assert got[c]["n"] == len(values)
        below, upto = (sum(f(v, got[c]["value"]) for v in values) / len(values) for f in (float.__lt__, float.__le__))
        assert below - 0.005 <= share <= upto + 0.005
    assert (got["z"]["n"], got["z"]["value"]) == (0, 0.0)


def test_many_columns_in_one_pass(spark):
    df = spark.range(100).select("id", *[(F.col("id") * k).cast("double").alias(f"V{k}") for k in range(354)])
    sketches = quantile_sketches(df, [f"V{k}" for k in range(354)])
    plan = sketches._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 100") == 1 and sketches.count() == 354


def test_distinct_windows_are_within_the_sketch_error(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice(["hot", "hot", "a", None]), START + timedelta(hours=rnd.randrange(240)), rnd.choice([None, *range(3000)])) for _ in range(20_000)]
    rows += [("b", START, 1), ("b", START + timedelta(days=6), 2), ("b", START + timedelta(days=7), 3), ("c", None, 1), ("d", START, None)]
    df = spark.createDataFrame(rows, "e string, ts timestamp, p long")
    got = {(r["e"], r["slice"]): r["n"] for r in distinct_by_slices(df, "e", "ts", "p", 7, name="n").collect()}
    first = int(START.timestamp()) // 86_400
    days = {(e, int(ts.timestamp()) // 86_400) for e, ts, _ in rows if e and ts}
    assert got.keys() == days
    for e, day in days:
        exact = len({p for x, ts, p in rows if x == e and ts and p is not None and day - 6 <= int(ts.timestamp()) // 86_400 <= day})
        assert abs(got[e, day] - exact) <= max(0, 0.06 * exact)
    assert (got["b", first + 6], got["b", first + 7], got["d", first]) == (2, 2, 0)
