"""Readers, sinks and the feature store."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyrisk.plans import feature_store as store
from tallyrisk.sources import readers, writers

AT = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)


def test_csv_nulls_nan_and_bad_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x,s\n1,NaN,a\n2,,\nthree,1.5,c\n")
    schema = spark.createDataFrame([], "id long, x double, s string").schema
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), schema, corrupt_column="_bad").orderBy("x").collect()
    assert [r["s"] for r in got] == [None, "c", "a"]
    assert got[2]["x"] != got[2]["x"]
    assert got[1]["id"] is None and got[1]["_bad"] == "three,1.5,c"
    missing = str(tmp_path / "none.csv")
    assert readers.read_csv(spark, missing, schema, optional=True).count() == 0
    assert readers.read_csv(spark, missing, schema, fallback=str(tmp_path / "*.csv")).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_csv(spark, missing, schema).count()


def test_read_features_skips_absent_optional_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id", "id * 2 AS a").write.parquet(path)
    assert readers.read_features(spark, path, ["a"], ["id", "nope"]).columns == ["id", "a"]
    assert [r["id"] for r in readers.read_sample(spark, path, "id", 2).collect()] == [0, 1]


def test_overwrite_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(4).selectExpr("id", "id % 2 AS p"), path, "overwrite", ["p"])
    writers.write_table(spark.range(1).selectExpr("id", "7 AS p"), path, "overwrite", ["p"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(0, 7)]
    more = spark.range(2).selectExpr("id", "8 AS p")
    writers.write_table(more, path, "overwrite", ["p"], only_partitions=True)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(0, 7), (0, 8), (1, 8)]
    writers.write_table(spark.range(2).selectExpr("'x' AS name"), path, replace_schema=True)
    assert spark.read.parquet(path).columns == ["name"]
    assert writers.row_count(spark, path) == 2


def test_upsert_counts_and_duplicate_keys(spark, tmp_path):
    first, second = str(tmp_path / "1"), str(tmp_path / "2")
    schema = "k int, v string"
    target = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    assert writers.upsert(spark, target, first, ["k"], first)["operation"] == "WRITE"
    source = spark.createDataFrame([(2, "B"), (3, "C"), (4, None)], schema)
    counts = writers.upsert(spark, source, first, ["k"], second)
    assert counts == {"operation": "MERGE", "rows_inserted": 2, "rows_updated": 1}
    assert sorted(map(str, spark.read.parquet(second).collect())) == sorted(
        map(str, spark.createDataFrame([(1, "a"), (2, "B"), (3, "C"), (4, None)], schema).collect())
    )
    with pytest.raises(ValueError, match="duplicate keys"):
        writers.upsert(spark, source.unionByName(source), first, ["k"], second)


def test_compact_makes_few_clustered_files(spark, tmp_path):
    small, large = str(tmp_path / "s"), str(tmp_path / "l")
    # One value holds two thirds of the rows.
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, id, -1) AS k")
    df.repartition(20).write.parquet(small)
    writers.compact(spark, small, large, ["k"], files=4)
    per_file = [
        r["count"] for r in spark.read.parquet(large).groupBy(F.input_file_name()).count().collect()
    ]
    assert len(per_file) == 4 and max(per_file) < 1500 and sum(per_file) == 3000


def view_rows(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, feature_date timestamp, tx_count_1d long")


VIEW = store.FeatureView("v", "customer_id", "feature_date", 7 * 86400, store.CUSTOMER_VIEW.features)


def at(day):
    return F.lit(f"2024-01-{day:02d} 12:00:00").cast("timestamp")


def day(n):
    return AT.replace(day=n)


def test_materialize_is_incremental_and_repeatable(spark, tmp_path):
    source = view_rows(spark, [("a", day(1), 1), ("a", day(3), 3), ("b", day(2), 2), ("b", day(5), 5), ("c", day(9), 9)])
    paths = [str(tmp_path / str(i)) for i in range(4)]
    first = store.materialize(spark, VIEW, source, paths[0], paths[0], None, at(3))
    assert first["rows_inserted"] == 2
    second = store.materialize(spark, VIEW, source, paths[0], paths[1], at(3), at(6))
    assert (second["rows_inserted"], second["rows_updated"]) == (0, 1)
    again = store.materialize(spark, VIEW, source, paths[1], paths[2], at(3), at(6))
    assert (again["rows_inserted"], again["rows_updated"]) == (0, 0)
    # A late run over old rows must not bring them back.
    late = store.materialize(spark, VIEW, source, paths[2], paths[3], None, at(2))
    assert late["rows_updated"] == 0
    got = {r["customer_id"]: r["tx_count_1d"] for r in spark.read.parquet(paths[3]).collect()}
    assert got == {"a": 3, "b": 5}


def test_online_lookup_ttl(spark):
    online = view_rows(spark, [("a", day(1), 1), ("b", day(8), 2), ("c", day(20), 3)])
    requests = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "customer_id string")
    got = store.online_lookup(requests, online, VIEW, at(8), ["tx_count_1d"])
    # Exactly seven days old is still served; a row from the future is not.
    assert {tuple(r) for r in got.collect()} == {("a", 1), ("b", 2), ("c", None), ("d", None)}
    later = store.online_lookup(requests, online, VIEW, F.lit("2024-01-08 12:00:01").cast("timestamp"), ["tx_count_1d"])
    assert {tuple(r) for r in later.collect()} == {("a", None), ("b", 2), ("c", None), ("d", None)}


def test_views_and_services():
    assert [len(v.columns) for v in store.VIEWS.values()] == [12, 6, 14]
    assert [len(c) for c in store.SERVING_SERVICE.columns.values()] == [4, 2, 7]
    names = store.output_names(store.SERVING_SERVICE)
    assert names["customer_features"]["fraud_rate_30d"] == "customer_features__fraud_rate_30d"
    assert names["merchant_features"]["avg_amount_7d"] == "avg_amount_7d"


def test_view_problems(spark):
    df = view_rows(spark, []).withColumn("tx_count_7d", F.lit("x"))
    problems = VIEW.problems(df)
    assert "missing tx_count_30d" in problems and "tx_count_7d: string is not bigint" in problems
    assert not any("tx_count_1d" in p for p in problems)
