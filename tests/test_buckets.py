"""Bucketed upserts and clustering on several columns."""

import pytest
from pyspark.sql import functions as F

from tallyrisk.plans import feature_store as store
from tallyrisk.sources import buckets, writers


def rows(df):
    return sorted(map(str, df.collect()))


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    target = spark.range(2000).selectExpr("id", "id % 3 AS part", "concat('v', id) AS v")
    made = buckets.upsert_buckets(spark, target, path, ["id", "part"], 200)
    assert made["operation"] == "WRITE" and made["rows_inserted"] == 2000 and made["rows_updated"] == 0
    changed = spark.range(1990, 2010).selectExpr("id", "id % 3 AS part", "'new' AS v")
    done = buckets.upsert_buckets(spark, changed, path, ["id", "part"])
    assert (done["rows_updated"], done["rows_inserted"], done["operation"]) == (10, 10, "MERGE")
    of_new = [b for b, v in buckets.version(spark, path)["buckets"].items() if v == 1]
    assert len(of_new) == done["buckets_rewritten"] <= 20
    want = target.where("id < 1990").unionByName(changed)
    assert rows(buckets.read_buckets(spark, path)) == rows(want)
    # The version before is still there, until it is dropped.
    assert rows(buckets.read_buckets(spark, path, 0)) == rows(target)
    assert buckets.drop_unused(spark, path) == done["buckets_rewritten"]
    assert rows(buckets.read_buckets(spark, path)) == rows(want)


def test_the_source_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    for n in (100, 30):
        source = spark.range(n).mapInArrow(count, "id long")
        before = seen.value
        buckets.upsert_buckets(spark, source, str(tmp_path / "t"), ["id"], 8)
        assert seen.value - before == n


def test_null_keys_duplicates_and_empty_sources(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, v string"
    frame = lambda data: spark.createDataFrame(data, schema)
    buckets.upsert_buckets(spark, frame([(1, "a"), (None, "n"), (None, "n")]), path, ["k"], 4)
    done = buckets.upsert_buckets(spark, frame([(None, "m"), (1, None)]), path, ["k"])
    assert (done["rows_inserted"], done["rows_updated"]) == (1, 1)
    want = [(None, "m"), (None, "n"), (None, "n"), (1, None)]
    assert rows(buckets.read_buckets(spark, path)) == rows(frame(want))
    with pytest.raises(ValueError, match="duplicate keys"):
        buckets.upsert_buckets(spark, frame([(5, "x"), (5, "y")]), path, ["k"])
    with pytest.raises(ValueError, match="dealt by"):
        buckets.upsert_buckets(spark, frame([]), path, ["v"])
    assert buckets.upsert_buckets(spark, frame([]), path, ["k"])["buckets_rewritten"] == 0
    assert rows(buckets.read_buckets(spark, path)) == rows(frame(want))
    buckets.upsert_buckets(spark, frame([]), str(tmp_path / "empty"), ["k"])
    assert buckets.read_buckets(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(FileNotFoundError):
        buckets.read_buckets(spark, str(tmp_path / "none"))


def test_a_killed_run_and_a_second_writer_leave_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    buckets.upsert_buckets(spark, spark.range(50), path, ["id"], 4)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(buckets, "commit", killed)
        buckets.upsert_buckets(spark, spark.range(40, 90), path, ["id"])
    assert buckets.read_buckets(spark, path).count() == 50
    # A run after it starts from the table, not from what was left.
    assert buckets.upsert_buckets(spark, spark.range(49, 60), path, ["id"])["rows_inserted"] == 10
    assert buckets.read_buckets(spark, path).count() == 60
    with pytest.raises(RuntimeError, match="another run"):
        buckets.commit(spark, path, buckets.version(spark, path))
    assert buckets.read_buckets(spark, path).count() == 60


def test_materialize_keeps_newer_rows(spark, tmp_path):
    schema = "customer_id string, feature_date timestamp, tx_count_1d long"
    frame = lambda data: spark.createDataFrame(data, "c string, t string, n long").selectExpr(
        "c AS customer_id", "timestamp(t) AS feature_date", "n AS tx_count_1d"
    )
    path, end = str(tmp_path / "online"), F.lit("2024-02-01").cast("timestamp")
    first = frame([("a", "2024-01-02", 2), ("a", "2024-01-01", 1), ("b", "2024-01-05", 5), ("c", "2024-03-01", 9)])
    store.materialize_buckets(spark, store.CUSTOMER_VIEW, first, path, None, end, buckets=8)
    late = frame([("a", "2024-01-03", 3), ("b", "2024-01-04", 4), ("b", "2024-01-05", 50)])
    done = store.materialize_buckets(spark, store.CUSTOMER_VIEW, late, path, None, end)
    assert done["rows_updated"] == 1
    assert rows(buckets.read_buckets(spark, path).select("customer_id", "tx_count_1d")) == rows(
        spark.createDataFrame([("a", 3), ("b", 5)], "customer_id string, tx_count_1d long")
    )
    again = store.materialize_buckets(spark, store.CUSTOMER_VIEW, late, path, None, end)
    assert again["rows_updated"] == again["rows_inserted"] == 0
    assert set(buckets.read_buckets(spark, path).columns) == set(spark.createDataFrame([], schema).columns)


@pytest.mark.parametrize("name", ["x", "y", "s"])
def test_a_filter_on_any_clustered_column_skips_half_of_the_files(spark, tmp_path, name):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 50 <> 0 THEN pmod(xxhash64(id), 1000) END AS x",
                                        "pmod(xxhash64(id, 5), 1000) / 7.0D AS y", "concat('k', pmod(xxhash64(id, 6), 300)) AS s")
    df.repartition(5).write.parquet(str(tmp_path / "in"))
    writers.cluster(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["x", "y", "s"], files=64)
    out = spark.read.parquet(str(tmp_path / "out")).withColumn("file", F.input_file_name())
    assert rows(out.drop("file")) == rows(df)
    ends = out.groupBy("file").agg(F.min(name).alias("lo"), F.max(name).alias("hi")).collect()
    probes = [r[0] for r in df.where(F.col(name).isNotNull()).select(name).limit(50).collect()]
    met = [sum(e["lo"] is not None and e["lo"] <= p <= e["hi"] for e in ends) for p in probes]
    assert sum(met) / len(met) <= len(ends) / 2


def test_cluster_of_an_empty_table_and_one_value(spark, tmp_path):
    for k, df in enumerate([spark.range(0), spark.range(100).selectExpr("cast(NULL AS long) AS id")]):
        df.write.parquet(str(tmp_path / f"in{k}"))
        writers.cluster(spark, str(tmp_path / f"in{k}"), str(tmp_path / f"out{k}"), ["id"], files=3)
        assert spark.read.schema("id long").parquet(str(tmp_path / f"out{k}")).count() == df.count()
