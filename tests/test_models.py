"""Models: learning, scoring, repeatability."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.models import classifier
from tallyrisk.models.isolation_forest import (
    anomaly_table,
    expected_path,
    fit_isolation_forest,
    score_isolation_forest,
    tree_samples,
)
from tallyrisk.operators.ranking import roc_auc
from tallyrisk.schemas import ANOMALY_SCORES, MODEL_FEATURES, conforms

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def points(spark):
    """2,000 normal points, of which every 100th is moved far out."""
    rnd = np.random.default_rng(42)
    values = rnd.normal(0, 1, (2000, 3))
    values[::100] *= 10
    values[::100] += 8 * np.sign(values[::100])
    rows = [(f"t{i}", *map(float, v), int(i % 100 == 0)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "transaction_id string, a double, b double, c double, is_fraud int").cache()


def test_expected_path():
    assert expected_path(1) == 0 and expected_path(2) == 1
    assert abs(float(expected_path(256)) - 10.244770920116851) < 1e-9


def test_sample_size_does_not_grow_with_the_table(spark):
    small = spark.range(1000).selectExpr("cast(id as string) transaction_id", "id * 1.0D a")
    large = spark.range(200_000).selectExpr("cast(id as string) transaction_id", "id * 1.0D a")
    for df in (small, large):
        per_tree = tree_samples(df, ["a"], "transaction_id", 20, 64, 1).groupBy("_tree").count().collect()
        assert len(per_tree) == 20
        # Enough for every tree, and bounded whatever the table.
        assert all(64 <= r["count"] <= 8 * 64 for r in per_tree)


def test_outliers_rank_first(spark, points, tmp_path):
    forest = fit_isolation_forest(points, COLS, trees=50, sample=128)
    scored = score_isolation_forest(points, forest, COLS, sample=128)
    assert scored.filter("anomaly_score <= 0 or anomaly_score >= 1").count() == 0
    table = anomaly_table(spark, scored, str(tmp_path / "scores"))
    assert not conforms(table.schema, ANOMALY_SCORES)
    flagged = table.filter("anomaly_label = 1")
    assert flagged.count() == 20
    assert flagged.filter("is_fraud = 1").count() >= 18


def test_forest_is_repeatable_and_can_be_stored(spark, points, tmp_path):
    first = fit_isolation_forest(points, COLS, trees=5, sample=64)
    second = fit_isolation_forest(points.repartition(7), COLS, trees=5, sample=64)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    first.write.parquet(str(tmp_path / "forest"))
    a = score_isolation_forest(points, first, COLS, 64).agg(F.sum("anomaly_score")).first()[0]
    b = score_isolation_forest(points, spark.read.parquet(str(tmp_path / "forest")), COLS, 64)
    assert abs(a - b.agg(F.sum("anomaly_score")).first()[0]) < 1e-9


def test_classifier_learns_and_round_trips(spark, points, tmp_path):
    model = classifier.train_classifier(points, COLS, params={"trees": 5, "depth": 3})
    scored = classifier.score(points, model, COLS)
    assert roc_auc(scored).first()["roc_auc"] > 0.95
    assert scored.columns == [*points.columns, "score"]
    top = classifier.feature_importance(spark, model, COLS, k=2).collect()
    assert 1 <= len(top) <= 2 and top[0]["importance"] >= top[-1]["importance"]
    classifier.save(model, str(tmp_path / "model"))
    again = classifier.score(points, classifier.load(str(tmp_path / "model")), COLS)
    assert again.agg(F.sum("score")).first() == scored.agg(F.sum("score")).first()


def test_missing_features_count_as_their_defaults(spark, points):
    rows = [(str(i), *[float((i * (j + 3)) % 7) for j in range(13)], 1.0 + i % 2, i % 2) for i in range(60)]
    schema = "transaction_id string, " + ", ".join(f"{c} double" for c in MODEL_FEATURES) + ", is_fraud int"
    df = spark.createDataFrame(rows, schema)
    model = classifier.train_classifier(df, params={"trees": 2, "depth": 2})
    bare = classifier.score(spark.createDataFrame([("x",)], "transaction_id string"), model)
    zeros = {c: F.lit(1.0 if c == "amount_vs_mean_ratio" else 0.0) for c in MODEL_FEATURES}
    full = classifier.score(spark.createDataFrame([("x",)], "transaction_id string").withColumns(zeros), model)
    assert bare.first()["score"] == full.first()["score"]
