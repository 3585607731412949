"""Histogram boosting: against plain Python, against the library's trees, and the training job."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyrisk.models import boosting, classifier
from tallyrisk.operators.ranking import roc_auc
from tallyrisk.plans.jobs import train_and_evaluate
from tallyrisk.schemas import MODEL_FEATURES
from tallyrisk.sources.job_metrics import metric_status, read_metrics

COLS = ["a", "b", "c"]
SCHEMA = "transaction_id long, a double, b double, c double, is_fraud int"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    out = []
    for k in range(3000):
        a, b, c = rng.normal(), float(rng.integers(0, 9)), rng.exponential()
        chance = 0.03 + 0.4 * (a > 0.8) + 0.3 * (b < 2 and c > 1)
        out.append((k, float(a), b, float(c), int(rng.random() < chance)))
    return out


@pytest.fixture(scope="module")
def points(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


def plain_trees(rows, edges, trees, depth, rate):
    """The same greedy trees, node by node over all rows and all cuts."""
    x, y = np.array([r[1:4] for r in rows]), np.array([r[4] for r in rows])
    weight, margin, out = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0), np.zeros(len(y)), {}
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - y) * weight, p * (1 - p) * weight
        todo = [(0, np.arange(len(y)), 0)]
        while todo:
            n, at, d = todo.pop()
            G, H, best = g[at].sum(), h[at].sum(), (1e-6, None, None)
            for f in range(3) if d < depth else []:
                for e in edges[f]:
                    left = at[x[at, f] <= e]
                    gl, hl = g[left].sum(), h[left].sum()
                    gain = (gl**2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G**2 / (H + 1)) / 2
                    if min(hl, H - hl) >= 1 and gain > best[0] + 1e-9:
                        best = (gain, f, e)
            out[tree, n] = (-1 if best[1] is None else best[1], best[2], -rate * G / (H + 1))
            if best[1] is None:
                margin[at] -= rate * G / (H + 1)
            else:
                low = x[at, best[1]] <= best[2]
                todo += [(2 * n + 1, at[low], d + 1), (2 * n + 2, at[~low], d + 1)]
    return out


def test_trees_equal_plain_python(spark, rows, points):
    params = {"trees": 3, "depth": 3, "row_share": 1.0, "column_share": 1.0, "rate": 0.3}
    got = {(r.tree, r.node): r for r in boosting.fit(points, COLS, params=params, bins=16).collect()}
    want = plain_trees(rows, boosting.quantile_edges(points, COLS, 16), 3, 3, 0.3)
    assert got.keys() == want.keys()
    for key, (feature, threshold, value) in want.items():
        assert (got[key].feature, got[key].threshold) == (feature, threshold)
        assert got[key].value == pytest.approx(value, abs=1e-4)


@pytest.mark.parametrize("together", [1, 5])
def test_as_good_as_the_library_at_equal_parameters(points, together):
    # The library draws columns for each node, this one for each tree: compared without draws.
    params = {"trees": 20, "depth": 3, "rate": 0.1, "row_share": 1.0, "column_share": 1.0}
    train, test = points.where("transaction_id % 4 != 0"), points.where("transaction_id % 4 = 0")
    area = lambda scored: roc_auc(scored).first()[0]
    own = area(boosting.score(test, boosting.fit(train, COLS, params=params, together=together), COLS))
    other = area(classifier.score(test, classifier.train_classifier(train, COLS, params=params), COLS))
    assert own > other - 0.01


def test_same_model_for_any_partitions_and_storing(spark, points, tmp_path):
    params = {"trees": 4, "depth": 3}
    edges = boosting.quantile_edges(points, COLS, 64)
    first = boosting.fit(points, COLS, params=params, keep=1, edges=edges)
    second = boosting.fit(points.repartition(7).orderBy(F.rand(3)), COLS, params=params, tasks=5, edges=edges)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    boosting.save(first, str(tmp_path / "nodes"))
    again = boosting.load(spark, str(tmp_path / "nodes"))
    scored = boosting.score(points, again, COLS)
    assert scored.columns == [*points.columns, "score"]
    assert scored.agg(F.sum("score")).first() == boosting.score(points, first, COLS).agg(F.sum("score")).first()
    top = boosting.feature_gain(first, COLS, k=2).collect()
    assert len(top) == 2 and top[0]["importance"] >= top[1]["importance"]


def _random_round(rng, sizes, depth, leaves=0.2):
    now = boosting.Round(range(3), {**boosting.PARAMS, "depth": depth}, len(sizes))
    for k in range(3):
        for n in range(2**depth - 1):
            if (n == 0 or now.feature[k, (n - 1) // 2] >= 0) and rng.random() > leaves:
                now.feature[k, n] = f = rng.choice(now.columns[k])
                now.cut[k, n] = rng.integers(0, sizes[f])
    return now


@pytest.mark.parametrize("depth", [0, 1, 3, 6, 7, 9])
def test_a_walk_ends_where_steps_from_the_root_end(depth):
    rng, sizes = np.random.default_rng(depth), [2, 5, 64, 30, 3]
    now, packed = _random_round(rng, sizes, depth), boosting.Packed(sizes)
    assert sorted(f for g in packed.groups for f in g) == list(range(5)) and len(packed.groups) < 5
    x = np.stack([rng.integers(0, s, 5000).astype(np.uint8) for s in sizes])
    slots, leaves = boosting.Walk(now.feature, now.cut, depth, packed)(packed.codes(x)), boosting._leaves(now.feature, depth)
    for k in range(3):
        for row in range(0, 5000, 50):
            n = 0
            for _ in range(depth):
                if now.feature[k, n] >= 0:
                    n = 2 * n + 1 + int(x[now.feature[k, n], row] > now.cut[k, n])
            assert leaves[k, slots[row, k]] == n


def test_only_the_smaller_child_is_summed():
    """And the other one's sums follow from its parent's: no level sums more than half of the rows again."""
    rng, sizes, params = np.random.default_rng(5), [4, 9, 6], {**boosting.PARAMS, "depth": 2, "row_share": 1.0, "column_share": 1.0}
    now, n = boosting.Round([0], params, 3), 4000
    ids, label = rng.integers(0, 2**62, n), rng.integers(0, 2, n).astype(np.int8)
    x, margin = np.stack([rng.integers(0, s, n).astype(np.uint8) for s in sizes]), rng.normal(size=n)
    order = np.argsort(~boosting._probe(ids.astype(np.uint64)), kind="stable")
    data = (ids[order], label[order], x[:, order], margin[order])
    block = boosting._batch([[v.tobytes()] for v in data], ["id", "label", "bins", "margin"])
    sums = lambda depth: [b for b in boosting._level_sums(now, depth, 16, sizes, 3.0)(iter([block]))]
    split = lambda batches: {b["node"]: b for b in pa.Table.from_batches(boosting._best_splits(now.columns, 16, sizes, True)(iter(batches))).to_pylist()}
    top = sums(0)
    root = split(top)[0]
    now.feature[0, 0], now.cut[0, 0] = 1, 1
    went = x[1] > 1
    now.small[0, 0] = int(went.mean() < 0.5)
    below = sums(1)
    assert [r["node"] for b in below for r in b.to_pylist()] == [1 + now.small[0, 0]] and root["feature"] >= 0
    held = boosting._batch([[0], [0], [0], [root["sums"]]], ["tree", "parent", "node", "sums"]).cast(top[0].schema)
    both = split([*below, held])
    p = 1 / (1 + np.exp(-margin))
    g, h = (np.rint(v * np.where(label == 1, 3.0, 1.0) / boosting.UNIT) * boosting.UNIT for v in (p - label, p * (1 - p)))
    for node, at in ((1, ~went), (2, went)):
        assert both[node]["value"] == -g[at].sum() / (h[at].sum() + 1)


def test_scores_equal_a_plain_walk_also_on_thresholds(spark, points):
    nodes = boosting.fit(points, COLS, params={"trees": 5, "depth": 7})
    tree = {(r.tree, r.node): r for r in nodes.collect()}
    cuts = [sorted({r.threshold for r in tree.values() if r.feature == f}) for f in range(3)]
    rng = np.random.default_rng(2)
    odd = [(k, *[float(rng.choice([*c, -np.inf, np.inf, 0.5])) for c in cuts], 0) for k in range(300)]
    got = {r["transaction_id"]: r["score"] for r in boosting.score(spark.createDataFrame(odd, SCHEMA), nodes, COLS).collect()}
    for k, *x, _ in odd:
        total = 0.0
        for t in range(5):
            n = 0
            while tree[t, n].feature >= 0:
                n = 2 * n + 1 + (x[tree[t, n].feature] > tree[t, n].threshold)
            total += tree[t, n].value
        assert got[k] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)


def test_blocks_are_filled_over_batches():
    one = pa.RecordBatch.from_pydict({"_id": np.arange(100), "_label": np.zeros(100, np.int32), "_0": np.arange(100.0)})
    got = list(boosting._blocks([np.array([9.0])])(iter([one] * 5)))
    assert [len(b["bins"][0].as_py()) for b in got] == [500]


def test_odd_rows(spark, points):
    empty = boosting.fit(points.where("false"), COLS)
    assert empty.count() == 0 and boosting.fit(points.where("is_fraud = 0"), COLS).count() == 0
    assert {r["score"] for r in boosting.score(points.limit(3), empty, COLS).collect()} == {0.5}
    odd = [(None, None, None, None, 1), (9001, float("nan"), float("inf"), -float("inf"), 0), (9002, 1.0, None, 2.0, None)]
    mixed = points.limit(200).unionByName(spark.createDataFrame(odd, SCHEMA))
    nodes = boosting.fit(mixed, COLS, params={"trees": 2, "depth": 2})
    scores = [r["score"] for r in boosting.score(mixed.select("a", "b"), nodes, COLS).collect()]
    assert len(scores) == 203 and all(0 < s < 1 for s in scores)


def test_stream_and_batch_score_alike(spark, points, tmp_path):
    nodes = boosting.fit(points, COLS, params={"trees": 2, "depth": 3})
    points.write.parquet(str(tmp_path / "in"))
    stream = boosting.score(spark.readStream.schema(points.schema).parquet(str(tmp_path / "in")), nodes, COLS)
    writer = stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    writer.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    both = [d.select("transaction_id", "score") for d in (spark.read.parquet(str(tmp_path / "out")), boosting.score(points, nodes, COLS))]
    assert sorted(map(tuple, both[0].collect())) == sorted(map(tuple, both[1].collect()))


def test_training_job_records_what_it_measured(spark, points, tmp_path):
    features = {c: F.col(COLS[k % 3]) if k < 3 else F.lit(0.0) for k, c in enumerate(MODEL_FEATURES)}
    points.withColumns(features).select("transaction_id", *MODEL_FEATURES, "is_fraud").write.parquet(str(tmp_path / "in"))
    table = spark.read.parquet(str(tmp_path / "in"))
    path, model = str(tmp_path / "metrics"), str(tmp_path / "model")
    got = train_and_evaluate(spark, table, model, path, params={"trees": 10, "depth": 3}, together=2)
    assert got["train_rows"] == pytest.approx(2400, abs=1) and got["roc_auc"] > 0.75 and 0 < got["recall_t30"] <= 1
    rows = {r["metric"]: r for r in metric_status(read_metrics(spark, path, "train classifier")).collect()}
    assert rows.keys() == got.keys() and rows["roc_auc"]["measured"] == got["roc_auc"]
    assert rows["recall_t30"]["status"] in ("met", "below-target") and rows["seconds"]["status"] == "not-measured"
    assert boosting.load(spark, model).agg(F.countDistinct("tree")).first()[0] == 10
