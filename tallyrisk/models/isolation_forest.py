"""Isolation forest (Liu, Ting, Zhou 2008) as Spark jobs.

Every tree is grown from a small sample, whatever the table's size: rows are
spread over the trees by hash, the trees are grown in parallel, one group per
tree, and all rows are scored where they are.  The forest is a table of nodes,
at most trees x (2 x sample - 1) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.operators.ordering import top_fraction_flag
from tallyrisk.schemas import MODEL_FEATURES

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double, size int"
TREES, SAMPLE, SEED = 200, 256, 42


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype="float64")
    big = np.maximum(n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


def tree_samples(
    df: DataFrame, columns: Sequence[str], id_col: str, trees: int, sample: int, seed: int
) -> DataFrame:
    """More than ``sample`` rows for each tree, chosen by hash; all rows for every tree if there are few.

    From 8 x sample rows on a tree gets about sample + 8 x sqrt(sample) + 64 of
    them, so that one short of ``sample`` is out of reach of chance.  Output size
    depends on trees and sample only.
    """
    need = F.lit(trees * (sample + 8 * sample**0.5 + 64))
    n = F.greatest(df.agg(F.count(F.lit(1)).cast("double")).scalar(), F.lit(1.0))
    few = n <= 8 * sample
    copies = F.when(few, F.lit(trees)).otherwise(F.least(F.ceil(1.2 * need / n), F.lit(trees))).cast("int")
    share = F.when(few, F.lit(1.0)).otherwise(1.2 * need / (n * copies))
    draw = F.xxhash64(F.col(id_col), F.col("_copy"), F.lit(seed))
    spread = F.xxhash64(F.col(id_col), F.col("_copy"), F.lit(seed + 1))
    return (
        df.select(id_col, *[F.col(c).cast("double").alias(c) for c in columns])
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
        .withColumn("_draw", draw)
        .filter(F.pmod("_draw", F.lit(1 << 30)) < share * F.lit(float(1 << 30)))
        .withColumn("_tree", F.when(few, F.col("_copy") - 1).otherwise(F.pmod(spread, F.lit(trees))).cast("int"))
        .dropDuplicates(["_tree", id_col])
    )


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes of one tree, root first: (feature, threshold, left, right, path); leaves have feature -1."""
    nodes: list[list] = []
    todo = [(np.arange(len(points)), 0, None)]
    while todo:
        rows, depth, parent = todo.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = at
        low, high = (points[rows].min(0), points[rows].max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(splittable) == 0:
            nodes.append([-1, 0.0, -1, -1, depth + float(expected_path(len(rows)))])
            continue
        f = int(rng.choice(splittable))
        cut = rng.uniform(low[f], high[f])
        nodes.append([f, float(cut), -1, -1, 0.0])
        below = points[rows, f] <= cut
        todo += [(rows[~below], depth + 1, (at, 3)), (rows[below], depth + 1, (at, 2))]
    return [tuple(n) for n in nodes]


def fit_isolation_forest(
    df: DataFrame,
    columns: Sequence[str] = MODEL_FEATURES,
    id_col: str = "transaction_id",
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """The forest as a table of nodes."""
    columns = list(columns)
    limit = int(np.ceil(np.log2(max(sample, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["_tree"].iloc[0])
        points = pdf.sort_values(["_draw", id_col]).head(sample)[columns].to_numpy("float64")
        nodes = _grow(points, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "path"])
        out.insert(0, "node", range(len(out)))
        out.insert(0, "tree", tree)
        out["size"] = len(points)
        return out

    # A fixed number of tasks: the samples are small, but growing trees is not cheap.
    rows = tree_samples(df, columns, id_col, trees, sample, seed).repartition(-(-trees // 4), "_tree")
    return rows.groupBy("_tree").applyInPandas(grow, NODE_SCHEMA)


def score_isolation_forest(
    df: DataFrame,
    forest: DataFrame,
    columns: Sequence[str] = MODEL_FEATURES,
    sample: int = SAMPLE,
    name: str = "anomaly_score",
) -> DataFrame:
    """All rows with a score in (0, 1); higher is odder.

    The nodes, bounded by trees x (2 x sample - 1), go to every executor.
    """
    nodes = forest.orderBy("tree", "node").toPandas()
    roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
    start = np.repeat(roots, np.diff(np.append(roots, len(nodes))))
    feature = nodes["feature"].to_numpy("int64")
    threshold = nodes["threshold"].to_numpy("float64")
    left = np.where(feature < 0, np.arange(len(nodes)), nodes["left"].to_numpy("int64") + start)
    right = np.where(feature < 0, np.arange(len(nodes)), nodes["right"].to_numpy("int64") + start)
    path = nodes["path"].to_numpy("float64")
    shared = df.sparkSession.sparkContext.broadcast((roots, np.maximum(feature, 0), threshold, left, right, path))
    sizes = nodes["size"].to_numpy()[roots]
    limit = int(np.ceil(np.log2(max(sample, 2))))
    # Trees over fewer rows than asked for are shallower.
    scale = max(float(expected_path(sizes).mean()), 1e-9) if len(sizes) else 1.0

    @F.pandas_udf("double")
    def isolation(*features: pd.Series) -> pd.Series:
        roots, feature, threshold, left, right, path = shared.value
        points = np.column_stack([f.to_numpy("float64") for f in features])
        rows = np.arange(len(points))
        total = np.zeros(len(points))
        for root in roots:
            at = np.full(len(points), root)
            for _ in range(limit):
                below = points[rows, feature[at]] <= threshold[at]
                at = np.where(below, left[at], right[at])
            total += path[at]
        return pd.Series(np.exp2(-total / len(roots) / scale))

    return df.withColumn(name, isolation(*[F.col(c).cast("double") for c in columns]))


def anomaly_table(
    spark: SparkSession, scored: DataFrame, path: str, id_col: str = "transaction_id", fraction: float = 0.01
) -> DataFrame:
    """Scores with the top fraction flagged.

    The scores are written to ``path`` first: ranking reads them several times,
    and a lost executor must not score the table again.
    """
    scored.select(id_col, "anomaly_score", "is_fraud").write.mode("overwrite").parquet(path)
    flagged = top_fraction_flag(spark.read.parquet(path), "anomaly_score", id_col, fraction)
    return flagged.select(
        id_col, F.col("anomaly_score").cast("float"), "anomaly_label", F.col("is_fraud").cast("int")
    )
