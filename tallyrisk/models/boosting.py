"""Boosted trees over binned features, grown level by level as Spark jobs.

Features are cut at quantile edges once and kept as small integers in blocks of
rows, with the margin of every row beside them.  A level of a round is one job:
tasks sum gradients and curvatures per (tree, node, feature, bin) over their
blocks, one shuffle brings the sums of a node together, and the task that has
them chooses the split, so that the driver gets one short row per node.  A round
grows ``together`` trees on the same gradients, each with its own sample of rows
and columns; that many trees cost the jobs of one.  Sums are of whole numbers,
so for given edges a fit does not depend on the order or the partitions of the rows.

Rows are summed for the smaller child of a split only: the other child's sums are
those of their parent, kept by the tasks that chose the split, less these, which is
exact.  Features with few bins are summed under one joint code and taken apart once
per task.  No tree is walked from its root: see ``Walk``.

The model is a table of nodes (tree, node, feature, threshold, value, gain); the
children of node n are 2n + 1 and 2n + 2.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import prod

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.functions.risk import MISSING
from tallyrisk.schemas import MODEL_FEATURES
from tallyrisk.session import shared_dir

# Training parameters.
PARAMS = {"trees": 400, "depth": 7, "rate": 0.05, "row_share": 0.8, "column_share": 0.8, "seed": 42}
#: Penalty of large leaf values, least curvature of a child, least gain of a split.
PENALTY, LEAST_CURVATURE, LEAST_GAIN = 1.0, 1.0, 1e-6

NODES = "tree int, node int, feature int, threshold double, value double, gain double"
BLOCK = "id binary, label binary, bins binary, margin binary"
SUMS = "tree int, parent int, node int, sums binary"
SPLITS = "tree int, node int, feature int, cut int, small int, gain double, value double, left double, right double, sums binary"

#: Gradients are rounded to this, so that their sums are exact below 2^53 units.
UNIT = 2.0**-20
ROWS = 1 << 15
#: Most joint codes of a group of features, rows walked and trees scored at a time.
CODES, CHUNK, TREES = 256, 4096, 64


def _input(df: DataFrame, name: str) -> Column:
    """A feature as double; null, NaN or absent counts as its default."""
    default = F.lit(MISSING.get(name, 0.0))
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(None)), default) if name in df.columns else default


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def quantile_edges(df: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    """Cuts of each column at ``bins`` quantiles, from one pass of mergeable sketches."""
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    row = df.agg(*[F.percentile_approx(_input(df, c), shares, 20 * bins).alias(f"_{k}") for k, c in enumerate(columns)]).first()
    return [np.unique(np.array(v or [], float)) for v in row]


def _blocks(edges: list[np.ndarray]) -> Callable:
    """Rows (id hash, label, features) as blocks: row ids, labels, bin numbers and zero margins.

    Blocks are filled up over batches.  Rows by which children are compared come first.
    """

    def block(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        ids, label, *values = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(~_probe(ids.view(np.uint64)), kind="stable")
        bins = np.stack([np.searchsorted(e, v[order], "left").astype(np.uint8) for e, v in zip(edges, values)])
        data = [ids[order].astype(np.int64), label[order].astype(np.int8), bins, np.zeros(len(ids))]
        return _batch([[x.tobytes()] for x in data], ["id", "label", "bins", "margin"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                if held and held + part.num_rows > ROWS:
                    yield block(parts)
                    parts, held = [], 0
                parts.append([c.to_numpy(zero_copy_only=False) for c in part.columns])
                held += part.num_rows
        if held:
            yield block(parts)

    return run


def _probe(ids: np.ndarray) -> np.ndarray:
    """Rows that say which child is smaller.  A wrong guess costs time only, so an eighth of them will do."""
    return ids % np.uint64(8) == 0


def _batch(columns: list[list], names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(names))


def _read(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for ids, label, bins, margin in zip(*(c.to_pylist() for c in batch.columns)):
            yield (
                np.frombuffer(ids, np.uint64),
                np.frombuffer(label, np.int8),
                np.frombuffer(bins, np.uint8).reshape(features, -1),
                np.frombuffer(margin),
            )


class Packed:
    """Features in groups with one joint code, which says the bins of all features of its group."""

    def __init__(self, sizes: Sequence[int]):
        self.sizes, self.groups = list(sizes), []
        for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
            fits = [g for g in self.groups if self.size(g) * sizes[f] <= CODES]
            if fits:
                fits[0].append(f)
            else:
                self.groups.append([f])

    def size(self, group: Sequence[int]) -> int:
        return prod(self.sizes[f] for f in group)

    def codes(self, bins: Sequence[np.ndarray]) -> list[np.ndarray]:
        """The joint codes of each group; a group's last feature counts in ones."""
        out = []
        for group in self.groups:
            code = bins[group[0]].astype(np.intp)
            for f in group[1:]:
                code = code * self.sizes[f] + bins[f]
            out.append(code)
        return out

    def bins(self, group: Sequence[int]) -> list[np.ndarray]:
        """Of every code of a group, the bin of each of its features."""
        return list(np.indices([self.sizes[f] for f in group]).reshape(len(group), -1))


class Walk:
    """Where trees lead after ``steps`` splits: slots 0 to 2^steps - 1 from the left; from a leaf on, always left.

    Every slot has a bit.  A code leaves the slots that its features' splits
    allow, and all codes of a row together leave one: no step needs another's result.
    """

    def __init__(self, feature: np.ndarray, cut: np.ndarray, steps: int, packed: Packed):
        slots, self.trees = 2**steps, len(feature)
        bits = max(8, min(64, slots))
        self.kind, self.words = np.dtype(f"<u{bits // 8}"), -(-slots // bits)

        def mask(begin: int, end: int) -> np.ndarray:
            on = np.zeros(max(8, slots), bool)
            on[begin:end] = True
            return np.packbits(on, bitorder="little").view(self.kind)

        allowed = [np.empty((n, self.words, self.trees), self.kind) for n in packed.sizes]
        for table in allowed:
            table[:] = mask(0, slots)[:, None]
        for level in range(steps):
            span = slots >> level
            for i in range(2**level):
                left, right = ~mask(i * span, i * span + span // 2), ~mask(i * span + span // 2, (i + 1) * span)
                node = 2**level - 1 + i
                for k in range(self.trees):
                    f, c = max(feature[k, node], 0), cut[k, node] + 1
                    if feature[k, node] < 0:
                        c = len(allowed[f])
                    allowed[f][:c, :, k] &= right
                    allowed[f][c:, :, k] &= left
        self.tables = []
        for group in packed.groups:
            table = np.bitwise_and.reduce([allowed[f][b] for f, b in zip(group, packed.bins(group))])
            self.tables.append(np.ascontiguousarray(table.reshape(len(table), -1)))

    def __call__(self, codes: Sequence[np.ndarray]) -> np.ndarray:
        """A row of slots, one per tree, for each row."""
        out = np.empty((len(codes[0]), self.trees), np.uint8 if self.kind.itemsize * 8 * self.words <= 256 else np.int64)
        for at in range(0, len(out), CHUNK):
            left = self.tables[0].take(codes[0][at : at + CHUNK], axis=0)
            for table, code in zip(self.tables[1:], codes[1:]):
                left &= table.take(code[at : at + CHUNK], axis=0)
            # One bit is left: the exponent of the number is its place, far below 0 in words without it.
            place = left.astype(float).view(np.int64).reshape(-1, self.words, self.trees)
            place >>= 52
            place += 64 * np.arange(self.words)[:, None] - 1023
            out[at : at + CHUNK] = place.max(axis=1) if self.words > 1 else place[:, 0]
        return out


def _leaves(feature: np.ndarray, steps: int) -> np.ndarray:
    """Per tree and slot, the node a row there is in."""
    every, slot = np.arange(len(feature))[:, None], np.arange(2**steps)
    at = np.zeros((len(feature), len(slot)), np.int64)
    for level in range(steps):
        at = np.where(feature[every, at] >= 0, 2 * at + 1 + (slot >> (steps - 1 - level) & 1), at)
    return at


class Round:
    """The trees of one round: split feature (-1: leaf), bin and smaller child of each node, and leaf values."""

    def __init__(self, trees: Sequence[int], p: dict, features: int):
        size = 2 ** (p["depth"] + 1) - 1
        self.trees, self.p = list(trees), p
        self.feature = np.full((len(trees), size), -1, np.int32)
        self.cut = np.zeros((len(trees), size), np.int32)
        self.small = np.zeros((len(trees), size), np.int8)
        self.value = np.zeros((len(trees), size))
        self.gain = np.zeros((len(trees), size))
        keep = max(1, round(p["column_share"] * features))
        self.columns = [np.sort(np.random.default_rng([p["seed"], t]).permutation(features)[:keep]) for t in trees]

    def wanted(self, depth: int) -> np.ndarray:
        """Per tree and slot of a level, whether the node there is summed: the root, or the smaller child of a split."""
        if not depth:
            return np.ones((len(self.trees), 1), bool)
        up = slice(2 ** (depth - 1) - 1, 2**depth - 1)
        split, small = self.feature[:, up] >= 0, self.small[:, up]
        return np.stack([split & (small == 0), split & (small == 1)], axis=2).reshape(len(self.trees), -1)

    def drawn(self, k: int, ids: np.ndarray) -> np.ndarray:
        """Whether a row is in the sample of tree k, by its id alone."""
        salt = np.uint64(1 + self.trees[k] + 1_000_003 * self.p["seed"])
        return (_mix(ids ^ _mix(np.array([salt])))) >> np.uint64(11) < self.p["row_share"] * 2.0**53


def _level_sums(now: Round, depth: int, bins: int, sizes: Sequence[int], positive: float) -> Callable:
    """Gradient, curvature and probe sums of the wanted nodes of one level, a row for each node a task has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, wanted = Packed(sizes), now.wanted(depth)
        walk = Walk(now.feature, now.cut, depth, packed)
        rank = np.where(wanted, np.cumsum(wanted, axis=1) - 1, -1)
        width = int(wanted.sum(axis=1).max())
        used = [[g for g, group in enumerate(packed.groups) if set(group) & set(c.tolist())] for c in now.columns]
        cells = [packed.size(group) * width for group in packed.groups]
        total = [{g: np.zeros((3, cells[g])) for g in groups} for groups in used]
        for ids, label, x, margin in _read(batches, len(sizes)):
            p = 1 / (1 + np.exp(-margin))
            weight = np.where(label == 1, positive, 1.0) / UNIT
            both = np.rint((p - label) * weight), np.rint(p * (1 - p) * weight)
            codes = packed.codes(x)
            slot, codes = np.ascontiguousarray(walk(codes).T), [c * width for c in codes]
            probes = np.count_nonzero(_probe(ids))
            for k, groups in enumerate(used):
                place = rank[k].take(slot[k])
                rows = np.flatnonzero(place >= 0)
                rows = rows[now.drawn(k, ids[rows])]
                at, (g, h), few = place[rows], (v[rows] for v in both), np.searchsorted(rows, probes)
                for j in groups:
                    cell = codes[j].take(rows)
                    cell += at
                    sums = total[k][j]
                    sums[0] += np.bincount(cell, g, cells[j])
                    sums[1] += np.bincount(cell, h, cells[j])
                    sums[2] += np.bincount(cell[:few], minlength=cells[j])
        for k, columns in enumerate(now.columns):
            sums = np.zeros((width, 3, len(columns), bins))
            real = _real(columns, bins, sizes)
            for j in used[k]:
                group = packed.groups[j]
                value = total[k][j].reshape(3, *[sizes[f] for f in group], width)
                for n, f in enumerate(group):
                    if f in columns:
                        one = value.sum(axis=tuple(1 + m for m in range(len(group)) if m != n))
                        sums[:, :, np.searchsorted(columns, f), : sizes[f]] = one.transpose(2, 0, 1)
            nodes = 2**depth - 1 + np.flatnonzero(wanted[k])
            seen = np.flatnonzero(sums[: len(nodes)].any(axis=(1, 2, 3)))
            if len(seen):
                node = nodes[seen].astype(np.int32)
                parent = ((node - 1) // 2).astype(np.int32)
                yield _batch([np.full(len(seen), k, np.int32), parent, node, [sums[n][:, real].tobytes() for n in seen]], ["tree", "parent", "node", "sums"])

    return run


def _real(columns: np.ndarray, bins: int, sizes: Sequence[int]) -> np.ndarray:
    """Which bins the columns have; only these travel."""
    return np.arange(bins) < np.array(sizes)[columns][:, None]


def _best_splits(columns: list[np.ndarray], bins: int, sizes: Sequence[int], more: bool) -> Callable:
    """The best split of each node from all tasks' sums of it, or from its parent's and its sibling's.

    A parent's sums come as a row that is its own parent.  With ``more`` levels to
    come a split node's sums go on with it.
    """

    def score(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / (h + PENALTY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, parent, n, sums in zip(*(c.to_pylist() for c in batch.columns)):
                value = np.frombuffer(sums).reshape(3, -1)
                if n == parent:
                    held[k, n] = value
                else:
                    total[k, n] = total[k, n] + value if (k, n) in total else value
        for (k, n), value in held.items():
            one, other = (2 * n + 1, 2 * n + 2) if (k, 2 * n + 1) in total else (2 * n + 2, 2 * n + 1)
            total[k, other] = value - total.get((k, one), 0)
        out = []
        for (k, n), value in sorted(total.items(), key=lambda x: x[0]):
            real = _real(columns[k], bins, sizes)
            sums = np.zeros((3, *real.shape))
            sums[:, real] = value
            g, h, seen = np.cumsum(sums, axis=2) * np.array([UNIT, UNIT, 1])[:, None, None]
            all_g, all_h = g[0, -1], h[0, -1]
            gain = (score(g, h) + score(all_g - g, all_h - h) - score(all_g, all_h)) / 2
            gain[(h < LEAST_CURVATURE) | (all_h - h < LEAST_CURVATURE)] = 0
            j, cut = np.unravel_index(np.argmax(gain), gain.shape)
            left, right = (-x / (y + PENALTY) for x, y in ((g[j, cut], h[j, cut]), (all_g - g[j, cut], all_h - h[j, cut])))
            feature = int(columns[k][j]) if gain[j, cut] > LEAST_GAIN else -1
            small = int(2 * seen[j, cut] > seen[j, -1])
            kept = value.tobytes() if more and feature >= 0 else None
            out.append((k, n, feature, int(cut), small, float(gain[j, cut]), -all_g / (all_h + PENALTY), left, right, kept))
        if out:
            names = [x.split()[0] for x in SPLITS.split(", ")]
            kinds = [pa.int32()] * 5 + [pa.float64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return run


def _moved(now: Round, sizes: Sequence[int]) -> Callable:
    """Blocks with the values of a finished round added to their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, depth = Packed(sizes), now.p["depth"]
        walk = Walk(now.feature, now.cut, depth, packed)
        value = np.take_along_axis(now.value, _leaves(now.feature, depth), axis=1)
        for ids, label, bins, margin in _read(batches, len(sizes)):
            slot = np.ascontiguousarray(walk(packed.codes(bins)).T)
            add = sum(value[k].take(slot[k]) for k in range(len(now.trees)))
            yield _batch([[x.tobytes()] for x in (ids, label, bins, margin + now.p["rate"] * add)], ["id", "label", "bins", "margin"])

    return run


def fit(
    df: DataFrame,
    columns: Sequence[str] = MODEL_FEATURES,
    label: str = "is_fraud",
    id_col: str = "transaction_id",
    params: dict | None = None,
    bins: int = 64,
    together: int = 1,
    keep: int = 8,
    tasks: int | None = None,
    edges: list[np.ndarray] | None = None,
) -> DataFrame:
    """The node table of a model fitted to the labelled rows.

    Positives weigh as much as all negatives together.  ``together`` trees share
    a round; 1 is plain boosting.  Every ``keep`` rounds the rows are written to
    the shared folder, so that a lost executor costs few rounds.  A task holds
    ``ROWS`` rows or more, up to four tasks a core.  ``bins`` is at most 256;
    ``edges`` replaces the quantiles, which are sketches and may differ a little
    between partitionings.
    Without rows, or with one class only, the model has no nodes.
    """
    spark, p = df.sparkSession, {**PARAMS, **(params or {})}
    df = df.where(F.col(label).isNotNull())
    count = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")).first()
    if not count["pos"] or not count["neg"]:
        return spark.createDataFrame([], NODES)
    most = 4 * spark.sparkContext.defaultParallelism
    tasks = tasks or min(most, -(-(count["pos"] + count["neg"]) // ROWS))
    positive, edges = count["neg"] / count["pos"], edges or quantile_edges(df, columns, bins)
    narrow = df.select(F.xxhash64(id_col).alias("_id"), F.col(label).cast("int").alias("_label"), *[_input(df, c).alias(f"_{k}") for k, c in enumerate(columns)])
    rows = narrow.repartition(tasks, "_id").mapInArrow(_blocks(edges), BLOCK)
    rows, held = _stored(rows), None
    nodes, sizes = [], [len(e) + 1 for e in edges]
    for start in range(0, p["trees"], together):
        now, best = Round(range(start, min(start + together, p["trees"])), p, len(columns)), None
        for depth in range(p["depth"]):
            if depth and not (now.feature[:, 2 ** (depth - 1) - 1 : 2**depth - 1] >= 0).any():
                break
            sums = rows.mapInArrow(_level_sums(now, depth, bins, sizes, positive), SUMS)
            if best is not None:
                sums = sums.union(best.where("feature >= 0").selectExpr("tree", "node AS parent", "node", "sums"))
            parents = best
            sums = sums.repartition(min(tasks, together << depth), "tree", "parent")
            best = sums.mapInArrow(_best_splits(now.columns, bins, sizes, depth + 1 < p["depth"]), SPLITS).persist()
            for s in best.drop("sums").collect():
                now.value[s["tree"], s["node"]] = s["value"]
                if s["feature"] >= 0:
                    now.feature[s["tree"], s["node"]], now.cut[s["tree"], s["node"]] = s["feature"], s["cut"]
                    now.gain[s["tree"], s["node"]], now.small[s["tree"], s["node"]] = s["gain"], s["small"]
                    now.value[s["tree"], 2 * s["node"] + 1], now.value[s["tree"], 2 * s["node"] + 2] = s["left"], s["right"]
            if parents is not None:
                parents.unpersist()
        if best is not None:
            best.unpersist()
        nodes += _nodes(now, edges)
        rows = rows.mapInArrow(_moved(now, sizes), BLOCK)
        rows = _stored(rows) if (start // together) % keep == keep - 1 else rows.persist()
        rows.count()
        if held is not None:
            held.unpersist()
        held = rows
    held.unpersist()
    return spark.createDataFrame(nodes, NODES)


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder, read again and held; cuts the lineage."""
    path = shared_dir(df.sparkSession, "boosting")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).persist()


def _nodes(now: Round, edges: list[np.ndarray]) -> list[tuple]:
    """Reachable nodes as rows; a row goes left if its value is at most the threshold."""
    out = []
    for k, tree in enumerate(now.trees):
        todo = [0]
        while todo:
            n = todo.pop()
            f, threshold = int(now.feature[k, n]), None
            if f >= 0:
                e, cut = edges[f], int(now.cut[k, n])
                threshold = float(e[cut]) if cut < len(e) else float("inf")
                todo += [2 * n + 1, 2 * n + 2]
            out.append((tree, n, f, threshold, float(now.p["rate"] * now.value[k, n]), float(now.gain[k, n])))
    return out


def score(df: DataFrame, nodes: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Batch or streaming rows with ``score``, the positive probability.

    The nodes (at most trees x 2^(depth + 1)) go to every task.  A missing, null
    or NaN feature counts as 0 (the mean ratio as 1).  A model without nodes gives 0.5.
    """
    rows = nodes.toPandas()
    steps = int(np.log2(rows["node"].max() + 1)) if len(rows) else 0
    trees = np.unique(rows["tree"])
    feature = np.full((len(trees), 2 ** (steps + 1) - 1), -1, np.int32)
    threshold, value = np.zeros(feature.shape), np.zeros(feature.shape)
    at = np.searchsorted(trees, rows["tree"]), rows["node"].to_numpy()
    feature[at], threshold[at], value[at] = rows["feature"], rows["threshold"].fillna(0), rows["value"]
    edges, cut = [], np.zeros(feature.shape, np.int64)
    for f in range(len(columns)):
        edges.append(np.unique(threshold[feature == f]))
        cut[feature == f] = np.searchsorted(edges[f], threshold[feature == f])

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        packed = Packed([len(e) + 1 for e in edges])
        leaf = np.take_along_axis(value, _leaves(feature, steps), axis=1)
        parts = [slice(t, t + TREES) for t in range(0, len(trees), TREES)]
        walks = [Walk(feature[part], cut[part], steps, packed) for part in parts]
        for features in batches:
            x, out = features.to_numpy(float), np.empty(len(features))
            for begin in range(0, len(x), CHUNK):
                codes = packed.codes([np.searchsorted(e, v, "left") for e, v in zip(edges, x[begin : begin + CHUNK].T)])
                found = np.empty((len(codes[0]), len(trees)))
                for part, walk in zip(parts, walks):
                    first = np.arange(walk.trees) << steps
                    found[:, part] = leaf[part].ravel().take(walk(codes) + first)
                out[begin : begin + CHUNK] = 1 / (1 + np.exp(-found.sum(axis=1)))
            yield pd.Series(out)

    return df.withColumn("score", probability(F.struct(*[_input(df, c).alias(f"_{k}") for k, c in enumerate(columns)])))


def feature_gain(nodes: DataFrame, columns: Sequence[str] = MODEL_FEATURES, k: int = 15) -> DataFrame:
    """The k features with the largest mean gain of their splits; features never used are left out."""
    names = F.create_map(*[x for n, c in enumerate(columns) for x in (F.lit(n), F.lit(c))])
    used = nodes.where("feature >= 0").groupBy(names[F.col("feature")].alias("feature"))
    return used.agg(F.avg("gain").alias("importance"), F.count("*").alias("splits")).orderBy(F.desc("importance"), "feature").limit(k)


def save(nodes: DataFrame, path: str) -> None:
    nodes.coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NODES).parquet(path)
