"""Near-duplicate documents: banded MinHash, sequential Bayesian pruning, exact check.

Every text becomes its set of five-word shingles and a MinHash signature.
Texts with equal sets are one class from then on.  Classes that agree in a whole
band of the signature are candidates.  A candidate pair's signatures are compared
in batches; after each batch the posterior of its similarity, given the matches
so far and a flat prior, says how likely it still reaches the threshold, and the
pair is dropped once that is below the chosen miss probability.  Survivors are
confirmed on their full shingle sets, so no wrong link is made.

No bucket is expanded into all its pairs.  First each member of a bucket is
compared with one hub only, the member that shares most buckets with others.  Components are formed, and a
second step compares just those members of a bucket that are still in different
components, because a link inside a component changes nothing.  Classes with the
same main hub are a family; a large family of texts that are alike, but not alike
enough, is compared in blocks of longer signatures, so only pairs that survive
the test are ever emitted.  Pairs of a bucket across families are few and are
tested one by one.

With ``bands`` of ``rows`` values, a pair at similarity 0.75 misses all bands
with probability (1 - 0.75 ** rows) ** bands, 2e-5 at the defaults, and is
pruned wrongly with at most ``miss`` per comparison.

Defined results: words are cut at ASCII white space after lower-casing A-Z; a
text of fewer than five words has one shingle, its whole word sequence; null and
blank texts have no shingle and are linked with nothing; repeated rows and equal
texts form one component; rows with a null id get a null component and are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.graph import components
from tallyrisk.llm.text import WordHashes, mapped, mix, stored, utf8

ROWS, BANDS, BATCH = 5, 40, 25


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` word hashes."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    value = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        value = mix(value + words[k : n - width + 1 + k])
    return np.unique(value)


def digest(values: np.ndarray) -> bytes:
    """The class of a set: 128 bits of its sorted hashes."""
    return xxhash.xxh3_128_digest(values.tobytes())


@lru_cache(maxsize=4)
def multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    odd = rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], rng.integers(0, 1 << 32, count, dtype=np.uint32)[:, None]


def signature(values: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values of a set of hashes."""
    a, b = multipliers(count)
    short = (values >> np.uint64(32)).astype(np.uint32)
    best = np.full(count, 0xFFFFFFFF, np.uint32)
    step = max(1, 1 << 14)
    for at in range(0, len(short), step):
        part = short[at : at + step]
        rows = max(1, (1 << 16) // len(part))
        for k in range(0, count, rows):
            low = (a[k : k + rows] * part + b[k : k + rows]).min(1)
            np.minimum(best[k : k + rows], low, out=best[k : k + rows])
    return best


@lru_cache(maxsize=4)
def least_matches(threshold: float, miss: float, batch: int, total: int) -> list[int]:
    """For each number of compared values (multiples of ``batch``), the matches below which a pair is dropped.

    One byte of each value is compared, so a match happens with probability
    s + (1 - s) / 256 at similarity s.  The posterior of that probability under
    a flat prior is a Beta distribution, summed here on a grid.  A worker keeps
    the bounds, so that tasks with few pairs do not pay for them.
    """
    edge = threshold + (1 - threshold) / 256
    grid = (np.arange(4000) + 0.5) / 4000
    same, other, above = np.log(grid), np.log(1 - grid), grid >= edge
    out, keep = [], 0
    for n in range(batch, total + 1, batch):
        for m in range(keep, n + 1):  # more values never need fewer matches
            log = m * same + (n - m) * other
            mass = np.exp(log - log.max())
            if mass[above].sum() / mass.sum() >= miss:
                keep = m
                break
        out.append(keep)
    return out


def signed(docs: DataFrame, columns: list[str], text: str, size: int, rows: int, bands: int) -> DataFrame:
    """``columns`` with the set's size, its digest (class), one byte of each MinHash value, and the band hashes."""
    kept = docs.select(*columns, F.col(text).alias("_body"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.drop("_body").schema)

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        hashes = WordHashes()
        for *left, body in given:
            values = shingles(hashes.of(utf8(body).lower().split()), size)
            if len(values) == 0:
                yield *left, 0, None, None, None
                continue
            sig = signature(values, rows * bands)
            keys = np.zeros(bands, np.uint64)
            for k, column in enumerate(sig.reshape(bands, rows).T):
                keys = mix(keys + column.astype(np.uint64) + np.uint64(k + 1))
            yield *left, len(values), digest(values), sig.astype(np.uint8).tobytes(), keys.view(np.int64).tolist()

    return mapped(kept, run, f"{kinds}n_shingles long, class binary, signature binary, bands array<long>")


def likely_pairs(pairs: DataFrame, classes: DataFrame, threshold: float, batch: int, miss: float) -> DataFrame:
    """The pairs (a, b) of classes that pass the sequential test."""
    sig = classes.select("class", "signature")
    both = pairs.join(sig.select(F.col("class").alias("b"), F.col("signature").alias("sb")), "b").join(
        sig.select(F.col("class").alias("a"), F.col("signature").alias("sa")), "a"
    )

    def prune(given: Iterator[tuple]) -> Iterator[tuple]:
        bound: list[int] = []
        for a, b, sa, sb in given:
            same = np.frombuffer(sa, np.uint8) == np.frombuffer(sb, np.uint8)
            bound = bound or least_matches(threshold, miss, batch, len(same))
            seen = 0
            for k, least in enumerate(bound):
                seen += int(np.count_nonzero(same[k * batch : (k + 1) * batch]))
                if seen < least:
                    break
            else:
                yield a, b

    return mapped(both.select("a", "b", "sa", "sb"), prune, "a binary, b binary")


def surviving(left: np.ndarray, right: np.ndarray, apart: np.ndarray, bound: list[int], batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (left, right) allowed by ``apart`` that pass the sequential test, batch after batch."""
    out_i, out_j = [], []
    for at in range(0, len(left), 64):
        part = left[at : at + 64]
        same = np.zeros((len(part), len(right)), np.int32)
        for k in range(batch):
            same += part[:, k, None] == right[None, :, k]
        i, j = np.nonzero((same >= bound[0]) & apart[at : at + 64])
        seen = same[i, j]
        for k, least in enumerate(bound[1:], 1):
            cut = slice(k * batch, (k + 1) * batch)
            seen = seen + (part[i, cut] == right[j, cut]).sum(1)
            ok = seen >= least
            i, j, seen = i[ok], j[ok], seen[ok]
        out_i.append(i + at)
        out_j.append(j)
    return np.concatenate(out_i), np.concatenate(out_j)


def family_pairs(members: DataFrame, threshold: float, batch: int, miss: float, block: int = 1024) -> DataFrame:
    """Surviving pairs (a, b) across components within families.

    ``members`` has family, class, component and signature, one row per class.
    A family is cut into blocks; a group holds two blocks, so it stays small.
    """
    sizes = (
        members.groupBy("family")
        .agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("family", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    dealt = (
        members.join(sizes, "family")
        .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("family", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "class", "component", "signature")
    )

    def compare(given: Iterator[tuple]) -> Iterator[tuple]:
        bound: list[int] = []
        for (_, lo, hi), group in groupby(given, key=lambda r: r[:3]):
            rows = list(group)
            bound = bound or least_matches(threshold, miss, batch, len(rows[0][6]))
            x = [r for r in rows if r[3] == lo]
            y = x if lo == hi else [r for r in rows if r[3] == hi]
            if not x or not y:
                continue
            code: dict[bytes, int] = {}
            cx, cy = (np.array([code.setdefault(r[5], len(code)) for r in side]) for side in (x, y))
            apart = cx[:, None] != cy[None, :]
            if lo == hi:
                apart = np.triu(apart)
            sx, sy = (np.frombuffer(b"".join(r[6] for r in side), np.uint8).reshape(len(side), -1) for side in (x, y))
            for i, j in zip(*surviving(sx, sy, apart, bound, batch)):
                yield min(x[i][4], y[j][4]), max(x[i][4], y[j][4])

    keys = ["family", "lo", "hi"]
    return mapped(dealt.repartition(*keys).sortWithinPartitions(*keys), compare, "a binary, b binary")


def bodies_of(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(class, _body) of ``classes`` (class, head); a repeated id may bring a wrong text along, told by its digest."""
    return docs.select(F.col("doc_id").alias("head"), F.col("_t").alias("_body")).join(classes, "head").select("class", "_body")


def long_signatures(classes: DataFrame, docs: DataFrame, size: int, count: int) -> DataFrame:
    """(class, signature) with ``count`` one-byte MinHash values."""

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        hashes = WordHashes()
        for name, body in given:
            values = shingles(hashes.of(utf8(body).lower().split()), size)
            if digest(values) == name:
                yield name, signature(values, count).astype(np.uint8).tobytes()

    return mapped(bodies_of(classes, docs), run, "class binary, signature binary").groupBy("class").agg(F.min("signature").alias("signature"))


def links(likely: DataFrame, classes: DataFrame, docs: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs (a, b) that hold on their full shingle sets."""
    likely = stored(likely.distinct(), "likely")
    needed = likely.select(F.col("a").alias("class")).unionByName(likely.select(F.col("b").alias("class"))).distinct()
    texts = stored(bodies_of(needed.join(classes.select("class", "head"), "class"), docs), "texts")
    full = likely.join(texts.select(F.col("class").alias("b"), F.col("_body").alias("tb")), "b").join(
        texts.select(F.col("class").alias("a"), F.col("_body").alias("ta")), "a"
    )
    percent = round(threshold * 100)

    def confirm(given: Iterator[tuple]) -> Iterator[tuple]:
        hashes, last = WordHashes(), (None, None, None)
        for a, b, ta, tb in given:
            if last[:2] != (a, ta):
                last = (a, ta, shingles(hashes.of(utf8(ta).lower().split()), size))
            x, y = last[2], shingles(hashes.of(utf8(tb).lower().split()), size)
            if (a, b) != (digest(x), digest(y)):
                continue  # another text under a repeated id
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= percent * (len(x) + len(y) - common):
                yield a, b

    return stored(mapped(full.select("a", "b", "ta", "tb"), confirm, "a binary, b binary"), "confirmed")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: float = 0.75,
    rows: int = ROWS,
    bands: int = BANDS,
    batch: int = BATCH,
    longer: int = 800,
    miss: float = 1e-5,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable) and kept."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"))
    own = stored(signed(docs, ["doc_id"], "_t", size, rows, bands), "signed")
    valid = own.where(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    # Equal sets have equal signatures; the smallest id stands for the class.
    heads = valid.groupBy("class").agg(F.min(F.struct("doc_id", "signature", "bands")).alias("h"))
    classes = stored(heads.select("class", F.col("h.doc_id").alias("head"), "h.signature", "h.bands"), "classes")
    members = classes.select("class", F.posexplode("bands").alias("band", "key"))
    full = members.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(members.join(full, ["band", "key"]), "shared")
    # The text that the others were copied from shares buckets with the most classes.
    weight = shared.groupBy("class").agg(F.sum("n").alias("weight"))
    hubs = shared.join(weight, "class").groupBy("band", "key").agg(F.max(F.struct("weight", "class")).alias("hub"))
    crowded = stored(shared.join(hubs, ["band", "key"]).select("band", "key", "class", "hub"), "crowded")
    stars = crowded.where("class != hub.class").select(F.col("hub.class").alias("a"), F.col("class").alias("b")).distinct()
    first = links(likely_pairs(stars, classes, threshold, batch, miss), classes, docs, size, threshold)
    group = components(first)

    family = crowded.groupBy("class").agg(F.max("hub").alias("main")).select("class", F.col("main.class").alias("family"))
    state = stored(
        family.join(group.withColumnRenamed("node", "class"), "class", "left").select(
            "class", "family", F.coalesce("component", "class").alias("component")
        ),
        "state",
    )
    placed = crowded.select("band", "key", "class").join(state, "class")
    # Only buckets that still hold several components, and only pairs across them.
    mixed = placed.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    open_ = stored(placed.join(mixed.select("band", "key"), ["band", "key"]), "open")
    x, y = open_.alias("x"), open_.alias("y")
    across = (
        x.join(
            y,
            (F.col("x.band") == F.col("y.band"))
            & (F.col("x.key") == F.col("y.key"))
            & (F.col("x.family") < F.col("y.family"))
            & (F.col("x.component") != F.col("y.component")),
        )
        .select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b"))
        .distinct()
    )
    loose = open_.select("class").distinct().join(state, "class")
    names = loose.select("class").join(classes.select("class", "head"), "class")
    # Written, because the sizes of families and their blocks both read it.
    named = stored(loose.join(long_signatures(names, docs, size, longer), "class"), "families")
    inside = family_pairs(named, threshold, batch, miss)
    second = links(
        likely_pairs(across, classes, threshold, batch, miss).unionByName(inside), classes, docs, size, threshold
    )
    # The components so far are stars; only the new links have to be worked in.
    group = components(group.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second))
    least = (
        classes.select(F.col("class").alias("node"), "head")
        .join(group, "node", "left")
        .select(F.col("node").alias("class"), "head", F.coalesce("component", "node").alias("component"))
    )
    low = least.groupBy("component").agg(F.min("head").alias("component_id"))
    named = least.join(low, "component").select("class", "component_id")
    return (
        own.select("doc_id", "n_shingles", "class")
        .join(named, "class", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
