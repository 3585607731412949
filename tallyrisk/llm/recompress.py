"""Removal of repeated word windows by recompression.

Words are hashed, and rounds of recompression name short runs and pairs of
neighbouring symbols: a pair is replaced if its first symbol falls on the left
and its second on the right of a coin that depends on the symbol and the round.
Names are hashes of what they stand for, so equal strings get equal names in
every task without a lookup.  A round changes at most one symbol at each edge of
a window, so two equal windows have the same symbol borders except in their
first and last ``TRIM`` words.

Each window picks one of its inner borders, the one with the smallest name of
the ``REACH`` words that follow.  Equal windows pick the same, so only borders
whose name occurs at two places can belong to a repeated window; they are found
by one aggregation.  The windows around them are then verified by 96-bit hashes
of all their words.  Texts are told apart by a hash of the text, so exact copies
count once in all of this and are settled by their number.

Every join is on a name, a window hash or a text hash; counts are combined
before they are shuffled, and a name that very many texts share only makes a
sort-merge join that the engine can split.

Defined results: words are what stands between ASCII white space, unchanged;
windows never cross documents; texts with fewer words than a window, null and
blank texts lose nothing; repeated rows are copies of each other; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.text import WordHashes, mapped, mix, stored, utf8

WINDOW = 35
#: Runs of two: 2 words; pairs of those: 2 more; pairs of pairs: 4 more.
TRIM, REACH = 8, 8
ROUNDS = 2
MANY = np.uint64(0x9E3779B97F4A7C15)


def borders(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places where the symbols of the last round begin; ``ends`` marks the last word of each document."""
    names, last, start = words, ends, np.arange(len(words))
    same = np.append((names[1:] == names[:-1]) & ~last[:-1], False)
    before, after = np.append(False, same[:-1]), np.append(same[1:], False)
    names, last, start = merged(names, last, start, same & ~before & ~after)
    for k in range(ROUNDS):
        right = (mix(names + np.uint64(k + 1)) >> np.uint64(63)).astype(bool)
        names, last, start = merged(names, last, start, np.append(~right[:-1] & right[1:] & ~last[:-1], False))
    return start


def merged(names: np.ndarray, last: np.ndarray, start: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """One symbol for each pair that begins where ``first`` is set."""
    at = np.flatnonzero(first)
    names, last = names.copy(), last.copy()
    names[at] = mix(mix(names[at]) + names[at + 1] * MANY)
    last[at] = last[at + 1]
    keep = np.ones(len(names), bool)
    keep[at + 1] = False
    return names[keep], last[keep], start[keep]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 ** 64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        x = np.full(n + 1, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def window_hashes(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of each run of ``width`` words, by start."""
    n = len(words)
    up, down = powers(base, n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[:n], dtype=np.uint64)])
    return mix((sums[width:] - sums[:-width]) * down[: n - width + 1])


class Parsed:
    """A batch of documents: word hashes end to end, and the border that each window picks."""

    def __init__(self, docs: list[np.ndarray]):
        sizes = np.array([len(d) for d in docs])
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.words = words = np.concatenate(docs)
        ends = np.zeros(len(words), bool)
        ends[self.first[1:][sizes > 0] - 1] = True
        start = borders(words, ends)
        n = len(words)
        # Starts of windows that stay inside one document.
        room = np.repeat(self.first[1:], sizes) - np.arange(n)
        self.windows = np.flatnonzero(room >= WINDOW)
        start = start[start <= n - REACH]
        names = window_hashes(words, REACH, 0x2545F4914F6CDD1D)[start] if n >= REACH else np.empty(0, np.uint64)
        low = np.searchsorted(start, self.windows + TRIM)
        high = np.searchsorted(start, self.windows + WINDOW - REACH, "right")
        self.names, self.start = names, start
        self.picked = smallest(names, low, high) if len(self.windows) else np.empty(0, np.int64)

    def owner(self, places: np.ndarray) -> np.ndarray:
        """The document of each place."""
        return np.searchsorted(self.first, places, "right") - 1


def smallest(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Index of the smallest value in each [low, high), the first one of equals; all ranges have a value."""
    bits = np.uint64(max(1, len(values)).bit_length())
    key = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    length = high - low
    out = np.empty(len(low), np.uint64)
    step = 1
    while True:
        use = np.flatnonzero((length >= step) & (length < 2 * step))
        out[use] = np.minimum(key[low[use]], key[high[use] - step])
        if step * 2 > length.max():
            break
        key = np.minimum(key, np.append(key[step:], np.full(step, np.iinfo(np.uint64).max, np.uint64)))
        step *= 2
    return (out & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def batches(rows: Iterator[tuple], hashes: WordHashes, most: int = 120_000) -> Iterator[tuple[list[tuple], Parsed]]:
    """Rows with texts of at least one window, about ``most`` words at a time; the text comes last."""
    out, docs, held = [], [], 0
    for row in rows:
        words = hashes.of(utf8(row[-1]).split())
        if len(words) < WINDOW:
            continue
        out.append(row)
        docs.append(words)
        held += len(words)
        if held >= most:
            yield out, Parsed(docs)
            out, docs, held = [], [], 0
    if out:
        yield out, Parsed(docs)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, k1, k2, _body): texts with 96 bits that tell them apart."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(body).alias("k1"),
        F.hash(body, F.lit(7)).alias("k2"),
        body.alias("_body"),
    )


def repeats(docs: DataFrame) -> DataFrame:
    """(k1, k2, starts): starts of windows that also occur elsewhere, for texts of ``docs`` (``keyed``).

    A window that only occurs in copies of its own text, once in each, is not
    listed; copies lose all their windows anyway.
    """

    def anchors(rows: Iterator[tuple]) -> Iterator[tuple]:
        for own, parsed in batches(rows, WordHashes()):
            chosen = np.unique(parsed.picked)
            places = parsed.start[chosen]
            docs_of = parsed.owner(places)
            names = parsed.names[chosen].view(np.int64).tolist()
            for d, p, name in zip(docs_of.tolist(), (places - parsed.first[docs_of]).tolist(), names):
                yield own[d][0], own[d][1], p, name

    found = stored(mapped(docs.select("k1", "k2", "_body"), anchors, "k1 long, k2 int, place int, name long", 20_000), "anchors")
    spot = F.xxhash64("k1", "k2", "place")
    # Tables of their own, so that both sides of a join are plain shuffles and a hot name can be split.
    several = stored(
        found.groupBy("name").agg(F.min(spot).alias("x"), F.max(spot).alias("y")).where("x != y").select("name"), "names"
    )
    suspects = found.join(several, "name").groupBy("k1", "k2").agg(F.collect_set("place").alias("places"))
    # One row stands for all copies of a text.
    heads = docs.groupBy("k1", "k2").agg(F.min(F.struct("doc_id")).alias("head"))
    chosen = stored(suspects.join(heads, ["k1", "k2"]).select("k1", "k2", F.col("head.doc_id").alias("h"), "places"), "suspects")
    texts = docs.join(
        chosen.withColumnsRenamed({"k1": "a1", "k2": "a2"}),
        (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")) & F.col("doc_id").eqNullSafe(F.col("h")),
    ).select("k1", "k2", "places", "_body")

    def windows(rows: Iterator[tuple]) -> Iterator[tuple]:
        for own, parsed in batches(rows, WordHashes()):
            n = len(parsed.words)
            suspect = np.zeros(n, bool)
            for d, row in enumerate(own):
                suspect[np.array(row[2]) + parsed.first[d]] = True
            use = parsed.windows[suspect[parsed.start[parsed.picked]]]
            one = window_hashes(parsed.words, WINDOW, 0xD1342543DE82EF95)[use].view(np.int64)
            two = (window_hashes(parsed.words, WINDOW, 0xAF251AF3B0F025B5)[use] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            docs_of = parsed.owner(use)
            for d, s, a, b in zip(docs_of.tolist(), (use - parsed.first[docs_of]).tolist(), one.tolist(), two.tolist()):
                yield own[d][0], own[d][1], s, a, b

    seen = stored(mapped(texts, windows, "k1 long, k2 int, start int, h1 long, h2 int", 20_000), "windows")
    spot = F.xxhash64("k1", "k2", "start")
    twice = stored(
        seen.groupBy("h1", "h2").agg(F.min(spot).alias("x"), F.max(spot).alias("y")).where("x != y").select("h1", "h2"), "twice"
    )
    return stored(seen.join(twice, ["h1", "h2"]).groupBy("k1", "k2").agg(F.collect_set("start").alias("starts")), "starts")


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` are the words left, joined by one blank."""
    given = keyed(docs, doc_id, text)
    copies = given.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2", F.lit(True).alias("copied"))
    marks = repeats(given).join(copies, ["k1", "k2"], "full_outer")
    kind = given.schema["doc_id"].dataType.simpleString()

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for name, body, starts, copied in rows:
            words = body.encode("utf-8", "surrogatepass").split()
            n = len(words)
            gone = np.zeros(n + 1, np.int64)
            if copied and n >= WINDOW:
                gone[:n] = 1
            elif starts:
                at = np.array(starts)
                gone = np.cumsum(np.bincount(at, minlength=n + 1)[: n + 1] - np.bincount(at + WINDOW, minlength=n + 1)[: n + 1])
            kept = [w for w, g in zip(words, gone[:n].tolist()) if g == 0]
            yield name, n, n - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")

    joined = given.join(marks, ["k1", "k2"], "left").select("doc_id", "_body", "starts", "copied")
    return mapped(joined, cut, f"doc_id {kind}, n_words long, n_removed long, kept string")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: words, removed words, and the digest of what is kept."""
    out = removed(docs, doc_id, text)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
