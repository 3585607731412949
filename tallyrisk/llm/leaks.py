"""Benchmark decontamination by word order, rated in a latent semantic space.

Texts become sequences of 16-bit word ids.  Passages are 32 words, begin every 8
words and are read with the words around them.  A passage holds an item if their
longest common subsequence, and that with the item's closing words (its answer),
are long enough, so paraphrases with changed, dropped or added words are found
and passages that only share vocabulary are not.

Document frequencies over all texts weight the terms (TF-IDF over 2 ** 14 term
buckets, each with a weight above 0), and a distributed randomised SVD finds
the leading right singular vectors: every task multiplies its passages with a
random matrix and back, A'(A R); the sums, of fixed size, are added up block by
block, and a single-pass (Nystroem) eigenvalue step on that small matrix gives
the vectors.  A passage whose vector is a neighbour of an item's, by a cosine of
``cosine`` at least, is checked.  Items longer than a passage have a vector for
each of their passages.  The weights fall steeply (the cube of the usual
logarithm), since with it alone passages of one language are all neighbours.

A cosine cannot promise to miss nothing, so the pairs of document and item that
are no neighbours get an exact look-up.  A match may miss a known number of the
item's words; so of its rarest words, some more than that number, a known count
must stand in the passage.  Places of these words are looked up in an index of
the items, and passages with enough of them are checked likewise.

Benchmark items come in blocks of fixed size, so the part that is sent to every
task stays small whatever their number.

Defined results: null and empty texts match nothing; an item of fewer than
``least`` words matches where its words stand side by side; several passages
that match an item count once, with the best values among those found the same way; words are compared as words; repeated rows give repeated
results; an empty benchmark or an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.recompress import powers
from tallyrisk.llm.text import mapped, mix, stored

TERMS = 1 << 14
RUN = 8  # passages are two or four runs of so many words
BLOCK = 256  # terms per block of the summed matrix
#: ASCII letters, digits and all bytes of other characters are parts of words.
IN_WORD = np.array([chr(b).isalnum() or b > 127 for b in range(256)])
VALUES = np.random.default_rng(313).integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = 0xD1342543DE82EF95
#: Cosine from which a passage is an item's neighbour.
COSINE = 0.65


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(BASE, size)


#: Characters that may be signs, or letters of scripts without blanks; the bytes that begin them.
WIDE = re.compile("[\u0080-\u00bf\u0800-\U0010ffff]+")
BEGINS_WIDE = np.array([b == 0xC2 or b >= 0xE0 for b in range(256)])
#: Thai, Lao, Tibetan, Burmese, Khmer; kana and ideographs; further ideographs.
BLANKLESS = [(0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x19E0, 0x19FF), (0x2E80, 0x312F), (0x31A0, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)]


class Spaced(dict):
    """Characters as they are hashed: signs are blanks, letters of scripts without blanks begin a word."""

    def __missing__(self, c: str) -> str:
        kind = unicodedata.category(c)
        out = c
        if kind[0] not in "LMN" and kind != "Cf":
            out = " "
        elif kind[0] != "M" and any(low <= ord(c) <= high for low, high in BLANKLESS):
            out = f" {c}"
        self[c] = out
        return out


SPACED = Spaced()


def spaced(text: str) -> str:
    """The text with blanks for signs and around each letter, with its marks, of scripts without blanks."""

    def parts(m: re.Match) -> str:
        run = "".join(map(SPACED.__getitem__, m.group()))
        return run + " " if run.rfind(" ") >= 0 else run

    return WIDE.sub(parts, text)


def word_ids(texts: list[str | None], bits: int = 16, split: bool = False) -> list[np.ndarray]:
    """Ids of ``bits`` bits (16 or 32) of the lower-cased words of each text; texts are hashed together, byte by byte.

    With ``split`` signs beyond ASCII part words, and letters of scripts without blanks are words.
    """
    lowered = [(t or "").lower() for t in texts]
    bodies = [t.encode("utf-8", "surrogatepass") for t in lowered]
    raw = np.frombuffer(b"\n".join([b"", *bodies, b""]), np.uint8)
    if split and (wide := np.flatnonzero(BEGINS_WIDE[raw])).size:
        for k in np.unique(np.searchsorted(np.cumsum([len(b) + 1 for b in bodies]), wide)).tolist():
            bodies[k] = spaced(lowered[k]).encode("utf-8", "surrogatepass")
        raw = np.frombuffer(b"\n".join([b"", *bodies, b""]), np.uint8)
    inside = IN_WORD[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edges[::2], edges[1::2]
    up, down = _powers(1 << max(20, len(raw).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[raw] * up[: len(raw)], dtype=np.uint64)])
    ids = (mix((sums[end] - sums[start]) * down[start]) >> np.uint64(64 - bits)).astype(np.uint16 if bits == 16 else np.uint32)
    ends = np.cumsum([len(b) + 1 for b in bodies])
    return np.split(ids, np.searchsorted(start, ends))[: len(bodies)]


#: What IN_WORD takes as a word.
SPELLED = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """The words whose ids ``word_ids`` gives with ``split``."""
    return SPELLED.findall(spaced((text or "").lower()).encode("utf-8", "surrogatepass"))


def in_batches(rows: Iterator[tuple], text: int, most: int = 500_000, bits: int = 16, split: bool = False) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """Rows of about ``most`` characters together, and the word ids of their texts."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += len(row[text] or "") + 16
        if held >= most:
            yield out, word_ids([r[text] for r in out], bits, split)
            out, held = [], 0
    if out:
        yield out, word_ids([r[text] for r in out], bits, split)


def tokenised(docs: DataFrame, doc_id: str | None, text: str) -> DataFrame:
    """A row (doc_id, ids) per document if ``doc_id`` is given, and rows (term, df) of document frequencies, in one pass."""
    given = docs.select((F.lit(0) if doc_id is None else F.col(doc_id)).alias("doc_id"), F.col(text).alias("_body"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        df, hit = np.zeros(TERMS, np.int64), np.zeros(TERMS, bool)
        for batch, found in in_batches(rows, 1, split=True):
            for (name, _), ids in zip(batch, found):
                hit[:] = False
                hit[ids >> 2] = True
                df += hit
                if doc_id is not None:
                    yield name, ids.tobytes(), None, None
        for term in np.flatnonzero(df):
            yield None, None, int(term), int(df[term])

    return mapped(given, run, f"doc_id {kind}, ids binary, term int, df long")


def cut(batch: list[tuple], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of all texts of a batch, the run of ``width`` words each is in, and where each text's runs begin."""
    terms = np.concatenate([ids for _, ids in batch]) >> 2
    first = np.concatenate([[0], np.cumsum([-(-len(ids) // width) for _, ids in batch])])
    run = np.concatenate([b + np.arange(len(ids)) // width for b, (_, ids) in zip(first, batch)])
    return terms, run, first


def summed(rows: np.ndarray, which: np.ndarray, groups: np.ndarray, count: int) -> np.ndarray:
    """Sums of ``rows[which]`` by group; equal ``groups`` are neighbours, and the last of ``rows`` is zero.

    Groups are filled up to slots of eight with the zero row, because sums of fixed size are fast.
    """
    size = np.bincount(groups, minlength=count)
    slots = -(-size // 8)
    first = np.cumsum(slots) - slots
    filled = np.full(8 * slots.sum(), len(rows) - 1)
    filled[np.arange(len(which)) + (8 * first - np.cumsum(size) + size)[groups]] = which
    eights = np.matmul(np.ones((1, 8), rows.dtype), rows.take(filled, 0).reshape(-1, 8, rows.shape[1]))[:, 0]
    out = np.zeros((count, rows.shape[1]), np.float32)
    some = np.flatnonzero(size)
    if len(some):
        out[some] = np.add.reduceat(eights, first[some], axis=0)
    return out


def batches(rows: Iterator[tuple], most: int = 150_000) -> Iterator[list[tuple]]:
    """Rows in lists of about ``most`` words; ids come second."""
    out, held = [], 0
    for row in rows:
        if len(row[1]):
            out.append(row)
            held += len(row[1])
            if held >= most:
                yield out
                out, held = [], 0
    if out:
        yield out


def vectors(tokens: DataFrame, idf: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the passages' TF-IDF matrix."""
    shared = tokens.sparkSession.sparkContext.broadcast(idf)
    width = 4 * RUN

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        weights = shared.value
        random = np.random.default_rng(seed).standard_normal((TERMS, rank)).astype(np.float32)
        zero = np.zeros((1, rank), np.float32)
        weighted = np.concatenate([random * weights[:, None], zero])
        total = np.zeros((TERMS, rank), np.float64)
        parts = ((None, np.frombuffer(ids, np.uint16)) for _, ids in rows)
        for batch in batches(parts):
            terms, run_of, first = cut(batch, width)
            sums = np.concatenate([summed(weighted, terms, run_of, first[-1]), zero])
            order = np.argsort(terms, kind="stable")
            total += summed(sums, run_of[order], terms[order], TERMS)
        total *= weights[:, None]
        for at in range(0, TERMS, BLOCK):
            yield at, total[at : at + BLOCK].astype(np.float32).tobytes()

    def add(group) -> object:
        import pandas as pd

        total = np.zeros(BLOCK * rank)
        for raw in group["part"]:
            total += np.frombuffer(raw, np.float32)
        return pd.DataFrame({"at": [group["at"].iloc[0]], "part": [total.tobytes()]})

    # A group has one row of fixed size per task.
    blocks = mapped(tokens, run, "at int, part binary", 16).groupBy("at").applyInPandas(add, "at int, part binary").collect()
    y = np.zeros((TERMS, rank))
    for row in blocks:
        y[row["at"] : row["at"] + BLOCK] = np.frombuffer(row["part"], np.float64).reshape(BLOCK, rank)
    random = np.random.default_rng(seed).standard_normal((TERMS, rank)).astype(np.float32)
    core = random.T @ y
    core = (core + core.T) / 2
    values, turn = np.linalg.eigh(core)
    good = values > values.max(initial=0) * 1e-9
    half_way = y @ (turn[:, good] / np.sqrt(values[good]))
    left, _, _ = np.linalg.svd(half_way, full_matrices=False)
    return left.astype(np.float32)


def common_length(masks: dict[int, int], words: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel; ``masks`` holds the places of each word of one side."""
    row = 0
    for w in words:
        x = row | masks.get(w, 0)
        row = x & ~(x - ((row << 1) | 1))
    return row.bit_count()


def places(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | (1 << k)
    return out


def passages(ids: np.ndarray, width: int) -> list[np.ndarray]:
    """Passages of up to ``width`` words, overlapping by half, that cover all of ``ids``."""
    step = width // 2
    return [ids[at : at + width] for at in range(0, max(1, len(ids) - step), step)]


@dataclass
class Items:
    """A block of benchmark items as the tasks need it; without a ``space`` there are no neighbours and no ratings.

    ``spelled`` has the items' words themselves.  Ids find a match, the words confirm it:
    words that share an id by chance can only add matches, never hide one.
    """

    names: list
    words: list[list[int]]
    df: np.ndarray  # document frequencies of the terms
    space: np.ndarray | None  # terms x rank, weighted by IDF
    share: float
    least: int
    spelled: list[list[bytes]] | None = None
    cosine: float = COSINE

    def __post_init__(self) -> None:
        self.masks, self.points, pairs = [], [], []
        self.need, self.seen = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.int64)
        for i, words in enumerate(self.words):
            m = len(words)
            answer = words[-max(1, m // 3) :]
            self.masks.append((places(words), places(answer), len(answer)))
            # A match misses at most m - need words, so of m - need + seen words it has ``seen``.
            need = m if m < self.least else max(self.least, math.ceil(self.share * m - 1e-9))
            self.need[i], self.seen[i] = need, min(need, max(3, m // 4))
            rarest = sorted(words, key=lambda w: (self.df[w >> 2], w))[: m - need + self.seen[i]]
            pairs += [(w, i) for w in set(rarest)]
            self.points.append(self.rated([np.array(words)], (4 * RUN,)))
        pairs.sort()
        self.holders = np.array([i for _, i in pairs], np.uint16)
        self.first = np.searchsorted(np.array([w for w, _ in pairs]), np.arange((1 << 16) + 1))
        self.reach = np.array([2 * len(words) + 4 * RUN for words in self.words])
        if self.space is not None:
            self.padded = np.concatenate([self.space, np.zeros((1, self.space.shape[1]), np.float32)])
            size = np.array([len(words) for words in self.words])
            self.sides = []  # (runs of a window, vectors of the items it is compared with, which items these are)
            for runs, fits in ((2, size <= 4 * RUN), (4, size > 2 * RUN)):
                which = np.flatnonzero(fits)
                if len(which):
                    self.sides.append((runs, np.concatenate([self.points[i] for i in which]), np.repeat(which, [len(self.points[i]) for i in which])))
        if self.spelled is not None:
            self.exact = [(places(w), places(w[-max(1, len(w) // 3) :])) for w in self.spelled]

    def rated(self, texts: list[np.ndarray], widths: tuple[int, ...]) -> np.ndarray | None:
        """Unit vectors of all passages of the texts."""
        if self.space is None:
            return None
        rows = np.stack([self.space[p >> 2].sum(0) for t in texts for width in widths for p in passages(t, width)])
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def found(self, docs: list[tuple]) -> Iterator[tuple[int, int, float, float, float]]:
        """(position of the document, position of the item, cosine, LCS share, answer share) of all matches.

        A document is its text and the ids of its words.
        """
        for d, i, *values, _ in self.located(docs):
            yield d, i, *values

    def located(self, docs: list[tuple]) -> Iterator[tuple[int, int, float, float, float, bool]]:
        """What ``found`` gives, and whether a neighbour in the latent space led to it: if not, the index of words did."""
        ids = [x for _, x in docs]
        near = self.confirmed(docs, self.neighbours(ids)) if self.space is not None else {}
        rest = self.confirmed(docs, (c for c in self.candidates(ids) if (c[0], c[2]) not in near))
        for (d, i), values in sorted([*near.items(), *rest.items()]):
            yield d, i, *values, (d, i) in near

    def confirmed(self, docs: list[tuple], candidates: Iterable[tuple[int, int, int]]) -> dict[tuple[int, int], tuple]:
        """The candidates that stand the check, by document and item."""
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        spelled: tuple[int, list[bytes]] = (-1, [])
        for d, at, i in candidates:
            if self.spelled is None:
                self.check(docs, best, d, at, i)
            elif self.shares(docs[d][1], self.words[i], self.masks[i], at, i) is not None:
                if spelled[0] != d:  # candidates come by document
                    spelled = d, words_of(docs[d][0])
                exact = self.shares(spelled[1], self.spelled[i], self.exact[i], at, i)
                if exact is not None:
                    self.rate(docs, best, d, at, i, exact)
        return best

    def neighbours(self, docs: list[np.ndarray], most: int = 1 << 22) -> Iterator[tuple[int, int, int]]:
        """(document, begin of a passage, item) wherever the vectors of passage and item are close; by document."""
        terms, run_of, first = cut([(None, ids) for ids in docs], RUN)
        runs = summed(self.padded, terms, run_of, first[-1])
        owner = np.repeat(np.arange(len(docs)), np.diff(first))
        windows = {1: runs}
        for half in (1, 2):
            both = windows[half].copy()
            both[:-half] += windows[half][half:] * (owner[:-half] == owner[half:])[:, None]
            windows[2 * half] = both
        keys = []
        for width, points, which in self.sides:
            # Windows overlap by half.
            begins = np.flatnonzero((np.arange(len(owner)) - first[owner]) % (width // 2) == 0)
            step = max(1, most // len(points))
            for some in np.split(begins, range(step, len(begins), step)):
                rows = windows[width][some]
                least = self.cosine * np.maximum(np.sqrt(np.einsum("ij,ij->i", rows, rows)), 1e-12)
                p, k = np.nonzero(rows @ points.T >= least[:, None])
                keys.append(some[p] * len(self.words) + which[k])
        for key in np.unique(np.concatenate(keys)).tolist():
            place, i = divmod(key, len(self.words))
            d = int(owner[place])
            yield d, (place - int(first[d])) * RUN, i

    def candidates(self, docs: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(document, begin of a passage, item) wherever enough of an item's rare words stand in reach of the passage."""
        ids = np.concatenate(docs).astype(np.int64)
        begin = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        count = self.first[ids + 1] - self.first[ids]
        hit = np.flatnonzero(count)
        if not len(hit):
            return
        count = count[hit]
        place = np.repeat(hit, count)
        offset = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
        item = self.holders[np.repeat(self.first[ids[hit]], count) + offset]
        order = np.argsort(item, kind="stable")  # places stay in order
        item, place = item[order].astype(np.int64), place[order]
        doc = np.searchsorted(begin, place, "right") - 1
        last = np.arange(len(place)) + self.seen[item] - 1
        inside = np.flatnonzero(last < len(place))
        last = last[inside]
        same = (item[last] == item[inside]) & (doc[last] == doc[inside]) & (place[last] - place[inside] < self.reach[item[inside]])
        inside, last = inside[same], last[same]
        item, doc = item[inside], doc[inside]
        start, stop = place[inside] - begin[doc], place[last] - begin[doc]
        size, step = self.reach[item] // 2 - 2 * RUN, RUN
        # Passages at multiples of ``step`` whose reach, from at - size up to at + 4 * RUN + size, holds both places.
        low = np.maximum(0, -((size + 4 * RUN - 1 - stop) // step))
        high = np.minimum((start + size) // step, (np.diff(begin)[doc] - 1) // step)
        wide = np.maximum(0, high - low + 1)
        at = np.repeat(low, wide) + np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        most = int(at.max(initial=0)) + 1
        for key in np.unique((np.repeat(doc, wide) * len(self.words) + np.repeat(item, wide)) * most + at).tolist():
            pair, a = divmod(key, most)
            yield pair // len(self.words), a * step, pair % len(self.words)

    def shares(self, words, item: list, masks: tuple, at: int, i: int) -> tuple[float, float] | None:
        """Shares of the item and of its answer that stand around the passage at ``at``, in order; None if too little.

        Words are ids or spelled, those of the item and of ``masks`` alike.
        """
        m = len(item)
        whole, closing = masks[:2]
        near = words[max(0, at - m) : at + 4 * RUN + m]
        near = near.tolist() if isinstance(near, np.ndarray) else near
        reach = [w for w in near if w in whole]
        if len(reach) < self.need[i]:
            return None
        if m < self.least and not any(near[k : k + m] == item for k in range(len(near) - m + 1)):
            return None
        length = common_length(whole, reach)
        if length < self.need[i]:
            return None
        answer = common_length(closing, reach) / max(1, m // 3)
        return None if answer < self.share - 0.1 else (length / m, answer)

    def check(self, docs: list[tuple], best: dict, d: int, at: int, i: int) -> None:
        """Compare the ids of the words around a candidate passage with the item."""
        near = self.shares(docs[d][1], self.words[i], self.masks[i], at, i)
        if near is not None:
            self.rate(docs, best, d, at, i, near)

    def rate(self, docs: list[tuple], best: dict, d: int, at: int, i: int, shares: tuple[float, float]) -> None:
        """Keep the best passage of a document and item."""
        cosine = 0.0
        if self.space is not None:
            passage = docs[d][1][at : at + 4 * RUN]
            cosine = float((self.rated([passage], (4 * RUN, 2 * RUN) if len(self.words[i]) <= 4 * RUN else (4 * RUN,)) @ self.points[i].T).max())
        if (cosine, *shares) > best.get((d, i), (-2.0,)):
            best[d, i] = (cosine, *shares)


def weighed(scan: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document frequency and weight of every term bucket; no weight is 0."""
    df = np.zeros(TERMS)
    for row in scan.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]  # at most one row per term bucket
    return df, ((np.log((size + 1) / (df + 1)) + 0.05) ** 3).astype(np.float32)


def blocks_of(
    benchmark: DataFrame, item_id: str, item_text: str, df: np.ndarray, space: np.ndarray, share: float, least: int, block: int,
    cosine: float = COSINE,
) -> list[Items]:
    """The benchmark in blocks, each item with its vectors in the latent space."""
    out, names, bodies, spelled = [], [], [], []

    def close() -> None:
        if names:
            out.append(Items(list(names), list(bodies), df, space, share, least, list(spelled), cosine))
            names.clear(), bodies.clear(), spelled.clear()

    for row in benchmark.select(item_id, item_text).where(F.col(item_text).isNotNull()).toLocalIterator():
        ids = word_ids([row[1]], split=True)[0].tolist()
        if ids:
            names.append(row[0])
            bodies.append(ids)
            spelled.append(words_of(row[1]))
        if len(names) >= block:
            close()
    close()
    return out


def prepared(
    docs: DataFrame, text: str, benchmark: DataFrame, item_id: str, item_text: str, rank: int, share: float, least: int, block: int, cosine: float
) -> list[Items]:
    """The benchmark in blocks, with the latent space of the documents."""
    scan = stored(tokenised(docs.select(F.lit(0).alias("doc_id"), F.col(text).alias("_t")), "doc_id", "_t"), "tokens")
    tokens = scan.where(F.col("ids").isNotNull()).select("doc_id", "ids")
    df, idf = weighed(scan, tokens.count())
    space = vectors(tokens, idf, rank) * idf[:, None]
    return blocks_of(benchmark, item_id, item_text, df, space, share, least, block, cosine)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", rank: int = 64, share: float = 0.7, least: int = 8, block: int = 4000, cosine: float = COSINE,
) -> DataFrame:
    """Rows (doc_id, item_id, cosine, lcs, answer, latent): documents that hold a benchmark item, and which.

    ``latent`` says whether a neighbour in the latent space led to the match, or
    the index of words.
    """
    blocks = prepared(docs, text, benchmark, item_id, item_text, rank, share, least, block, cosine)
    left = docs.schema[doc_id].dataType.simpleString()
    right = benchmark.schema[item_id].dataType.simpleString()
    schema = f"doc_id {left}, item_id {right}, cosine double, lcs double, answer double, latent boolean"
    out = docs.sparkSession.createDataFrame([], schema)
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_body"))
    for items in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(rows: Iterator[tuple], shared=shared) -> Iterator[tuple]:
            for batch, found in in_batches(rows, 1, split=True):
                some = [k for k, ids in enumerate(found) if len(ids)]
                for d, i, *values in shared.value.located([(batch[k][1], found[k]) for k in some]) if some else ():
                    yield batch[some[d]][0], shared.value.names[i], *values

        out = out.unionByName(mapped(given, run, schema))
    return out


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    rank: int = 64, share: float = 0.7, least: int = 8, block: int = 4000, cosine: float = COSINE,
) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns stay."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    body = docs.columns.index(text)
    blocks = prepared(docs, text, benchmark, item_id, item_text, rank, share, least, block, cosine)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    for items in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(rows: Iterator[tuple], shared=shared) -> Iterator[tuple]:
            for batch, found in in_batches(rows, body, split=True):
                some = [k for k, ids in enumerate(found) if len(ids)]
                hits = shared.value.found([(batch[k][body], found[k]) for k in some]) if some else ()
                bad = {some[d] for d, *_ in hits}
                yield from (row for k, row in enumerate(batch) if k not in bad)

        plain = mapped(plain, run, kinds)
    return plain.toDF(*docs.columns)
