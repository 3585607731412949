"""Removal of byte strings that occurred earlier, by merging sorted suffixes of all shards.

Every 100-byte string picks one place in it, the 32 bytes with the smallest hash;
equal strings pick the same.  Only suffixes that begin at picked places take
part, and of these only those whose 32 bytes occur twice, found by one
aggregation.  Each task lists its suffixes with the bytes before them.  The lists
meet by name, and are merged by refining their interleave: all suffixes of a name
start in one block; each round splits the blocks by the next eight bytes, and
blocks with one member are done, so nothing is sorted twice.  The order gives
the common prefixes of neighbours; the bytes before, refined in the same way, give
the common extension to the left, as the preceding symbols of a Burrows-Wheeler
transform do.  Together they give, for every string that a place stands for, the
interval of its occurrences; all but the first occurrence are removed.

A full transform would hold every suffix of the corpus and move it once per
round; see the README for figures.

A place that more than ``hot`` texts share would make one large block.  Its
strings go another way: their 96-bit hashes are aggregated and joined, work that
spreads over all tasks.  Exact copies are told apart by a hash of the text and
take part once.

Defined results: earlier means a smaller id, or an earlier start in the same
text; a null id comes after all others; rows that repeat id and text are treated
alike; two texts under one id are ordered by their hash; null and empty texts
lose nothing; matches never cross documents; overlaps count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.recompress import window_hashes
from tallyrisk.llm.text import mapped, stored

WIDTH, GRAM = 100, 32
REACH = WIDTH - GRAM  # a picked place is at most this far from the start of its string
VALUES = np.random.default_rng(991).integers(0, 1 << 64, 256, dtype=np.uint64)
LAST = (1 << 63) - 1


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value in each run of ``width`` values, the first of equals."""
    bits = np.uint64(max(1, len(values)).bit_length())
    key = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    step = 1
    while step * 2 <= width:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    if width > step:
        key = np.minimum(key[: len(key) - (width - step)], key[width - step :])
    return (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


class Picked:
    """A batch of texts as bytes end to end, the places their strings pick, and which strings pick each place."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts])
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        n = len(self.raw)
        self.values = VALUES[self.raw]
        names = window_hashes(self.values, GRAM, 0x2545F4914F6CDD1D)
        place = sliding_least(names, REACH + 1)
        room = np.repeat(self.first[1:], sizes) - np.arange(n)
        start = np.flatnonzero(room[: len(place)] >= WIDTH)
        place = place[start]
        head = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.empty(0, np.int64)
        tail = np.append(head[1:], len(place)) - 1
        self.place, self.low, self.high = place[head], start[head], start[tail]  # strings starting in [low, high]
        self.names = names[self.place]
        self.owner = np.searchsorted(self.first, self.place, "right") - 1


def batches(rows: Iterator[tuple], most: int = 500_000) -> Iterator[tuple[list[tuple], Picked]]:
    """Rows with texts of at least one string, about ``most`` bytes at a time; the text comes last."""
    out, held = [], 0
    for row in rows:
        body = row[-1].encode("utf-8", "surrogatepass")
        if len(body) < WIDTH:
            continue
        out.append((*row[:-1], body))
        held += len(body)
        if held >= most:
            yield out, Picked([r[-1] for r in out])
            out, held = [], 0
    if out:
        yield out, Picked([r[-1] for r in out])


def refined(blocks: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows within their blocks by their bytes, and the common prefix with the row before.

    ``blocks`` must not decrease.  Rows of different blocks have nothing in common.
    """
    count, width = rows.shape
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -width % 8)))).view(">u8").astype(np.uint64)
    order = np.arange(count)
    block = np.cumsum(np.append(0, blocks[1:] != blocks[:-1]))
    for k in range(words.shape[1]):
        size = np.bincount(block, minlength=count)
        open_ = np.flatnonzero(size[block] > 1)  # places of the interleave that are not settled
        if not len(open_):
            break
        mine = order[open_]
        turn = np.lexsort((words[mine, k], block[open_]))
        order[open_] = mine[turn]
        value, old = words[order[open_], k], block[open_]
        split = np.append(False, (value[1:] != value[:-1]) | (old[1:] != old[:-1]))
        fresh = np.zeros(count, bool)
        fresh[1:] = block[1:] != block[:-1]
        fresh[open_[split]] = True
        block = np.cumsum(fresh)
    ahead = rows[order]
    differ = ahead[1:] != ahead[:-1]
    common = np.where(differ.any(1), differ.argmax(1), width)
    common[blocks[order][1:] != blocks[order][:-1]] = -1
    return order, np.append(-1, common)


def later(group: np.ndarray, rank: np.ndarray, before: np.ndarray, after: np.ndarray, near: np.ndarray, far: np.ndarray):
    """(occurrence, distance) of all strings that an earlier occurrence also has.

    An occurrence has REACH bytes before and WIDTH bytes from its place on, and
    stands for the strings that start ``near`` to ``far`` bytes before the place.
    """
    right, right_common = refined(group, after)
    left, left_common = refined(group, before[:, ::-1])
    early = np.argsort(rank, kind="stable")
    n = len(group)
    out_i, out_d = [], []
    for d in range(REACH + 1):
        active = early[(near[early] <= d) & (far[early] >= d)]
        if len(active) < 2:
            continue
        a, b = np.empty(n, np.int64), np.empty(n, np.int64)
        a[right] = np.cumsum(right_common < WIDTH - d)
        b[left] = np.cumsum(left_common < d) if d else group[left]
        key = a[active] * (n + 1) + b[active]
        turn = np.argsort(key, kind="stable")
        again = np.append(False, key[turn][1:] == key[turn][:-1])
        out_i.append(active[turn[again]])
        out_d.append(np.full(int(again.sum()), d))
    if not out_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_d)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, k1, k2, _body): texts with 96 bits that tell them apart."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("k1"), F.hash(body, F.lit(7)).alias("k2"), body.alias("_body")
    )


def rank_of(column: str) -> Column:
    """Ids in their order, null last."""
    return F.coalesce(F.col(column), F.lit(LAST))


SPANS = "k1 long, k2 int, low int, high int"
MERGED = 10_000  # rows


def around(rows: pa.Table, far: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The REACH bytes before and the WIDTH bytes from each place on, as far as its strings reach; else zeros."""
    parts = rows["bytes"].cast(pa.large_binary()).combine_chunks()
    parts = parts.chunk(0) if isinstance(parts, pa.ChunkedArray) else parts
    starts = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts)]
    raw = np.pad(np.frombuffer(parts.buffers()[2], np.uint8), (REACH, WIDTH))
    out = np.lib.stride_tricks.sliding_window_view(raw, REACH + WIDTH)[starts + far]
    column = np.arange(REACH + WIDTH)
    out[(column < REACH - far[:, None]) | (column >= REACH + WIDTH - near[:, None])] = 0
    return out


def merged_spans(rows: pa.Table) -> pa.Table:
    """SPANS of the occurrences of whole names, in the order of their names."""
    name, rank, k1, k2, place, far, near = (
        rows[c].to_numpy().astype(np.int64) for c in ("name", "rank", "k1", "k2", "place", "far", "near")
    )
    given = around(rows, far, near)
    order = np.empty(len(name), np.int64)
    order[np.lexsort((place, k2, k1, rank))] = np.arange(len(name))
    group = np.cumsum(np.append(0, name[1:] != name[:-1]))
    i, d = later(group, order, given[:, :REACH], given[:, REACH:], near, far)
    turn = np.lexsort((d, i))
    i, d = i[turn], d[turn]
    # Distances that follow each other are one span.
    head = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (d[1:] != d[:-1] + 1))) if len(i) else np.empty(0, np.int64)
    tail = np.append(head[1:], len(i))[: len(head)] - 1
    i, least, most = i[head], d[head], d[tail]
    columns = {"k1": k1[i], "k2": k2[i].astype(np.int32), "low": (place[i] - most).astype(np.int32), "high": (place[i] - least + WIDTH).astype(np.int32)}
    return pa.table(columns)


def spans(docs: DataFrame, hot: int) -> DataFrame:
    """(k1, k2, low, high): byte ranges of texts of ``docs`` (``keyed``) to remove; they may overlap."""

    def picks(rows: Iterator[tuple]) -> Iterator[tuple]:
        for own, found in batches(rows):
            places = (found.place - found.first[found.owner]).tolist()
            for d, p, name in zip(found.owner.tolist(), places, found.names.view(np.int64).tolist()):
                yield own[d][0], own[d][1], p, name

    found = stored(mapped(docs.select("k1", "k2", "_body"), picks, "k1 long, k2 int, place int, name long", 20_000), "picks")
    spot = F.xxhash64("k1", "k2", "place")
    # A table of its own, so that both sides of the join are plain shuffles and a hot name can be split.
    several = stored(
        found.groupBy("name")
        .agg(F.min(spot).alias("x"), F.max(spot).alias("y"), F.count("*").alias("n"))
        .where("x != y")
        .select("name", (F.col("n") > hot).alias("hot")),
        "names",
    )
    marked = F.col("place").cast("long") * 2 + F.col("hot").cast("long")
    suspects = found.join(several, "name").groupBy("k1", "k2").agg(F.collect_set(marked).alias("places"))
    # The row with the smallest id stands for all copies of a text.
    heads = docs.groupBy("k1", "k2").agg(F.min(rank_of("doc_id")).alias("rank"))
    chosen = stored(suspects.join(heads, ["k1", "k2"]), "suspects").withColumnsRenamed({"k1": "a1", "k2": "a2"})
    texts = docs.join(
        chosen, (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")) & (rank_of("doc_id") == F.col("rank"))
    ).select("rank", "k1", "k2", "places", "_body")

    def occurrences(rows: Iterator[tuple]) -> Iterator[tuple]:
        """Suffixes with the bytes around them, and hashes of the strings of hot places."""
        for own, found in batches(rows):
            kind = np.zeros(len(found.raw), np.int8)
            for row, base in zip(own, found.first.tolist()):
                marks = np.array(row[3])
                kind[(marks >> 1) + base] = (marks & 1) + 1
            raw, heads = found.raw.tobytes(), [row[:3] for row in own]
            some = np.flatnonzero(kind[found.place] == 1)
            owner, place, low, high = found.owner[some], found.place[some], found.low[some], found.high[some]
            columns = (owner, found.names[some].view(np.int64), place - found.first[owner], place - low, place - high, low, high + WIDTH)
            for d, name, at, far, near, start, end in zip(*(c.tolist() for c in columns)):
                yield *heads[d], name, at, far, near, raw[start:end], None, None
            busy = np.flatnonzero(kind[found.place] == 2)
            if len(busy):
                one = window_hashes(found.values, WIDTH, 0xD1342543DE82EF95).view(np.int64)
                two = (window_hashes(found.values, WIDTH, 0xAF251AF3B0F025B5) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                for k in busy.tolist():
                    d = int(found.owner[k])
                    for s in range(int(found.low[k]), int(found.high[k]) + 1):
                        yield *own[d][:3], None, s - int(found.first[d]), None, None, None, int(one[s]), int(two[s])

    schema = "rank long, k1 long, k2 int, name long, place int, far int, near int, bytes binary, h1 long, h2 int"
    listed = stored(mapped(texts, occurrences, schema), "suffixes")

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole names, about ``MERGED`` rows at a time; rows come sorted by name."""
        held, size = [], 0
        for part in parts:
            held.append(part)
            size += part.num_rows
            if size < MERGED:
                continue
            rows = pa.Table.from_batches(held)
            names = rows["name"].to_numpy()
            change = np.flatnonzero(names[1:] != names[:-1])
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield from merged_spans(rows.slice(0, cut)).to_batches()
            # A copy: a slice would keep the whole rows.
            held, size = rows.take(np.arange(cut, rows.num_rows)).combine_chunks().to_batches(), rows.num_rows - cut
        if size:
            yield from merged_spans(pa.Table.from_batches(held)).to_batches()

    normal = listed.where(F.col("name").isNotNull()).select("name", "rank", "k1", "k2", "place", "far", "near", "bytes")
    merged = normal.repartition("name").sortWithinPartitions("name").mapInArrow(merge, SPANS)
    busy = listed.where(F.col("name").isNull()).select("h1", "h2", "rank", "k1", "k2", F.col("place").alias("start"))
    own = F.struct("rank", "k1", "k2", "start")
    first = busy.groupBy("h1", "h2").agg(F.min(own).alias("first"))
    again = busy.join(first, ["h1", "h2"]).where(own != F.col("first"))
    return stored(
        merged.unionByName(again.select("k1", "k2", F.col("start").alias("low"), (F.col("start") + WIDTH).alias("high"))), "spans"
    )


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = 50_000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): ``kept`` are the bytes left."""
    given = keyed(docs, doc_id, text)
    found = spans(given, hot).groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    copies = (
        given.groupBy("k1", "k2")
        .agg(F.min(rank_of("doc_id")).alias("head"), F.count("*").alias("n"))
        .where("n > 1")
        .select("k1", "k2", "head")
    )
    kind = given.schema["doc_id"].dataType.simpleString()

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for name, rank, body, found_here, head in rows:
            raw = np.frombuffer(body.encode("utf-8", "surrogatepass"), np.uint8)
            n = len(raw)
            gone = np.zeros(n, bool)
            if head is not None and rank > head and n >= WIDTH:
                gone[:] = True
            elif found_here:
                low = np.array([s["low"] for s in found_here])
                high = np.array([s["high"] for s in found_here])
                gone = np.cumsum(np.bincount(low, minlength=n + 1) - np.bincount(high, minlength=n + 1))[:n] > 0
            runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[:1].sum())
            yield name, n, int(gone.sum()), runs, raw[~gone].tobytes()

    joined = given.join(found.join(copies, ["k1", "k2"], "full_outer"), ["k1", "k2"], "left")
    return mapped(
        joined.select("doc_id", rank_of("doc_id").alias("_rank"), "_body", "spans", "head"),
        cut,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary",
    )


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: bytes, removed bytes, removed runs, and the digest of what is kept."""
    return removed(docs, doc_id, text).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
