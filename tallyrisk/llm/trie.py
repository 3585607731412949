"""Prefix trie of conversations from vertical bitmaps.

A turn is a 128-bit fingerprint of (role, text), so texts are read once and only
narrow rows move.  Conversations are dealt to shards by ranges of ids.  Inside a
shard an index leads from (position, turn) to the bitset of the conversations
that have that turn there; a node's children are the intersections of its bitset
with the postings of the next position, found depth first, and their members are
popcounts.  A node has the same name in every shard (a hash over its turns), so
shards are summed by name: a node has at most one row for each shard, however
many conversations pass through it, and its end list is one bitset for each.
"""

from __future__ import annotations

import hashlib
import struct
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrisk.llm.text import mapped, stored

ROOT = bytes(16)

LOCAL = "shard long, node binary, parent binary, depth long, n long, least long, chars long, ends binary"
SUMS = "node binary, parent_conv_id long, n_leaves long, saved long"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 1), a, b (the turn's fingerprint) and chars of each turn.

    Turns go by ``turn``, null first, ties by fingerprint; null roles and texts
    are empty.  Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(13), text, role).alias("b"),
        F.length(text).cast("long").alias("chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("at"), "a", "b", "chars")


def rebuilt(rows: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one, and the ids of all conversations.

    The first h turns of c - c % group (all if there are fewer, none if there is
    no such conversation), then the turns of c after its first h, where h is
    crc32 of the decimal c, modulo ``most``.
    """
    rows = stored(rows, "turns")
    size = rows.groupBy("conv_id").agg(F.max("at").alias("n"))
    convs = size.select(
        F.col("conv_id").alias("c"),
        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
    ).join(size.select(F.col("conv_id").alias("base"), F.col("n").alias("given")), "base", "left")
    convs = stored(convs.withColumn("given", F.least("h", F.coalesce("given", F.lit(0)))), "convs")
    first = rows.where(F.col("at") < most).join(convs, F.col("conv_id") == F.col("base")).where("at <= h")
    own = rows.join(convs, F.col("conv_id") == F.col("c")).where("at > h")
    out = first.select("c", "at", "a", "b", "chars").unionByName(
        own.select("c", (F.col("given") + F.col("at") - F.col("h")).alias("at"), "a", "b", "chars")
    )
    return out.withColumnRenamed("c", "conv_id"), convs.select(F.col("c").alias("conv_id"))


def prefix_trie(rows: DataFrame, convs: DataFrame, bits: int = 9) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie over all conversations, and their end lists by shard.

    ``rows`` has conv_id, at (1, 2, ... without gaps), a, b and chars; ``convs``
    every conv_id once, those without turns included.  Nodes have node (name),
    conv_id (smallest member; with depth it says where the node's turns can be
    read), depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens.
    End lists have node, shard and ends, a bitset: bit k is conversation
    shard * 2^bits + k.  No conversations give no nodes, not even a root.
    A shard is 2^bits ids; it and the longest conversation must fit one task.
    """
    members = rows.select("conv_id", "at", "a", "b", "chars").unionByName(
        convs.select("conv_id", F.lit(0).cast("long").alias("at"), *(F.lit(0).cast("long").alias(x) for x in ("a", "b", "chars")))
    )
    members = members.withColumn("shard", F.shiftright("conv_id", bits))
    local = stored(members.groupBy("shard").applyInArrow(_shard(bits), LOCAL), "trie")
    nodes = local.groupBy("node", "parent", "depth").agg(F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").select(
        "node", "depth", "n_convs", "conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children")
    )
    nodes = stored(nodes, "nodes")
    # Every node belongs to its smallest member, whose shard counts it; other members saved its text.
    known = local.drop("ends", "least").join(nodes.select("node", "conv_id", "n_children"), "node")
    known = known.withColumn("owned", F.shiftright("conv_id", bits) == F.col("shard"))
    sums = known.groupBy("shard").applyInArrow(_sums, SUMS)
    sums = sums.groupBy("node").agg(
        F.max("parent_conv_id").alias("parent_conv_id"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    return nodes.join(sums, "node"), local.where("ends IS NOT NULL").select("node", "shard", "ends")


def _shard(bits: int):
    """The trie of one shard."""

    def run(table: pa.Table) -> pa.Table:
        columns = {x: table[x].to_pylist() for x in ("conv_id", "at", "a", "b", "chars")}
        shard = table["shard"][0].as_py()
        posting: dict[tuple, int] = defaultdict(int)
        turns: dict[int, dict[int, tuple]] = defaultdict(dict)
        size: dict[int, int] = {}
        for conv, at, a, b, chars in zip(*columns.values()):
            k = conv - (shard << bits)
            size[k] = max(size.get(k, 0), at)
            if at:
                turns[k][at] = (a, b, chars)
                posting[at, a, b] |= 1 << k
        ended: dict[int, int] = defaultdict(int)
        for k, n in size.items():
            ended[n] |= 1 << k

        out = []
        todo = [(sum(1 << k for k in size), 0, ROOT, None, 0)]
        while todo:
            bitset, depth, name, parent, chars = todo.pop()
            ends = bitset & ended[depth]
            least = (shard << bits) + (bitset & -bitset).bit_length() - 1
            out.append((shard, name, parent, depth, bitset.bit_count(), least, chars, ends.to_bytes(1 << bits >> 3, "little") if ends else None))
            rest = bitset ^ ends
            while rest:
                a, b, length = turns[(rest & -rest).bit_length() - 1][depth + 1]
                child = rest & posting[depth + 1, a, b]
                todo.append((child, depth + 1, xxhash.xxh3_128_digest(name + struct.pack("<qq", a, b)), name, length))
                rest ^= child
        return _table(out, LOCAL)

    return run


def _sums(table: pa.Table) -> pa.Table:
    """Leaves and saved text below every node of one shard, and the smallest member of its parent."""
    columns = [table[x].to_pylist() for x in ("depth", "node", "parent", "n", "chars", "conv_id", "n_children", "owned")]
    rows = sorted(zip(*columns), key=lambda x: -x[0])
    conv = {node: c for _, node, _, _, _, c, _, _ in rows}
    leaves: dict[bytes, int] = defaultdict(int)
    saved: dict[bytes, int] = defaultdict(int)
    out = []
    for _, node, parent, n, chars, _, children, owned in rows:
        leaves[node] += owned and not children
        saved[node] += (n - owned) * chars
        if parent is not None:
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
        out.append((node, conv.get(parent), leaves[node], saved[node]))
    return _table(out, SUMS)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table([pa.array(list(c), kinds[k]) for (_, k), c in zip(fields, zip(*rows))], names=[n for n, _ in fields])


def end_digests(ends: DataFrame, bits: int = 9) -> DataFrame:
    """SHA-256 of the decimal ids of each end list, ascending and joined by commas, read shard by shard."""

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        now, digest = None, None
        for node, shard, ends in given:
            if node != now:
                if digest:
                    yield now, digest.hexdigest()
                now, digest, comma = node, hashlib.sha256(), ""
            left, ids = int.from_bytes(ends, "little"), []
            while left:
                ids.append(str((shard << bits) + (left & -left).bit_length() - 1))
                left &= left - 1
            digest.update((comma + ",".join(ids)).encode())
            comma = ","
        if digest:
            yield now, digest.hexdigest()

    dealt = ends.repartition("node").sortWithinPartitions("node", "shard")
    return mapped(dealt, rows, "node binary, ends_sha256 string")


def digests(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, a row for each node."""
    nodes, ends = prefix_trie(*rebuilt(turn_rows(conversations)))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(end_digests(ends), "node", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
