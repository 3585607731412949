"""How far the sources of a language differ: count-level bitmaps of terms.

Each kept term of a language gets a number, terms of similar frequency side by
side.  For every (group, count) a bitset holds the terms that occur so often in
the group, stored in words of 64 terms.  For two groups, AND and popcount of
their bitsets give the number of terms in every joint cell (count here, count
there); a cell's number times the value of its two probabilities is added up.
Cells with a zero come from complements: the terms of a bitset less those met in
the other group, and the terms of the language less those of either.

Terms are counted in tasks before anything moves, the pairs of a word are formed
by array operations in the task that has the word, and only sums per pair leave
it.  All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrisk.llm.text import stored, utf8

#: Probabilities are in parts of this.
SCALE = 1_000_000_000

#: ASCII letters in lower case, all bytes beyond ASCII, and blanks for the rest.
LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

PARTIAL = "lang string, source string, term string, n long, df long"
SUMS = "lang string, source string, item string, value long"


def _pieces(text: str | None, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text, about ``size`` bytes of it at a time."""
    data, at = utf8(text).translate(LETTERS), 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count(limit: int):
    """Terms of each (lang, source), with the number of documents; handed on when ``limit`` terms are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in held.items():
                if n:
                    terms = list(n)
                    columns = [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.string())]
                    columns += [pa.array(list(n.values()), pa.int64()), pa.array([df[t] for t in terms], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "df"])
            held.clear()

        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for text, lang, source in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    n, df = held.setdefault((lang, source), (Counter(), Counter()))
                    before, seen = len(n), set()
                    for terms in _pieces(text):
                        n.update(terms)
                        seen.update(terms)
                    df.update(seen)
                    size += len(n) - before
                    if size > limit:
                        yield from out()
                        size = 0
        yield from out()

    return run


def term_counts(docs: DataFrame, least: int, limit: int = 500_000) -> DataFrame:
    """lang, term, total, and the (source, n) of every source that has it, for terms in ``least`` documents of their language."""
    partial = docs.select("text", "lang", "source").mapInArrow(_count(limit), PARTIAL)
    # One shuffle serves both groupings: all rows of a (lang, term) are in one partition.
    counts = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("df").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("at")
    )
    return terms.where(F.col("df") >= least).select("lang", "term", "total", "at")


def div(a: Column, b: Column) -> Column:
    """Whole part of a / b as a long."""
    return F.call_function("div", a, b)


def probability(count: Column | str, tokens: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (tokens + terms)); the product may be beyond a long. Null without terms."""
    count = F.col(count) if isinstance(count, str) else count
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return 1 + div(wide, F.nullif(F.col(tokens) + F.col(terms), F.lit(0)))


def gain(p: str, q: str) -> Column:
    """(p - q)^2 div q; squares stay below 2^63 because p and q are at most SCALE + 1."""
    d = F.col(p) - F.col(q)
    return div(d * d, F.col(q))


def group_totals(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source, tokens (of kept terms), terms (kept in the language), lang_tokens for every occurring group."""
    own = terms.select("lang", F.explode("at").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("tokens"))
    whole = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_tokens"))
    found = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(whole, "lang", "left")
    return found.na.fill(0, ["tokens", "terms", "lang_tokens"])


def level_bitmaps(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """The bitsets: a row for each lang, word, source and count that occurs, bits being the word's 64 terms.

    Terms are numbered in the order of language and frequency, so that a word's
    terms are alike and share counts; its rows carry the group's tokens and terms.
    """
    rows = terms.repartitionByRange("lang", "total", "term").sortWithinPartitions("lang", "total", "term")
    rows = rows.withColumn("id", F.monotonically_increasing_id()).select("lang", "id", F.explode("at").alias("x"))
    rows = rows.select("lang", F.expr("id div 64").alias("word"), F.expr("shiftleft(1L, cast(id % 64 as int))").alias("bit"), "x.source", "x.n")
    rows = rows.join(groups.select("lang", "source", "tokens", "terms"), ["lang", "source"])
    return rows.groupBy("lang", "word", "source", "n", "tokens", "terms").agg(F.bit_or("bit").alias("bits"))


def _joint(cells: int, limit: int):
    """What the joint cells of each word add to every ordered pair of sources.

    A cell adds its number of terms times f(a, b) - f(a, 0) - f(0, b) + f(0, 0);
    the terms with zeros are then counted as if no two groups ever met.
    """

    def value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        d = p - q
        return d * d // q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int], int] = {}
        code: dict[str, int] = {}
        name: list[str] = []

        def out() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(keys := list(sums)), 50_000):
                part = keys[at : at + 50_000]
                columns = [pa.array([k[0] for k in part]), pa.array([name[k[1]] for k in part]), pa.array([name[k[2]] for k in part])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([sums[k] for k in part], pa.int64())], names=["lang", "source", "item", "value"])
            sums.clear()

        def add(lang: str, rows: pa.Table) -> None:
            for s in rows["source"].unique().to_pylist():
                if s not in code:
                    code[s] = len(name)
                    name.append(s)
            source = np.array([code[s] for s in rows["source"].to_pylist()])
            there, local = np.unique(source, return_inverse=True)
            bits = rows["bits"].to_numpy().view(np.uint64)
            n, size = rows["n"].to_pylist(), [t + v for t, v in zip(rows["tokens"].to_pylist(), rows["terms"].to_pylist())]
            p = np.array([1 + SCALE * (c + 1) // s for c, s in zip(n, size)], np.int64)
            zero = np.array([1 + SCALE // s for s in size], np.int64)
            total = np.zeros((len(there), len(there)), np.int64)
            step = max(1, cells // len(bits))
            for at in range(0, len(bits), step):
                met = np.bitwise_count(bits[at : at + step, None] & bits[None, :])
                i, j = np.nonzero(met)
                count, i = met[i, j].astype(np.int64), i + at
                apart = local[i] != local[j]
                i, j, count = i[apart], j[apart], count[apart]
                f = value(p[i], p[j]) - value(p[i], zero[j]) - value(zero[i], p[j]) + value(zero[i], zero[j])
                np.add.at(total, (local[i], local[j]), count * f)
            for i, j in zip(*np.nonzero(total)):
                key = (lang, int(there[i]), int(there[j]))
                sums[key] = sums.get(key, 0) + int(total[i, j])

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None and rest.num_rows else table
            if not table.num_rows:
                continue
            lang, word = table["lang"].to_numpy(), table["word"].to_numpy()
            cuts = [0, *(np.flatnonzero((word[1:] != word[:-1]) | (lang[1:] != lang[:-1])) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                add(lang[a], table.slice(a, b - a))
                if len(sums) > limit:
                    yield from out()
            rest = table.slice(cuts[-1]).combine_chunks()
        if rest is not None and rest.num_rows:
            add(rest["lang"][0].as_py(), rest)
        yield from out()

    return run


def _beside(rows: DataFrame, groups: DataFrame, salts: int = 16) -> DataFrame:
    """Each row of a group beside every other group of its language; a language is dealt to ``salts`` tasks or more."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    other = groups.select(
        "lang", F.col("source").alias("item"), F.col("tokens").alias("item_tokens"), F.explode(F.expr(f"sequence(0L, {salts - 1}L)")).alias("salt")
    )
    return rows.join(other, ["lang", "salt"]).where("source != item").drop("salt")


def pair_values(levels: DataFrame, groups: DataFrame, cells: int = 1 << 21, limit: int = 500_000) -> DataFrame:
    """lang, source, item, value of every ordered pair of sources of a language."""
    joint = levels.repartition("lang", "word").sortWithinPartitions("lang", "word").mapInArrow(_joint(cells, limit), SUMS)
    nothing = F.lit(0).cast("long")

    # Terms with a count here, as if none of them occurred in the other group, both ways round.
    count = levels.groupBy("lang", "source", "n", "tokens", "terms").agg(F.sum(F.bit_count("bits").cast("long")).alias("many"))
    alone = _beside(count, groups).select(
        "lang", "source", "item", "many", probability("n", "tokens", "terms").alias("p"), probability(nothing, "item_tokens", "terms").alias("q")
    )
    here = alone.groupBy("lang", "source", "item").agg(F.sum(F.col("many") * gain("p", "q")).alias("value"))
    there = alone.groupBy("lang", F.col("item").alias("source"), F.col("source").alias("item")).agg(
        F.sum(F.col("many") * gain("q", "p")).alias("value")
    )

    # The rest of the language's terms has a zero in both; terms met in both were added back in their cells.
    used = count.groupBy("lang", "source").agg(F.sum("many").alias("used"))
    sized = groups.join(used, ["lang", "source"], "left").na.fill(0, ["used"])
    both = _beside(sized.select("lang", "source", "tokens", "terms", "used"), sized.withColumn("tokens", F.struct("tokens", "used")))
    both = both.select(
        "lang", "source", "item",
        (F.col("terms") - F.col("used") - F.col("item_tokens.used")).alias("many"),
        probability(nothing, "tokens", "terms").alias("p"),
        (1 + div(F.lit(SCALE), F.nullif(F.col("item_tokens.tokens") + F.col("terms"), F.lit(0)))).alias("q"),
    )
    zero = both.select("lang", "source", "item", F.coalesce(F.col("many") * gain("p", "q"), nothing).alias("value"))
    parts = zero.unionByName(here).unionByName(there).unionByName(joint)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of the terms that a group has more often than its language."""
    rows = terms.select("lang", F.col("term").alias("item"), "total", F.explode("at").alias("x"))
    rows = rows.select("lang", "item", "total", "x.source", "x.n").join(groups, ["lang", "source"])
    rows = rows.select(
        "lang", "source", "item", probability("n", "tokens", "terms").alias("p"), probability("total", "lang_tokens", "terms").alias("q")
    )
    return rows.where("p > q").select("lang", "source", "item", gain("p", "q").alias("value"))


def audit(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """Divergence of each source from the others of its language, and its most telling terms.

    ``docs`` has text, lang and source; null counts as ''.  Terms are runs of
    ASCII letters, lower-cased, and of any characters beyond ASCII; a language
    keeps those found in ``least`` of its documents.  Returns lang, source, part,
    item, value, rank: part ``pair`` has every other source of the language,
    part ``term`` the ``top`` terms.  Ties go by the UTF-8 order of the item.
    A language without kept terms has pairs of value 0; a source that is alone in
    its language has no pair; an empty table gives no rows.
    """
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")))
    terms = stored(term_counts(docs, least), "terms")
    groups = stored(group_totals(docs, terms), "groups")
    levels = stored(level_bitmaps(terms, groups), "levels")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(levels, groups).withColumn("rank", rank)
    best = term_values(terms, groups).withColumn("rank", rank).where(F.col("rank") <= top)
    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", "rank"]
    return pairs.select(*columns("pair")).unionByName(best.select(*columns("term")))
