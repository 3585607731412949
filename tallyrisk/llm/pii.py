"""Personal data: fixed patterns, and terms that give protected entities away.

The patterns find e-mail addresses, IP addresses, card numbers and phone
numbers.  Each such value, and each kind as a whole, is a protected entity.  A
term occurs with a value if it stands anywhere in a text that holds the value;
with a kind, which many texts hold, if it stands near a value of that kind.  All
counts are of distinct texts, so copies change none of them: all texts (N),
those with the term (df), with the entity, and with both (joint).  A term
reveals an entity as far as their pointwise mutual information reaches the
entity's own information content:

    disclosure = ln(N * joint / (df(term) * df(entity))) / ln(N / df(entity))

1 means that whoever reads the term knows the entity.  Terms above ``threshold``
that occur with the entity in at least ``support`` distinct texts are spans as
well, wherever they stand in any text.  For single occurrences there is no
evidence, so they stay.

``sanitised`` replaces entities by their kind, and revealing terms by the one
general word ``[something]``.

Defined results: a null or empty text has no spans; positions are code points,
end exclusive; a pattern's matches do not overlap and failing ones are dropped
without a retry; repeated rows get equal results; an empty table gives an empty
table.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.text import mapped, stored, utf8, with_row_id

#: The kinds in their order, and their patterns.
KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
TERM = "term"
ORDER = [*KINDS, TERM]
#: A kind occurs only in texts that have this character.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}

#: What an e-mail address is made of before the sign; a long run of it without a sign is skipped at once.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    """Check digit of a card number."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid(kind: str, value: str) -> bool:
    """Whether a match of a pattern holds as its kind."""
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in value.split("."))
    if kind == "card":
        digits = value.replace(" ", "").replace("-", "")
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= sum(c in "0123456789" for c in value) <= 15
    return True


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern; runs before a sign are looked at once."""
    at = text.find("@")
    done = 0
    while at >= 0:
        start = at
        while start > done and LOCAL.fullmatch(text[start - 1]):
            start -= 1
        found = KINDS["email"].match(text, start) if start < at else None
        if found:
            yield found.start(), found.end()
            done = found.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of the patterns, by kind, then start."""
    out = []
    digits = DIGIT.search(text) is not None
    for kind, pattern in KINDS.items():
        if NEEDS.get(kind, "") not in text or (kind != "email" and not digits):
            continue
        places = emails(text) if kind == "email" else ((m.start(), m.end()) for m in pattern.finditer(text))
        out += [(kind, a, b) for a, b in places if valid(kind, text[a:b])]
    return out


def entity_of(kind: str, value: str) -> str:
    """One name for all spellings of a value."""
    if kind == "email":
        return f"{kind}:{value.lower()}"
    return f"{kind}:{re.sub('[^0-9.]' if kind == 'ip' else '[^0-9]', '', value)}"


WORD = re.compile(r"[^\W\d_]{2,}")


def free_words(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of the words that touch no span, in order; one walk over words and spans."""
    if not spans:
        return [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
    ends, out, k = sorted((a, b) for _, a, b in spans), [], 0
    reach = 0
    for m in WORD.finditer(text):
        while k < len(ends) and ends[k][0] < m.end():
            reach = max(reach, ends[k][1])
            k += 1
        if m.start() >= reach:
            out.append((m.group().lower(), m.start(), m.end()))
    return out


def near_kinds(spans: list[tuple[str, int, int]], words: list[tuple[str, int, int]], width: int) -> set[tuple[int, str]]:
    """(kind's hash, term) of the ``width`` free words before and after each span of a kind."""
    starts, ends = [w[1] for w in words], [w[2] for w in words]
    out = set()
    for kind, a, b in spans:
        before, after = bisect_right(ends, a), bisect_left(starts, b)
        near = [*words[max(0, before - width) : before], *words[after : after + width]]
        out |= {(hashed(kind), w[0]) for w in near}
    return out


def hashed(entity: str) -> int:
    return xxhash.xxh3_64_intdigest(entity) >> 1


#: With this seed Spark's xxhash64 and the library give the same values.
SPARK_SEED = 42


def key_of(body: str) -> bytes:
    """What copies of a text share."""
    return xxhash.xxh3_128_digest(utf8(body))


def contexts(bodies: DataFrame, width: int) -> DataFrame:
    """Per text with spans its key, values, kinds, the kinds' terms and all terms; copies within a task once."""
    schema = "key binary, entities array<bigint>, kinds array<bigint>, near array<struct<entity: bigint, term: string>>, terms array<string>"

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        seen: set[bytes] = set()
        for (body,) in rows:
            spans = base_spans(body or "")
            key = key_of(body) if spans else b""
            if not spans or key in seen:
                continue
            if len(seen) > 100_000:
                seen.clear()
            seen.add(key)
            words = free_words(body, spans)
            values = sorted({hashed(entity_of(kind, body[a:b])) for kind, a, b in spans})
            kinds = sorted({hashed(kind) for kind, _, _ in spans})
            yield key, values, kinds, sorted(near_kinds(spans, words, width)), sorted({w[0] for w in words})

    return mapped(bodies, run, schema)


def candidates(docs: DataFrame, text: str, width: int, support: int, threshold: float) -> tuple[DataFrame, np.ndarray]:
    """Pairs that may reveal (entity, term, joint, de and size, which is N), and bits of the texts that have copies.

    A term's df is at least its number in texts with spans, and a pair reaches
    the threshold only if df <= joint * (N / de)^(1 - threshold).  So pairs are
    dropped by counts over the few texts with spans, and the words of all other
    texts need not be counted; no text leaves its task.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    copies = docs.select(F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(7), body).alias("k2")).groupBy("k1", "k2").agg(F.count("*").alias("n"))
    copies = stored(copies, "copies")
    size, copied = copies.count(), bits_of(copies.where(F.col("n") > 1).select(F.col("k1").alias("hash")))
    once = stored(contexts(docs.select(F.col(text).alias("_body")), width).dropDuplicates(["key"]), "contexts")
    entity = once.select(F.explode(F.concat("entities", "kinds")).alias("entity")).groupBy("entity").agg(F.count("*").alias("de"))
    entity = stored(entity.where((F.col("de") >= support) & (F.col("de") < size)), "entities")
    held = once.select("terms", F.explode("entities").alias("entity")).join(entity.select("entity"), "entity", "left_semi")
    pairs = held.select("entity", F.explode("terms").alias("term")).unionByName(once.select(F.inline("near")))
    joint = pairs.groupBy("entity", "term").agg(F.count("*").alias("joint")).where(F.col("joint") >= support)
    least = once.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("least"))
    most = F.col("joint") * F.pow(F.lit(size) / F.col("de"), F.lit(1 - threshold)) * (1 + 1e-9)
    rated = joint.join(entity, "entity").join(least, "term").where(F.col("least") <= most)
    return stored(rated.select("entity", "term", "joint", "de", F.lit(size).alias("size")), "candidates"), copied


def revealing_terms(pairs: DataFrame, places: DataFrame, threshold: float) -> DataFrame:
    """The terms of candidate pairs whose disclosure reaches the threshold; df counts distinct texts in ``places``.

    A text without copies is counted where it is; of texts that may have copies the (key, term) rows are made distinct.
    """
    found = places.select("key", F.explode(F.array_distinct("near.term")).alias("term"))
    single = found.where(F.col("key").isNull()).groupBy("term").agg(F.count("*").alias("df"))
    copied = found.where(F.col("key").isNotNull()).distinct().groupBy("term").agg(F.count("*").alias("df"))
    df = single.unionByName(copied).groupBy("term").agg(F.sum("df").alias("df"))
    disclosure = F.log(F.col("size") * F.col("joint") / (F.greatest("df", "joint") * F.col("de"))) / F.log(F.col("size") / F.col("de"))
    return pairs.join(df, "term").where(disclosure >= threshold).select("term").distinct()


#: Candidate terms, and texts with copies, are first looked up in bits.  Their number follows that of the terms, up to 16 MB.
FEWEST_BITS, MOST_BITS = 1 << 16, 1 << 27


def bits_of(hashes: DataFrame) -> np.ndarray:
    """A bit for each value of the column ``hash``, about 32 bits for each; empty without rows."""
    n = hashes.count()
    if not n:
        return np.zeros(0, np.uint8)
    size = FEWEST_BITS
    while size < min(32 * n, MOST_BITS):
        size *= 2
    place = F.pmod("hash", F.lit(size))
    # Set bits by byte: at most size / 8 rows, however many values there are.
    rows = hashes.select(F.shiftright(place, 3).alias("at"), F.expr("shiftleft(1, cast(pmod(hash, 8) as int))").alias("bit"))
    rows = rows.groupBy("at").agg(F.bit_or("bit").alias("bit")).toPandas()
    out = np.zeros(size // 8, np.uint8)
    out[rows["at"].to_numpy()] = rows["bit"].to_numpy()
    return out


def is_set(bits: np.ndarray, value: int) -> bool:
    """Whether the bit of a hash is set."""
    place = value % (len(bits) * 8) if len(bits) else 0
    return bool(len(bits) and bits[place >> 3] >> (place & 7) & 1)


def term_bits(pairs: DataFrame) -> np.ndarray:
    return bits_of(pairs.select("term").distinct().select(F.crc32(F.col("term").cast("binary")).alias("hash")))


def likely(words: list[tuple[str, int, int]], bits: np.ndarray) -> list[tuple[str, int, int]]:
    """The free words whose bit is set."""
    if not len(bits):
        return []
    known = {w: is_set(bits, zlib.crc32(w.encode("utf-8", "surrogatepass"))) for w in {w[0] for w in words}}
    return [w for w in words if known[w[0]]]


def scanned(docs: DataFrame, columns: list[str], text: str, hits: bool, bits: np.ndarray, copied: np.ndarray) -> DataFrame:
    """One pass over the texts: a row per document with its spans and the places of candidate terms.

    Texts that may have copies also get their key.  With ``hits`` documents with
    neither span nor place get no row.
    """
    given = with_row_id(docs.select(*columns, F.col(text).alias("_body")))
    left = given.drop("_body")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema)
    schema = f"{kinds}, spans array<struct<kind: string, start: int, end: int>>, key binary, near array<struct<term: string, start: int, end: int>>"

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for *own, body, row in rows:
            body = body or ""
            spans = base_spans(body)
            near = likely(free_words(body, spans), bits) if len(bits) else []
            if spans or near or not hits:
                twice = near and is_set(copied, xxhash.xxh64_intdigest(utf8(body), SPARK_SEED))
                yield *own, row, spans, key_of(body) if twice else None, near

    return mapped(given, run, schema)


def prepared(docs: DataFrame, text: str, width: int = 5, support: int = 3, threshold: float = 0.7) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Candidate pairs, bits of their terms, and bits of the texts that have copies."""
    pairs, copied = candidates(docs, text, width, support, threshold)
    return pairs, term_bits(pairs), copied


def found(
    docs: DataFrame,
    columns: list[str],
    text: str = "text",
    width: int = 5,
    support: int = 3,
    threshold: float = 0.7,
    hits: bool = False,
    known: tuple[DataFrame, np.ndarray, np.ndarray] | None = None,
) -> DataFrame:
    """``columns`` with ``spans``: array of (kind, start, end), patterns first, then revealing terms.

    With ``hits`` only documents that may have a span: one of a pattern, or a term whose bit is set.

    ``columns`` may hold the text itself; they must not be called ``_row``,
    ``spans``, ``key``, ``near`` or ``more``.
    """
    pairs, bits, copied = known or prepared(docs, text, width, support, threshold)
    places = stored(scanned(docs, columns, text, hits, bits, copied), "places")
    some = places.where(F.size("near") > 0)
    revealing = stored(revealing_terms(pairs, some, threshold), "revealing")
    near = some.select("_row", F.inline("near"))
    added = (
        near.join(revealing, "term")
        .groupBy("_row")
        .agg(F.sort_array(F.collect_set(F.struct(F.lit(TERM).alias("kind"), "start", "end"))).alias("more"))
    )
    return places.join(added, "_row", "left").select(
        *columns, F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.concat("spans", "more")).alias("spans")
    )


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of the patterns, the digest of their spans, and all spans as a text."""
    spans = found(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), ["doc_id"], "_t")
    shown = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"] != TERM)
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(F.transform(base, shown), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", shown), ",").alias("spans"),
        of(TERM).alias("n_term"),
    )


def replaced(text: str | None, spans: list) -> str | None:
    """The text with entities replaced by their kind and terms by a general word; overlaps count as one."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b, kind in sorted((s["start"], s["end"], s["kind"]) for s in spans):
        if a >= at:
            out += [text[at:a], "[something]" if kind == TERM else f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the spans replaced in ``text``; all columns stay, in their order.

    The columns travel under other names, so no name clashes with those made here.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    body = names[docs.columns.index(text)]
    plain = docs.toDF(*names)
    known = prepared(plain, body)
    bits = known[1]
    spans = found(plain, names, body, hits=True, known=known)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.toDF(*names).schema)
    place = names.index(body)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for *own, found_here in rows:
            own[place] = replaced(own[place], found_here)
            yield tuple(own)

    def untouched(rows: Iterator[tuple]) -> Iterator[tuple]:
        for row in rows:
            text_here = row[place] or ""
            if not base_spans(text_here) and not (len(bits) and likely(free_words(text_here, []), bits)):
                yield row

    # Most texts have no span: they pass straight through, and only the others are written and joined.
    return mapped(plain, untouched, kinds).unionByName(mapped(spans, run, kinds)).toDF(*docs.columns)
