"""The queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.llm import bpe, chat, divergence, interleave, language, leaks, licence, minhash, pii, recompress, rules, trie, weaklabels
from tallyrisk.llm.text import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under the function's name."""
    QUERIES[run.__name__] = run
    return run


@query
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judged(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *rules.STATISTICS, "quality", "kept")


@query
def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.train(docs.where(~F.col("held_out")))
    found = language.predict(docs, model, ["doc_id", "held_out"])
    return found.withColumn("languages", F.to_json("languages"))


@query
def op9_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


@query
def op6_licence_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence.matches(table(spark, sf_dir, "documents"))


@query
def op5_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.digests(table(spark, sf_dir, "documents"))


@query
def op10_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave.digests(table(spark, sf_dir, "documents"))


@query
def op2_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weaklabels.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(given.unionByName(planted))


@query
def op12_count_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.digests(table(spark, sf_dir, "conversations"))


ORACLE["op11_reply_trees"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, k, ['user', 'assistant'][k + 1], '\### Assistant: </turn> ok' FROM range(2) AS t(k)
)
SELECT
    conv_id,
    count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(role) + length(text) + length('<turn ></turn>') + 1
        + len(regexp_extract_all(text, '\\|</?turn')) + len(regexp_extract_all(role, '\\|</?turn|>')))::BIGINT AS formatted_chars
FROM turns
GROUP BY conv_id
"""

ORACLE["op12_count_bitmaps"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
    FROM documents
),
tokens AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
),
kept AS (
    SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
),
counts AS (
    SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
),
langs AS (SELECT lang, count(*) AS v, sum(total) AS tokens FROM kept GROUP BY lang),
sizes AS (SELECT lang, source, sum(n) AS tokens FROM counts GROUP BY lang, source),
groups AS (
    SELECT lang, source, coalesce(s.tokens, 0)::HUGEINT AS n, coalesce(v, 0)::HUGEINT AS v, coalesce(l.tokens, 0)::HUGEINT AS whole
    FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN sizes AS s USING (lang, source) LEFT JOIN langs AS l USING (lang)
),
cells AS (
    SELECT lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p,
        1 + 1000000000::HUGEINT * (k.total + 1) // (g.whole + g.v) AS q
    FROM groups AS g JOIN kept AS k USING (lang) LEFT JOIN counts AS c USING (lang, source, term)
),
met AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM cells AS a JOIN cells AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
),
rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(m.value, 0) AS value
    FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN met AS m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM cells WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM rows
QUALIFY part = 'pair' OR rank <= 200
"""

ORACLE["op13_prefix_trie"] = r"""
WITH turns AS (
    SELECT conv_id AS c, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS said,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT c, list(said ORDER BY k) AS said FROM turns GROUP BY c),
seeds AS (
    SELECT c, said, c - c % 100 AS base, xor(list_reduce(
        list_prepend(4294967295::BIGINT, flatten([[ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(c::VARCHAR, '')])),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
    ), 4294967295) % 6 AS h
    FROM own
),
rebuilt AS (
    SELECT s.c, list_concat(coalesce(b.said[1:s.h], []), s.said[s.h + 1:]) AS said FROM seeds AS s LEFT JOIN own AS b ON b.c = s.base
),
members AS (SELECT c, said[1:d] AS path, len(said) = d AS last FROM rebuilt, range(0, len(said) + 1) AS t(d)),
nodes AS (
    SELECT path, len(path) AS depth, min(c) AS conv_id, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '') AS ends
    FROM members GROUP BY path
),
families AS (
    SELECT a.path, a.depth, a.conv_id, a.n, a.ends, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes AS k WHERE k.depth = a.depth + 1 AND k.path[1:a.depth] = a.path) AS n_children
    FROM nodes AS a LEFT JOIN nodes AS p ON a.depth > 0 AND p.path = a.path[1:a.depth - 1]
),
below AS (
    SELECT path[1:d] AS path, sum((n_children = 0)::INT) AS n_leaves, sum(CASE WHEN depth > 0 THEN (n - 1) * length(path[depth].text) ELSE 0 END) AS saved
    FROM families, range(0, depth + 1) AS t(d) GROUP BY ALL
)
SELECT conv_id::BIGINT AS conv_id, depth::BIGINT AS depth, parent_conv_id::BIGINT AS parent_conv_id, n::BIGINT AS n_convs,
    n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM families JOIN below USING (path)
"""
