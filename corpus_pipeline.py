"""Corpus pipeline: quality rules, near-dedup, decontamination, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept.  All but the last return the columns of ``docs`` in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.llm import bpe, leaks, minhash, pii, rules
from tallyrisk.llm.text import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.filtered(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; rows that repeat an id count as copies."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    name = lambda column: names[docs.columns.index(column)]
    body = F.coalesce(F.col(name("text")), F.lit(""))
    # An id that repeats with another text is told apart by a hash of the text.
    own = F.struct(F.col(name("doc_id")).alias("doc_id"), F.xxhash64(body).alias("k1"), F.hash(body, F.lit(7)).alias("k2"))
    rows = docs.toDF(*names).withColumn("own", own)
    marks = minhash.near_duplicates(rows.select("own", F.col(name("text")).alias("text")), "own", "text")
    kept = marks.where("kept").select(F.col("doc_id").alias("own")).distinct()
    return rows.join(kept, "own", "left_semi").dropDuplicates(["own"]).select(*names).toDF(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and revealing terms replaced."""
    return pii.sanitised(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document."""
    import public_tokenizers

    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", good_quality),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("encoding", encode),
]

#: The stages have no SQL form; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
