"""Scored rows: levels, reasons, summaries and the analyst sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.functions.risk import (
    ALERT_ABOVE,
    FLAG_ABOVE,
    explain_labels,
    fallback_record,
    risk_factors_a,
    risk_factors_b,
    risk_level,
    rule_explanation,
)
from tallyrisk.operators.sampling import ranked_top_k, top_k


def assess(df: DataFrame, score_col: str = "score") -> DataFrame:
    """Risk level, reasons and, above the flag threshold, the explanation.  Batch or stream."""
    df = risk_factors_a(df.withColumn("risk_level", risk_level(F.col(score_col))), score_col)
    df = rule_explanation(df, score_col)
    shown = F.when(F.col(score_col) > FLAG_ABOVE, F.col("explanation"))
    return df.withColumn("explanation", shown)


def flagged_only(df: DataFrame, score_col: str = "score", above: float = FLAG_ABOVE) -> DataFrame:
    return df.filter(F.col(score_col) > above)


def batch_summary(df: DataFrame, score_col: str = "score", threshold: float = ALERT_ABOVE) -> DataFrame:
    """Scored rows and rows above the alert threshold."""
    return df.agg(
        F.count(F.lit(1)).alias("results"), F.count_if(F.col(score_col) > threshold).alias("fraud_count")
    )


def explain_sample(features: DataFrame, k: int = 200) -> DataFrame:
    """k positives (by id) and the k largest negatives."""
    positives = top_k(features.filter(F.col("is_fraud") == 1), "transaction_id", k=k)
    negatives = top_k(
        features.filter(F.col("is_fraud") == 0), F.col("amount_log1p").desc(), "transaction_id", k=k
    )
    return positives.union(negatives)


def top_explained(features: DataFrame, score_col: str = "score", k: int = 200, top: int = 10) -> DataFrame:
    """The highest scores of the analyst sample with their fallback records, ranked."""
    best = ranked_top_k(
        explain_sample(features, k), F.col(score_col).desc(), "transaction_id", k=top
    )
    return explain_labels(fallback_record(risk_factors_b(best), score_col))
