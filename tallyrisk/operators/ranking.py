"""Quality of a score against labels.  Curves are built per distinct score, so ties are exact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.operators.ordering import running_totals


def _labelled(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())


def _curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, highest first: pos, neg and their running totals."""
    positive = F.col(label) == 1
    sums = {"pos": positive.cast("long"), "neg": (~positive).cast("long")}
    return running_totals(_labelled(df, score, label), score, sums, descending=True)


def _totals(df: DataFrame, score: str, label: str) -> Column:
    rows = _labelled(df, score, label)
    return rows.agg(
        F.struct(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
        )
    ).scalar()


def roc_auc(df: DataFrame, score: str = "score", label: str = "is_fraud") -> DataFrame:
    """Area under the ROC curve; ties count half.  Null if a class is missing."""
    above = F.col("cum_pos") - F.col("pos") / 2
    pairs = F.sum(F.col("neg") * above)
    return _curve(df, score, label).agg((pairs / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("roc_auc"))


def average_precision(df: DataFrame, score: str = "score", label: str = "is_fraud") -> DataFrame:
    """Sum over thresholds of the recall step times the precision there."""
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return _curve(df, score, label).agg(
        (F.sum(F.col("pos") * precision) / F.nullif(F.sum("pos"), F.lit(0))).alias("average_precision")
    )


def roc_points(df: DataFrame, score: str = "score", label: str = "is_fraud") -> DataFrame:
    """False and true positive rate at each distinct score."""
    return (
        _curve(df, score, label)
        .withColumn("_t", _totals(df, score, label))
        .select(
            F.col(score).alias("threshold"),
            (F.col("cum_neg") / F.nullif(F.col("_t.neg"), F.lit(0))).alias("fpr"),
            (F.col("cum_pos") / F.nullif(F.col("_t.pos"), F.lit(0))).alias("tpr"),
        )
    )


def pr_points(df: DataFrame, score: str = "score", label: str = "is_fraud") -> DataFrame:
    """Precision and recall at each distinct score."""
    return (
        _curve(df, score, label)
        .withColumn("_t", _totals(df, score, label))
        .select(
            F.col(score).alias("threshold"),
            (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
            (F.col("cum_pos") / F.nullif(F.col("_t.pos"), F.lit(0))).alias("recall"),
        )
    )


def threshold_report(
    df: DataFrame,
    thresholds: Sequence[float] = (0.3, 0.5),
    score: str = "score",
    label: str = "is_fraud",
) -> DataFrame:
    """Precision and recall of ``score >= threshold``, one row per threshold, in one pass."""
    rows = _labelled(df, score, label)
    positive = F.col(label) == 1
    aggs = []
    for t in thresholds:
        hit = F.col(score) >= t
        aggs.append(
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.count_if(hit & positive).alias("tp"),
                F.count_if(hit & ~positive).alias("fp"),
                F.count_if(~hit & positive).alias("fn"),
            )
        )
    one = rows.agg(F.array(*aggs).alias("t")).select(F.explode("t").alias("t")).select("t.*")
    tp, zero = F.col("tp"), F.lit(0)
    return one.withColumns(
        {
            "precision": F.coalesce(tp / F.nullif(tp + F.col("fp"), zero), F.lit(0.0)),
            "recall": F.coalesce(tp / F.nullif(tp + F.col("fn"), zero), F.lit(0.0)),
        }
    )


def class_weight(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Weight of a positive row: negatives over positives."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg((neg / F.nullif(pos, F.lit(0))).alias("positive_weight"))


def overlap_metrics(flagged: DataFrame, flag: str = "anomaly_label", label: str = "is_fraud") -> DataFrame:
    """How a flagged top fraction overlaps the positives."""
    one = flagged.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(F.col(flag) == 1).alias("n_anomalies"),
        F.count_if(F.col(label) == 1).alias("_pos"),
        F.count_if((F.col(flag) == 1) & (F.col(label) == 1)).alias("_both"),
    )
    share = F.coalesce(F.col("_both") / F.nullif(F.col("n_anomalies"), F.lit(0)), F.lit(0.0))
    return one.select(
        "n_samples",
        "n_anomalies",
        (F.col("n_anomalies") / F.nullif(F.col("n_samples"), F.lit(0))).alias("anomaly_rate"),
        share.alias("anomaly_fraud_overlap"),
        share.alias("precision_at_top1pct"),
        F.coalesce(F.col("_both") / F.nullif(F.col("_pos"), F.lit(0)), F.lit(0.0)).alias("fraud_recall_at_1pct"),
    )


def confusion_counts(flagged: DataFrame, flag: str = "anomaly_label", label: str = "is_fraud") -> DataFrame:
    """Positives caught and missed, and false positives."""
    hit, positive = F.col(flag) == 1, F.col(label) == 1
    return flagged.agg(
        F.count_if(hit & positive).alias("caught"),
        F.count_if(~hit & positive).alias("missed"),
        F.count_if(hit & ~positive).alias("false_positive"),
    )
