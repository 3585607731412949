"""Repeatable samples, splits and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrisk.operators.ordering import few_rows, pick_by_hash


def top_k(df: DataFrame, *order: Column | str, k: int) -> DataFrame:
    """The first k rows of a total order (each task keeps k rows, then they are merged)."""
    return df.orderBy(*order).limit(k)


def ranked_top_k(df: DataFrame, *order: Column | str, k: int, name: str = "rank") -> DataFrame:
    """Top k with a rank number; the window only sees k rows."""
    return top_k(df, *order, k=k).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def balanced_sample(
    df: DataFrame, label: str = "is_fraud", ratio: int = 5, seed: str = "42", id_col: str = "transaction_id"
) -> DataFrame:
    """All positives and ``ratio`` times as many negatives, chosen by hash."""
    wanted = df.agg(F.count_if(F.col(label) == 1) * ratio).scalar()
    negatives = pick_by_hash(df.filter(F.col(label) == 0), id_col, wanted, seed=seed)
    return df.filter(F.col(label) == 1).unionByName(negatives.filter("picked").drop("picked"))


def stratified_split(
    df: DataFrame,
    label: str = "is_fraud",
    test_fraction: float = 0.2,
    seed: str = "42",
    id_col: str = "transaction_id",
) -> DataFrame:
    """Column ``split``: exactly the rounded fraction of each class is "test", chosen by hash."""
    size = F.floor(F.count(F.lit(1)) * F.lit(float(test_fraction)) + F.lit(0.5)).cast("long")
    # One row per class.
    sized = df.join(few_rows(df.groupBy(label).agg(size.alias("_size"))), label, "left")
    picked = pick_by_hash(sized, id_col, F.col("_size"), by=[label], seed=seed)
    return picked.withColumn("split", F.when(F.col("picked"), "test").otherwise("train")).drop("picked", "_size")
