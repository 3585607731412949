"""Boosted-tree classifier trained and applied inside Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.functions.risk import MISSING
from tallyrisk.operators.ranking import class_weight
from tallyrisk.schemas import MODEL_FEATURES

# Training parameters.
PARAMS = {"trees": 400, "depth": 7, "rate": 0.05, "row_share": 0.8, "column_share": 0.8, "seed": 42}


def train_classifier(
    df: DataFrame,
    columns: Sequence[str] = MODEL_FEATURES,
    label: str = "is_fraud",
    params: dict | None = None,
) -> PipelineModel:
    """Fit on labelled rows; positives weigh as much as all negatives together."""
    p = {**PARAMS, **(params or {})}
    weight = F.when(F.col(label) == 1, class_weight(df, label).scalar()).otherwise(F.lit(1.0))
    rows = df.select(*columns, F.col(label).cast("double").alias(label), weight.alias("_weight"))
    trees = GBTClassifier(
        featuresCol="_vector",
        labelCol=label,
        weightCol="_weight",
        maxIter=p["trees"],
        maxDepth=p["depth"],
        stepSize=p["rate"],
        subsamplingRate=p["row_share"],
        featureSubsetStrategy=str(p["column_share"]),
        seed=p["seed"],
    )
    assembler = VectorAssembler(inputCols=list(columns), outputCol="_vector")
    return Pipeline(stages=[assembler, trees]).fit(rows)


def feature_importance(
    spark: SparkSession, model: PipelineModel, columns: Sequence[str] = MODEL_FEATURES, k: int = 15
) -> DataFrame:
    """The k most important features; features never used are left out."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(columns, values) if v > 0]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(k)


def score(df: DataFrame, model: PipelineModel, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Batch or streaming rows with ``score``, the positive probability.

    A missing or null feature counts as 0 (the mean ratio as 1).
    """
    inputs = {}
    for c in columns:
        default = F.lit(MISSING.get(c, 0.0))
        inputs[f"_in_{c}"] = F.coalesce(F.col(c).cast("double"), default) if c in df.columns else default
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="_vector", handleInvalid="keep")
    vectors = assembler.transform(df.withColumns(inputs)).drop(*inputs)
    scored = model.stages[-1].transform(vectors)
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "_vector", "rawPrediction", "probability", "prediction"
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
