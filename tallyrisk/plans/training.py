"""Model training input."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyrisk.operators.cleaning import clean_non_finite
from tallyrisk.plans.gold import model_inputs
from tallyrisk.schemas import MODEL_FEATURES


def training_set(
    silver: DataFrame, include_current: bool = True, mean_history: DataFrame | None = None
) -> DataFrame:
    """Labelled rows with the 14 features in model order, finite and without nulls.

    The default follows the usual feature tables, whose 30-day rate sees the
    row's own label; pass ``include_current=False`` to train without that leak.
    """
    df = model_inputs(silver, include_current, mean_history).dropna(subset=["is_fraud"])
    return clean_non_finite(df, MODEL_FEATURES).select("transaction_id", *MODEL_FEATURES, "is_fraud")
