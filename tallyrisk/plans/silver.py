"""From raw rows to the one cleaned transaction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.functions.events import CHANNEL_OF_TYPE, map_category
from tallyrisk.functions.timestamps import CARD_EPOCH, TRANSFER_EPOCH, from_offset_seconds, from_step_hours
from tallyrisk.operators.cleaning import (
    MEDIAN_ACCURACY,
    conform,
    dedup_first,
    enrich,
    fill_constants,
    impute_median,
)
from tallyrisk.schemas import C_COLS, D_COLS, V_COLS
from tallyrisk.session import shared_dir

# Fill values of the card data set.
COUNT_FILL = -999.0
CATEGORY_FILL = "UNKNOWN"
CATEGORY_COLS = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", "DeviceType"]
SIDE_COLS = ["DeviceType", "DeviceInfo"]


def impute_cards(df: DataFrame, accuracy: int | None = MEDIAN_ACCURACY) -> DataFrame:
    """Counts to -999, categories to UNKNOWN, V and D columns to their medians."""
    fills = {**{c: COUNT_FILL for c in C_COLS}, **{c: CATEGORY_FILL for c in CATEGORY_COLS}}
    return fill_constants(impute_median(df, V_COLS + D_COLS, accuracy), fills)


def conform_cards(df: DataFrame, silver_ts: Column) -> DataFrame:
    """Card rows (with ``transaction_ts``) in silver columns."""
    return conform(
        df,
        {
            "transaction_id": F.col("TransactionID").cast("string"),
            "customer_id": F.col("card1").cast("string"),
            "merchant_id": F.concat(F.lit("merchant_"), F.col("ProductCD")),
            "transaction_ts": F.col("transaction_ts"),
            "amount_usd": F.col("TransactionAmt"),
            "currency": F.lit("USD"),
            "channel": F.lit("card"),
            "merchant_category": F.col("ProductCD"),
            "card_type": F.col("card6"),
            "is_fraud": F.col("isFraud"),
            "data_source": F.lit("ieee_cis"),
            "_ingest_ts": F.col("_ingest_ts"),
            "_silver_ts": silver_ts,
        },
    )


def prepare_cards(
    tx: DataFrame, side: DataFrame, epoch: int = CARD_EPOCH, accuracy: int | None = MEDIAN_ACCURACY
) -> DataFrame:
    """The wide card table: enriched, then imputed (before any deduplication), with decoded time.

    The enriched table is written once to the shared folder: exact medians take
    several passes and the sketches one, and each would join both tables again.
    """
    spark, path = tx.sparkSession, shared_dir(tx.sparkSession, "enriched")
    enriched = enrich(tx, side, "TransactionID", SIDE_COLS)
    enriched.write.parquet(path)
    df = impute_cards(spark.read.schema(enriched.schema).parquet(path), accuracy)
    return df.withColumn("transaction_ts", from_offset_seconds(F.col("TransactionDT"), epoch))


def clean_cards(tx: DataFrame, silver_ts: Column, epoch: int = CARD_EPOCH) -> DataFrame:
    """Card source in silver columns: fill, decode, keep the first row per id, conform.

    Neither the side table nor the V and D columns reach the silver schema, and
    rows the side table would repeat are copies that deduplication removes.  So
    their join and medians (``prepare_cards``) are left out of this path.
    Copies of a key with equal time are ordered by their other values.
    """
    kept = ["TransactionAmt", "ProductCD", "card1", "card6", "isFraud", "_ingest_ts"]
    df = fill_constants(tx.select("TransactionID", "TransactionDT", *kept), {c: CATEGORY_FILL for c in CATEGORY_COLS})
    df = df.withColumn("transaction_ts", from_offset_seconds(F.col("TransactionDT"), epoch))
    return conform_cards(dedup_first(df, ["TransactionID"], ["transaction_ts", *kept]), silver_ts)


def transfer_id(*keys: Column) -> Column:
    """An id that is the same in every run, and differs if any key does; nulls count as values."""
    parts = F.to_json(F.array(*[k.cast("string") for k in keys]))
    return F.concat(F.lit("PS_"), F.sha2(parts.cast("binary"), 256))


def conform_transfers(df: DataFrame, silver_ts: Column) -> DataFrame:
    """Transfer rows (with ``transaction_ts`` and ``channel``) in silver columns."""
    return conform(
        df,
        {
            "transaction_id": transfer_id(F.col("nameOrig"), F.col("step"), F.col("amount") + F.lit(0.0)),
            "customer_id": F.col("nameOrig"),
            "merchant_id": F.col("nameDest"),
            "transaction_ts": F.col("transaction_ts"),
            "amount_usd": F.col("amount"),
            "currency": F.lit("USD"),
            "channel": F.col("channel"),
            "merchant_category": F.col("type"),
            "card_type": F.lit("transfer"),
            "is_fraud": F.col("isFraud"),
            "data_source": F.lit("paysim"),
            "_ingest_ts": silver_ts,
            "_silver_ts": silver_ts,
        },
    )


def dedup_transfers(df: DataFrame) -> DataFrame:
    """One row per (origin, step, amount): the smallest by its other columns."""
    return dedup_first(df, ["nameOrig", "step", "amount"], ["type", "nameDest", "isFraud"])


def clean_transfers(tx: DataFrame, silver_ts: Column, epoch: int = TRANSFER_EPOCH) -> DataFrame:
    """Transfer source end to end: decode, map the type, drop duplicates, conform."""
    df = tx.withColumns(
        {
            "transaction_ts": from_step_hours(F.col("step"), epoch),
            "channel": map_category(F.col("type"), CHANNEL_OF_TYPE, "other"),
        }
    )
    return conform_transfers(dedup_transfers(df), silver_ts)


def silver_table(*sources: DataFrame) -> DataFrame:
    """All cleaned sources as one table."""
    first, *rest = sources
    for df in rest:
        first = first.unionByName(df)
    return first
