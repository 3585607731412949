"""The batch jobs: land, clean, build features and labels, with run metrics.

Row counts are observed while the tables are written, so no input is read twice.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyrisk.operators.cleaning import add_audit_columns
from tallyrisk.models import boosting
from tallyrisk.operators.ranking import average_precision, roc_auc, threshold_report
from tallyrisk.operators.reports import label_summary
from tallyrisk.operators.sampling import stratified_split
from tallyrisk.plans import gold, silver
from tallyrisk.session import shared_dir
from tallyrisk.sources.job_metrics import record_metrics
from tallyrisk.sources.readers import path_exists, read_csv, read_table
from tallyrisk.sources.writers import write_table

# Targets of the jobs.
TARGETS = {"rows_per_minute": ("min", 1_000_000.0), "p95_ms": ("max", 2000.0)}
MODEL_TARGETS = {"roc_auc": ("min", 0.90), "recall_t30": ("min", 0.80)}


def _write_measured(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    mode: str,
    partition_by: Sequence[str],
    job: str,
    metrics_path: str | None,
    at: datetime | None = None,
    only_partitions: bool = False,
) -> int:
    """Write a table and append rows, seconds and rows per minute to the metrics table."""
    seen, start = Observation(), time.monotonic()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode, partition_by, only_partitions=only_partitions)
    rows, seconds = seen.get["rows"], time.monotonic() - start
    if metrics_path:
        measured = {"rows": rows, "seconds": seconds, "rows_per_minute": rows / seconds * 60}
        record_metrics(spark, metrics_path, job, measured, TARGETS, at or datetime.now(timezone.utc))
    return rows


def land_csv(
    spark: SparkSession,
    source: str,
    schema: StructType,
    out: str,
    batch_id: str,
    ingest_ts: datetime,
    fallback: str | None = None,
    metrics_path: str | None = None,
) -> int:
    """Append a CSV to its raw table, partitioned by load date.  A missing file lands nothing."""
    df = read_csv(spark, source, schema, optional=True, fallback=fallback)
    used = source if fallback is None or path_exists(spark, source) else fallback
    name = used.rsplit("/", 1)[-1]
    stamped = add_audit_columns(df, name, batch_id, F.lit(ingest_ts).cast("timestamp"))
    return _write_measured(spark, stamped, out, "append", ["_ingest_date"], f"land {name}", metrics_path)


def build_silver(
    spark: SparkSession,
    card_path: str,
    transfer_path: str,
    out: str,
    silver_ts: datetime,
    metrics_path: str | None = None,
) -> int:
    """Clean both sources into the transaction table, partitioned by source."""
    at = F.lit(silver_ts).cast("timestamp")
    cards = silver.clean_cards(read_table(spark, card_path), at)
    transfers = silver.clean_transfers(read_table(spark, transfer_path), at)
    table = silver.silver_table(cards, transfers)
    return _write_measured(spark, table, out, "overwrite", ["data_source"], "silver", metrics_path)


def build_wide_cards(spark: SparkSession, card_path: str, identity_path: str, out: str) -> None:
    """The enriched, imputed card table with all its columns."""
    wide = silver.prepare_cards(read_table(spark, card_path), read_table(spark, identity_path))
    write_table(wide, out, "overwrite")


def build_gold(
    spark: SparkSession,
    silver_path: str,
    out: str,
    feature_date: datetime,
    metrics_path: str | None = None,
) -> dict[str, int]:
    """The three feature tables below ``out``, each partitioned by feature date; other dates stay."""
    table = read_table(spark, silver_path)
    at = F.lit(feature_date).cast("timestamp")
    tables = {
        "customer_features": gold.customer_features(table, at),
        "merchant_features": gold.merchant_features(table, at),
        "transaction_features": gold.transaction_features(table, at),
    }
    return {
        name: _write_measured(
            spark, df, f"{out}/{name}", "overwrite", ["feature_date"], name, metrics_path, only_partitions=True
        )
        for name, df in tables.items()
    }


def build_labels(spark: SparkSession, silver_path: str, out: str, label_ts: datetime) -> DataFrame:
    """The label table, partitioned by source; returns its one-row summary."""
    labels = gold.fraud_labels(read_table(spark, silver_path), F.lit(label_ts).cast("timestamp"))
    write_table(labels, out, "overwrite", ["data_source"])
    return label_summary(read_table(spark, out))


def train_and_evaluate(
    spark: SparkSession,
    training: DataFrame,
    model_path: str,
    metrics_path: str | None = None,
    params: dict | None = None,
    together: int = 1,
    label: str = "is_fraud",
    at: datetime | None = None,
) -> dict[str, float | None]:
    """Fit on four fifths of each class, measure on the rest, save the nodes, record the metrics.

    ``training`` has transaction_id, the model's features and the label; it is
    read several times, so give a table.  Returns the metrics: rows and share of
    positives of the training part, seconds, ROC area, average precision, and
    precision and recall of scores from 0.3.
    """
    split = stratified_split(training, label, 0.2)
    train, test = (split.where(F.col("split") == part).drop("split") for part in ("train", "test"))
    start = time.monotonic()
    boosting.save(boosting.fit(train, label=label, params=params, together=together), model_path)
    seconds = time.monotonic() - start
    nodes = boosting.load(spark, model_path)
    scored_path = shared_dir(spark, "test-scores")
    boosting.score(test, nodes).select("score", label).write.parquet(scored_path)
    scored = spark.read.parquet(scored_path)
    size = train.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("share")).first()
    report = threshold_report(scored, [0.3], label=label).first()
    measured = {
        "train_rows": size["n"],
        "positive_share": size["share"],
        "seconds": seconds,
        "roc_auc": roc_auc(scored, label=label).first()[0],
        "average_precision": average_precision(scored, label=label).first()[0],
        "precision_t30": report["precision"],
        "recall_t30": report["recall"],
    }
    if metrics_path:
        record_metrics(spark, metrics_path, "train classifier", measured, MODEL_TARGETS, at or datetime.now(timezone.utc))
    return measured
