"""Feature views, point-in-time training sets and latest-value tables."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyrisk.operators.asof import Side, asof_many
from tallyrisk.schemas import CUSTOMER_FEATURES, MERCHANT_FEATURES, TRANSACTION_FEATURES
from tallyrisk.session import shared_dir
from tallyrisk.sources.buckets import upsert_buckets
from tallyrisk.sources.job_metrics import read_metrics, record_metrics
from tallyrisk.sources.readers import path_exists
from tallyrisk.sources.writers import upsert

DAY_S = 86400


@dataclass(frozen=True)
class FeatureView:
    """A table of features: entity key, time column, time to live, typed features."""

    name: str
    key: str
    ts: str
    ttl_s: int
    features: StructType

    @property
    def columns(self) -> list[str]:
        return self.features.fieldNames()

    def problems(self, df: DataFrame) -> list[str]:
        """What a table lacks to serve this view."""
        have = dict(df.dtypes)
        wanted = {f.name: f.dataType.simpleString() for f in self.features}
        found = [f"missing {c}" for c in (self.key, self.ts) if c not in have]
        for name, kind in wanted.items():
            if name not in have:
                found.append(f"missing {name}")
            elif have[name] != kind:
                found.append(f"{name}: {have[name]} is not {kind}")
        return found


def _view(name: str, key: str, ts: str, ttl_s: int, table: StructType) -> FeatureView:
    skipped = {key, ts, "feature_date"}
    return FeatureView(name, key, ts, ttl_s, StructType([f for f in table if f.name not in skipped]))


CUSTOMER_VIEW = _view("customer_features", "customer_id", "feature_date", 7 * DAY_S, CUSTOMER_FEATURES)
MERCHANT_VIEW = _view("merchant_features", "merchant_id", "feature_date", 7 * DAY_S, MERCHANT_FEATURES)
TRANSACTION_VIEW = _view(
    "transaction_features", "transaction_id", "transaction_ts", DAY_S, TRANSACTION_FEATURES
)
VIEWS = {v.name: v for v in (CUSTOMER_VIEW, MERCHANT_VIEW, TRANSACTION_VIEW)}


@dataclass(frozen=True)
class FeatureService:
    """Which columns of which views a consumer gets."""

    name: str
    columns: Mapping[str, Sequence[str]]


# The two services.
TRAINING_SERVICE = FeatureService("training", {v.name: v.columns for v in VIEWS.values()})
SERVING_SERVICE = FeatureService(
    "serving",
    {
        "customer_features": ["tx_count_1d", "tx_count_7d", "tx_amount_mean_7d", "fraud_rate_30d"],
        "merchant_features": ["fraud_rate_30d", "avg_amount_7d"],
        "transaction_features": [
            "hour_of_day",
            "is_night",
            "amount_log1p",
            "amount_zscore",
            "customer_tx_count_1h",
            "is_velocity_spike",
            "is_round_amount",
        ],
    },
)


def view_schema_check(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per view and expected feature, and whether the table has it with that type.

    Only schemas are read.
    """
    rows = []
    for name, df in tables.items():
        have = dict(df.dtypes)
        for f in VIEWS[name].features:
            rows.append((name, f.name, f.dataType.simpleString(), have.get(f.name) == f.dataType.simpleString()))
    return spark.createDataFrame(rows, "view string, feature string, type string, ok boolean")


def output_names(service: FeatureService) -> dict[str, dict[str, str]]:
    """Per view, output name of each column; a name used twice gets the view's name in front."""
    used = [c for cols in service.columns.values() for c in cols]
    return {
        view: {c: f"{view}__{c}" if used.count(c) > 1 else c for c in cols}
        for view, cols in service.columns.items()
    }


def historical_features(
    spine: DataFrame,
    service: FeatureService,
    tables: Mapping[str, DataFrame],
    spine_ts: str = "event_ts",
    views: Mapping[str, FeatureView] = VIEWS,
    row_id: str | None = None,
) -> DataFrame:
    """The spine rows with each view's features as they were known at the row's time.

    All views are looked up in one pass for each key, with narrow rows; see
    ``asof_many``.  ``row_id`` names a column that is unique in the spine; without
    one the spine is written once to the shared folder, with ids.
    """
    columns, key = spine.columns, row_id
    if key is None:
        key = "_spine_row"
        path = shared_dir(spine.sparkSession, "spine")
        spine.withColumn(key, F.monotonically_increasing_id()).write.parquet(path)
        spine = spine.sparkSession.read.parquet(path)
    sides = []
    for name, wanted in service.columns.items():
        view = views[name]
        table = tables[name].select(view.key, F.col(view.ts).alias("_feature_ts"), *wanted)
        sides.append(Side(f"_view_{name}", table, (view.key,), "_feature_ts", tuple(wanted), view.ttl_s))
    found = asof_many(spine, key, spine_ts, sides)
    names = output_names(service)
    out = [F.col(f"_view_{v}")[c].alias(names[v][c]) for v, wanted in service.columns.items() for c in wanted]
    return found.select(*columns, *out)


def latest_rows(source: DataFrame, key: str, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row per key (highest ``tie`` values among equal times)."""
    rest = [c for c in source.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(ts, *tie))
    return (
        source.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(key)
        .agg(newest.alias("_newest"))
        .select(key, *[F.col("_newest")[c].alias(c) for c in rest])
    )


def changed_rows(
    source: DataFrame, view: FeatureView, start: Column | None, end: Column, tie: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key with a time in (start, end]."""
    span = F.col(view.ts) <= end
    if start is not None:
        span = span & (F.col(view.ts) > start)
    return latest_rows(source.filter(span), view.key, view.ts, tie)


def materialize(
    spark: SparkSession,
    view: FeatureView,
    source: DataFrame,
    online_path: str,
    out_path: str,
    start: Column | None,
    end: Column,
    tie: Sequence[str] = (),
) -> dict[str, object]:
    """Bring a latest-value table up to ``end`` with the rows since the last run.

    A key's stored row is only replaced by a newer one, so a repeated or late
    run does no harm.
    """
    changed = changed_rows(source, view, start, end, tie)
    if path_exists(spark, online_path):
        stored = spark.read.parquet(online_path).select(F.col(view.key), F.col(view.ts).alias("_stored_ts"))
        changed = (
            changed.join(stored, view.key, "left")
            .filter(F.col("_stored_ts").isNull() | (F.col(view.ts) > F.col("_stored_ts")))
            .drop("_stored_ts")
        )
    return upsert(spark, changed, online_path, [view.key], out_path)


def materialize_buckets(
    spark: SparkSession,
    view: FeatureView,
    source: DataFrame,
    path: str,
    start: Column | None,
    end: Column,
    tie: Sequence[str] = (),
    buckets: int = 64,
) -> dict[str, object]:
    """``materialize`` for a bucketed table: only buckets with a changed key are rewritten, in place of the whole table."""
    return upsert_buckets(spark, changed_rows(source, view, start, end, tie), path, [view.key], buckets, newer=view.ts)


def materialize_due(
    spark: SparkSession,
    view: FeatureView,
    source: DataFrame,
    online_path: str,
    out_path: str,
    metrics_path: str,
    end: datetime,
    target_s: float = 300.0,
    tie: Sequence[str] = (),
) -> dict[str, float | None]:
    """Bring the table up to ``end`` from where the last recorded run ended, and record this run.

    The metrics table keeps per run the end reached, the seconds it took against
    ``target_s``, and how old the newest materialised row was at ``end``.  A run
    whose end is not after the last one writes no rows.  Times are in UTC.
    """
    job = f"materialize {view.name}"
    last = None
    if path_exists(spark, metrics_path):
        ends = read_metrics(spark, metrics_path, job).filter(F.col("metric") == "end_epoch_s")
        last = ends.agg(F.max("measured")).first()[0]
    upto = end.replace(tzinfo=timezone.utc).timestamp()
    began = time.monotonic()
    start = None if last is None else F.timestamp_seconds(F.lit(last))
    materialize(spark, view, source, online_path, out_path, start, F.timestamp_seconds(F.lit(upto)), tie)
    newest = spark.read.parquet(out_path).agg(F.max(F.unix_micros(F.col(view.ts).cast("timestamp")) / 1e6)).first()[0]
    measured = {
        "end_epoch_s": max(upto, last or upto),
        "seconds": time.monotonic() - began,
        "freshness_s": None if newest is None else upto - newest,
    }
    record_metrics(spark, metrics_path, job, measured, {"seconds": ("max", target_s)}, end)
    return measured


def online_lookup(
    requests: DataFrame,
    online: DataFrame,
    view: FeatureView,
    now: Column,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Request rows with the latest features of their key, null once older than the time to live."""
    columns = list(columns or view.columns)
    side = online.select(
        F.col(view.key).alias("_key"), F.col(view.ts).alias("_ts"), *[F.col(c).alias(f"_v_{c}") for c in columns]
    )
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("_ts").cast("timestamp"))
    fresh = (age >= 0) & (age <= view.ttl_s * 1_000_000)
    joined = requests.join(side, F.col(view.key) == F.col("_key"), "left")
    return joined.select(*requests.columns, *[F.when(fresh, F.col(f"_v_{c}")).alias(c) for c in columns])


def serving_projection(view_tables: Mapping[str, DataFrame], service: FeatureService) -> dict[str, DataFrame]:
    """Each view's table cut to its key, time and the service's columns."""
    return {
        name: view_tables[name].select(VIEWS[name].key, VIEWS[name].ts, *columns)
        for name, columns in service.columns.items()
    }
