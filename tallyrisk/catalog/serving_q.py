"""Scoring, explanation and feature-store queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tallyrisk.catalog.features_q import (
    CUSTOMER_COUNTS,
    CUSTOMER_LATEST,
    MERCHANT_LATEST,
)
from tallyrisk.catalog.inputs import as_of, scored, silver, table
from tallyrisk.catalog.registry import cte, query, rounded, rs, sql, text_ts, text_ts_sql
from tallyrisk.functions import risk
from tallyrisk.operators.asof import asof_join
from tallyrisk.operators.rolling import rolling
from tallyrisk.plans import feature_store as store
from tallyrisk.plans import gold, scoring
from tallyrisk.session import shared_dir
from tallyrisk.sources.job_metrics import metric_status, read_metrics

# --- levels, reasons, texts ---------------------------------------------------------


@query(
    "risk_level",
    sql(
        """SELECT transaction_id, CASE WHEN score < 0.3 THEN 'low' WHEN score < 0.6 THEN 'medium'
  WHEN score < 0.85 THEN 'high' ELSE 'critical' END AS risk_level FROM scored""",
        "scored",
    ),
)
def _(spark, sf):
    return scored(spark, sf).select("transaction_id", risk.risk_level(F.col("score")).alias("risk_level"))


def num(value: str, digits: int) -> str:
    return f"printf('%.{digits}f', round({value}, {digits}))"


cte(
    "reasons_a",
    f"""SELECT transaction_id, score, CASE WHEN len(f) = 0 THEN ['Anomalous feature combination (score='
  || {num('score', 2)} || ')'] ELSE f[1:3] END AS factors FROM (SELECT *, list_filter([
  CASE WHEN is_velocity_spike = 1 THEN 'High transaction velocity (' || customer_tx_count_1h || ' tx in 1h)'
    WHEN customer_tx_count_1h >= 5 THEN 'Elevated 1h velocity (' || customer_tx_count_1h || ' tx in 1h)' END,
  CASE WHEN is_night = 1 THEN 'Night-time transaction (' || printf('%02d', hour_of_day) || ':00h)' END,
  CASE WHEN is_round_amount = 1 THEN 'Round amount ($' || {num('exp(amount_log1p) - 1', 2)} || ')' END,
  CASE WHEN ratio >= 2 THEN 'Amount ' || {num('ratio', 1)} || 'x above baseline' END,
  CASE WHEN fraud_rate_30d > 0.05 THEN 'High historical fraud rate (' || {num('fraud_rate_30d * 100', 1)}
    || '% over 30d)' END,
  CASE WHEN abs(amount_zscore) > 2.5 THEN 'Unusual amount (z-score=' || {num('amount_zscore', 1)} || ')' END],
  lambda x: x IS NOT NULL) AS f FROM (SELECT *, coalesce(amount_vs_mean_ratio, 1.0) AS ratio FROM scored))""",
    ("scored",),
)


@query(
    "risk_factors_a",
    sql("SELECT transaction_id, list_aggregate(factors, 'string_agg', '|') AS factors FROM reasons_a", "reasons_a"),
)
def _(spark, sf):
    df = risk.risk_factors_a(scored(spark, sf))
    return df.select("transaction_id", F.concat_ws("|", "top_risk_factors").alias("factors"))


cte(
    "reasons_b",
    f"""SELECT *, CASE WHEN len(f) = 0 THEN ['No single dominant signal — ensemble of weak indicators'] ELSE f END
  AS signals FROM (SELECT *, list_filter([
  CASE WHEN is_velocity_spike = 1 THEN '1. VELOCITY SPIKE — ' || customer_tx_count_1h || ' txns in 1 hour' END,
  CASE WHEN abs(amount_zscore) > 2 THEN '2. UNUSUAL AMOUNT — ' || CASE WHEN amount_zscore >= 0 THEN '+' ELSE '' END
    || {num('amount_zscore', 1)} || ' standard deviations' END,
  CASE WHEN is_night = 1 THEN '3. NIGHT-TIME TRANSACTION — unusual hours increase fraud risk' END,
  CASE WHEN fraud_rate_30d > 0.05 THEN '4. HIGH-RISK CUSTOMER — ' || {num('fraud_rate_30d * 100', 1)}
    || '% fraud rate in last 30 days' END,
  CASE WHEN is_round_amount = 1 THEN '5. ROUND AMOUNT — often used in card testing attacks' END,
  CASE WHEN coalesce(amount_vs_mean_ratio, 1.0) > 3 THEN '6. AMOUNT SPIKE — ' || {num('amount_vs_mean_ratio', 1)}
    || 'x above customer average' END], lambda x: x IS NOT NULL) AS f FROM scored)""",
    ("scored",),
)
_PLAIN_B = "list_aggregate(list_transform(signals, lambda s: regexp_replace(s, '^[0-9. ]+', '')), 'string_agg', '|')"


@query(
    "risk_factors_b",
    sql(
        f"""SELECT transaction_id, list_aggregate(signals, 'string_agg', chr(10)) AS signals, {_PLAIN_B} AS risk_factors
  FROM reasons_b""",
        "reasons_b",
    ),
)
def _(spark, sf):
    df = risk.risk_factors_b(scored(spark, sf))
    return df.select("transaction_id", "signals", F.concat_ws("|", "risk_factors").alias("risk_factors"))


@query(
    "rule_explanation",
    sql(
        f"""SELECT transaction_id, CASE WHEN score > 0.3 THEN 'Transaction flagged as '
  || CASE WHEN score > 0.5 THEN 'high risk' ELSE 'elevated risk' END || ' (score=' || {num('score', 2)}
  || '). Key signals: ' || list_aggregate(factors[1:2], 'string_agg', '; ') || '.' END AS explanation FROM reasons_a""",
        "reasons_a",
    ),
)
def _(spark, sf):
    return scoring.assess(scored(spark, sf)).select("transaction_id", "explanation")


@query(
    "explain_labels",
    sql(
        f"""SELECT transaction_id, CASE WHEN is_night = 1 THEN '(night-time)' ELSE '(daytime)' END AS night_label,
  CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_label,
  CASE WHEN is_round_amount = 1 THEN 'Yes (common in fraud testing)' ELSE 'No' END AS round_amount_label,
  CASE WHEN is_velocity_spike = 1 THEN 'YES — unusual burst' ELSE 'No' END AS velocity_label,
  round(exp(amount_log1p) - 1, 2) AS amount FROM scored""",
        "scored",
    ),
)
def _(spark, sf):
    return risk.explain_labels(scored(spark, sf)).select(
        "transaction_id", "night_label", "day_label", "round_amount_label", "velocity_label", "amount"
    )


cte(
    "sample_rows",
    """SELECT * FROM ((SELECT * FROM reasons_b WHERE is_fraud = 1 ORDER BY transaction_id LIMIT 200)
  UNION ALL (SELECT * FROM reasons_b WHERE is_fraud = 0 ORDER BY amount_log1p DESC, transaction_id LIMIT 200))""",
    ("reasons_b",),
)


@query("explain_sample", sql("SELECT transaction_id, is_fraud FROM sample_rows", "sample_rows"))
def _(spark, sf):
    return scoring.explain_sample(scored(spark, sf)).select("transaction_id", "is_fraud")


@query(
    "top10_flagged",
    sql(
        f"""SELECT cast(row_number() OVER (ORDER BY score DESC, transaction_id) AS integer) AS rank, transaction_id,
  round(score, 4) AS fraud_score, 'Transaction flagged at ' || {num('score * 100', 1)}
  || '% confidence. Manual review required.' AS summary, {_PLAIN_B} AS risk_factors,
  'Hold for manual review' AS recommended_action, 'rule-based-fallback' AS model FROM sample_rows
  ORDER BY score DESC, transaction_id LIMIT 10""",
        "sample_rows",
    ),
)
def _(spark, sf):
    df = scoring.top_explained(scored(spark, sf))
    return df.select(
        "rank",
        "transaction_id",
        "fraud_score",
        "summary",
        F.concat_ws("|", "risk_factors").alias("risk_factors"),
        "recommended_action",
        "model",
    )


# --- point-in-time joins ---------------------------------------------------------------

_SPINE = "(SELECT event_id AS spine_id, user_id, ts FROM events WHERE event_type = 'purchase')"
_FACTS = "(SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view')"


def asof_sql(condition: str) -> str:
    value = f"CASE WHEN {condition} THEN f.value END AS view_value"
    ident = f"CASE WHEN {condition} THEN f.event_id END AS view_event_id"
    return f"""SELECT s.spine_id, s.user_id, {value}, {ident} FROM {_SPINE} s ASOF LEFT JOIN {_FACTS} f
  ON s.user_id = f.user_id AND s.ts >= f.ts"""


def _asof(spark, sf, ttl):
    events = table(spark, sf, "events")
    spine = events.filter("event_type = 'purchase'").select(F.col("event_id").alias("spine_id"), "user_id", "ts")
    facts = events.filter("event_type = 'view'").select("event_id", "user_id", "ts", "value")
    out = asof_join(
        spine, facts, ["user_id"], "ts", "ts", ["value", "event_id"], ttl_s=ttl, prefix="view_", tie=["event_id"]
    )
    return out.drop("ts")


@query("asof_join", asof_sql("true"))
def _(spark, sf):
    return _asof(spark, sf, None)


@query("asof_join_ttl", asof_sql("epoch_us(s.ts) - epoch_us(f.ts) <= 86400000000"))
def _(spark, sf):
    return _asof(spark, sf, 86400)


# Daily snapshots of customer and merchant features and per-event features, joined to labels.
cte(
    "snap_c",
    """SELECT customer_id, date_trunc('day', transaction_ts) + INTERVAL 1 DAY AS at, count(*) AS tx_count_1d,
  avg(cast(is_fraud AS double)) AS fraud_rate_30d FROM silver WHERE dayofmonth(transaction_ts) % 3 = 0 GROUP BY 1, 2""",
    ("silver",),
)
cte(
    "snap_m",
    """SELECT merchant_id, date_trunc('day', transaction_ts) + INTERVAL 1 DAY AS at, count(*) AS tx_count_1d,
  avg(cast(is_fraud AS double)) AS fraud_rate_30d FROM silver WHERE dayofmonth(transaction_ts) % 9 = 0 GROUP BY 1, 2""",
    ("silver",),
)


def _snapshots(spark, sf, entity: str, every: int):
    df = silver(spark, sf).filter(F.dayofmonth("transaction_ts") % every == 0)
    day = F.date_trunc("day", "transaction_ts") + F.expr("INTERVAL 1 DAY")
    return df.groupBy(entity, day.alias("feature_date")).agg(
        F.count(F.lit(1)).alias("tx_count_1d"), F.avg(F.col("is_fraud").cast("double")).alias("fraud_rate_30d")
    )


def _spine(df):
    """Labelled transactions, to be looked up an hour later."""
    later = (F.col("transaction_ts") + F.expr("INTERVAL 1 HOUR")).alias("event_ts")
    return df.filter(F.col("is_fraud").isNotNull()).select("transaction_id", "customer_id", "merchant_id", "is_fraud", later)


_HIST = store.FeatureService(
    "history",
    {
        "customer_features": ["tx_count_1d", "fraud_rate_30d"],
        "merchant_features": ["tx_count_1d", "fraud_rate_30d"],
        "transaction_features": ["amount_log1p", "hour_of_day"],
    },
)
_HIST_NAMES = store.output_names(_HIST)
_CNAMES, _MNAMES = _HIST_NAMES["customer_features"], _HIST_NAMES["merchant_features"]


def _ttl(alias: str, column: str, seconds: int) -> str:
    return f"CASE WHEN epoch_us(s.event_ts) - epoch_us({alias}.at) <= {seconds}000000 THEN {alias}.{column} END"


@query(
    "historical_features",
    sql(
        f"""SELECT s.transaction_id, s.is_fraud,
  {_ttl('c', 'tx_count_1d', 604800)} AS {_CNAMES['tx_count_1d']},
  {rs(_ttl('c', 'fraud_rate_30d', 604800))} AS {_CNAMES['fraud_rate_30d']},
  {_ttl('m', 'tx_count_1d', 604800)} AS {_MNAMES['tx_count_1d']},
  {rs(_ttl('m', 'fraud_rate_30d', 604800))} AS {_MNAMES['fraud_rate_30d']},
  {rs('ln(1 + amount_usd)')} AS amount_log1p, cast(hour(s.transaction_ts) AS integer) AS hour_of_day
  FROM (SELECT *, transaction_ts + INTERVAL 1 HOUR AS event_ts FROM silver WHERE is_fraud IS NOT NULL) s
  ASOF LEFT JOIN snap_c c ON s.customer_id = c.customer_id AND s.event_ts >= c.at
  ASOF LEFT JOIN snap_m m ON s.merchant_id = m.merchant_id AND s.event_ts >= m.at""",
        "silver",
        "snap_c",
        "snap_m",
    ),
)
def _(spark, sf):
    df = silver(spark, sf)
    spine = _spine(df)
    tables = {
        "customer_features": _snapshots(spark, sf, "customer_id", 3),
        "merchant_features": _snapshots(spark, sf, "merchant_id", 9),
        "transaction_features": gold.stream_transforms(df),
    }
    out = store.historical_features(spine, _HIST, tables, row_id="transaction_id")
    rates = [_CNAMES["fraud_rate_30d"], _MNAMES["fraud_rate_30d"], "amount_log1p"]
    return rounded(out, *rates).drop("customer_id", "merchant_id", "event_ts")


def _daily(df, key: str, rolled, view: store.FeatureView):
    """A feature table that grows by a row per entity and day: its last event's values, known from the next day."""
    day = F.date_trunc("day", "transaction_ts")
    rows = rolled.select(key, "transaction_ts", F.col("transaction_id").cast("long").alias("_e"), day.alias("_day"), *view.columns)
    newest = F.max_by(F.struct(*view.columns), F.struct("transaction_ts", "_e"))
    days = rows.groupBy(key, "_day").agg(newest.alias("_newest"))
    return days.select(key, (F.col("_day") + F.expr("INTERVAL 1 DAY")).alias("feature_date"), "_newest.*")


_TRAIN_NAMES = store.output_names(store.TRAINING_SERVICE)


def _train_sql(view: str, alias: str, ttl: int) -> str:
    whole = {"amount_bucket", *[f.name for f in store.VIEWS[view].features if f.dataType.simpleString() in ("int", "bigint")]}
    out = []
    for c in store.VIEWS[view].columns:
        value = _ttl(alias, c, ttl)
        out.append(f"{value if c in whole else rs(value)} AS {_TRAIN_NAMES[view][c]}")
    return ", ".join(out)


for _key, _roll in (("customer_id", "customer_roll"), ("merchant_id", "merchant_roll")):
    cte(
        f"daily_{_key}",
        f"""SELECT *, date_trunc('day', transaction_ts) + INTERVAL 1 DAY AS at FROM {_roll} WHERE {_key} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {_key}, date_trunc('day', transaction_ts) ORDER BY transaction_ts DESC, event_id DESC) = 1""",
        (_roll,),
    )


@query(
    "training_service_features",
    sql(
        f"""SELECT s.transaction_id, s.is_fraud, {_train_sql('customer_features', 'c', 7 * 86400)},
  {_train_sql('merchant_features', 'm', 7 * 86400)}, {_train_sql('transaction_features', 't', 86400)}
  FROM (SELECT *, transaction_ts + INTERVAL 1 HOUR AS event_ts FROM silver WHERE is_fraud IS NOT NULL) s
  ASOF LEFT JOIN daily_customer_id c ON s.customer_id = c.customer_id AND s.event_ts >= c.at
  ASOF LEFT JOIN daily_merchant_id m ON s.merchant_id = m.merchant_id AND s.event_ts >= m.at
  LEFT JOIN (SELECT *, transaction_ts AS at FROM tx_feat) t ON s.transaction_id = t.transaction_id""",
        "silver",
        "daily_customer_id",
        "daily_merchant_id",
        "tx_feat",
    ),
)
def _(spark, sf):
    """All 32 columns of the training service, from feature tables with a row per entity and day."""
    df = silver(spark, sf)
    profile = gold.with_time_profile(df)
    customers = rolling(profile, "customer_id", "transaction_ts", gold.CUSTOMER_ROLLING)
    merchants = rolling(df, "merchant_id", "transaction_ts", gold.MERCHANT_ROLLING)
    tables = {
        "customer_features": _daily(df, "customer_id", customers, store.CUSTOMER_VIEW),
        "merchant_features": _daily(df, "merchant_id", merchants, store.MERCHANT_VIEW),
        "transaction_features": gold.transaction_features(df, as_of()),
    }
    out = store.historical_features(_spine(df), store.TRAINING_SERVICE, tables, row_id="transaction_id")
    real = [
        _TRAIN_NAMES[v.name][f.name]
        for v in store.VIEWS.values()
        for f in v.features
        if f.dataType.simpleString() == "double"
    ]
    return rounded(out, *real).drop("customer_id", "merchant_id", "event_ts")


# --- latest-value tables ----------------------------------------------------------------

NOW = "2024-02-01 00:00:00"
_LATEST_VIEW = store.FeatureView(
    "latest_events", "customer_id", "transaction_ts", 2 * 86400, store.CUSTOMER_VIEW.features
)
cte(
    "latest",
    """SELECT customer_id, arg_max(transaction_ts, (transaction_ts, event_id)) AS transaction_ts,
  arg_max(transaction_id, (transaction_ts, event_id)) AS transaction_id,
  arg_max(amount_usd, (transaction_ts, event_id)) AS amount_usd FROM silver GROUP BY customer_id""",
    ("silver",),
)


def _event_rows(spark, sf):
    df = silver(spark, sf)
    return df.select(
        "customer_id", "transaction_ts", "transaction_id", "amount_usd", F.col("transaction_id").cast("long").alias("_e")
    )


_LATEST_SQL = f"SELECT customer_id, transaction_id, amount_usd, {text_ts_sql('transaction_ts')} AS transaction_ts FROM latest"


@query("materialize_latest", sql(_LATEST_SQL, "latest"))
def _(spark, sf):
    df = store.latest_rows(_event_rows(spark, sf), "customer_id", "transaction_ts", ["_e"])
    return df.select("customer_id", "transaction_id", "amount_usd", text_ts("transaction_ts").alias("transaction_ts"))


@query("materialize_incremental", sql(_LATEST_SQL, "latest"))
def _(spark, sf):
    """Three runs, one of them repeated, end where one full run does."""
    rows = _event_rows(spark, sf)
    at = [F.lit(day).cast("timestamp") for day in ("2024-01-10", "2024-01-20", NOW)]
    runs = [(None, at[0]), (at[0], at[1]), (at[0], at[1]), (at[1], at[2])]
    path = shared_dir(spark, "online")
    for start, end in runs:
        out = shared_dir(spark, "online")
        store.materialize(spark, _LATEST_VIEW, rows, path, out, start, end, ["_e"])
        path = out
    df = spark.read.parquet(path)
    return df.select("customer_id", "transaction_id", "amount_usd", text_ts("transaction_ts").alias("transaction_ts"))


@query(
    "materialize_freshness",
    sql(
        """SELECT d AS run, cast(epoch(d) AS double) AS end_epoch_s,
  (SELECT epoch(d) - epoch_us(max(transaction_ts)) / 1000000.0 FROM silver WHERE transaction_ts <= d) AS freshness_s,
  'met' AS status, (SELECT count(DISTINCT customer_id) FROM silver WHERE transaction_ts <= timestamp '2024-02-01') AS n_keys
  FROM (VALUES (timestamp '2024-01-10'), (timestamp '2024-01-20'), (timestamp '2024-02-01')) t (d)""".replace(
            "SELECT d AS run", f"SELECT {text_ts_sql('d')} AS run"
        ),
        "silver",
    ),
)
def _(spark, sf):
    """Runs that find their start in the metrics of the run before."""
    rows = _event_rows(spark, sf)
    path, metrics = shared_dir(spark, "online"), shared_dir(spark, "metrics")
    for day in ((1, 10), (1, 20), (2, 1)):
        out = shared_dir(spark, "online")
        store.materialize_due(spark, _LATEST_VIEW, rows, path, out, metrics, datetime(2024, *day), 3600.0, ["_e"])
        path = out
    n = spark.read.parquet(path).count()
    seen = metric_status(read_metrics(spark, metrics, "materialize latest_events"))
    pick = lambda name, column: F.max(F.when(F.col("metric") == name, F.col(column))).alias(column)
    wide = seen.groupBy("recorded_at").agg(
        F.max(F.when(F.col("metric") == "end_epoch_s", F.col("measured"))).alias("end_epoch_s"),
        F.max(F.when(F.col("metric") == "freshness_s", F.col("measured"))).alias("freshness_s"),
        pick("seconds", "status"),
    )
    return wide.select(
        text_ts("recorded_at").alias("run"), "end_epoch_s", "freshness_s", "status", F.lit(n).cast("long").alias("n_keys")
    )


@query(
    "online_lookup",
    sql(
        """SELECT c_custkey AS request_id, CASE WHEN epoch_us(timestamp '2024-01-31 06:00:00') - epoch_us(transaction_ts)
  BETWEEN 0 AND 172800000000 THEN amount_usd END AS amount_usd, CASE WHEN epoch_us(timestamp '2024-01-31 06:00:00')
  - epoch_us(transaction_ts) BETWEEN 0 AND 172800000000 THEN transaction_id END AS transaction_id
  FROM customer LEFT JOIN latest ON cast(c_custkey AS varchar) = customer_id""",
        "latest",
    ),
)
def _(spark, sf):
    online = store.latest_rows(_event_rows(spark, sf), "customer_id", "transaction_ts", ["_e"])
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("request_id"), F.col("c_custkey").cast("string").alias("customer_id")
    )
    now = F.lit("2024-01-31 06:00:00").cast("timestamp")
    out = store.online_lookup(requests, online, _LATEST_VIEW, now, ["amount_usd", "transaction_id"])
    return out.drop("customer_id")


# --- feature services ----------------------------------------------------------------------


def _tables(spark, sf):
    df = silver(spark, sf)
    return {
        "customer_features": gold.customer_features(df, as_of()),
        "merchant_features": gold.merchant_features(df, as_of()),
        "transaction_features": gold.transaction_features(df, as_of()),
    }


_SERVE_C = store.SERVING_SERVICE.columns["customer_features"]
_SERVE_M = store.SERVING_SERVICE.columns["merchant_features"]
_SERVE_T = store.SERVING_SERVICE.columns["transaction_features"]


def _long_sql(view: str, key: str, columns, source: str) -> str:
    arms = [
        f"SELECT '{view}' AS view, {key} AS entity, '{c}' AS feature, {rs(f'cast({c} AS double)', 4)} AS value FROM {source}"
        for c in columns
    ]
    return " UNION ALL ".join(arms)


@query(
    "serving_projection",
    sql(
        " UNION ALL ".join(
            [
                _long_sql("customer_features", "customer_id", _SERVE_C, "customer_feat"),
                _long_sql("merchant_features", "merchant_id", _SERVE_M, "merchant_feat"),
                _long_sql("transaction_features", "transaction_id", _SERVE_T, "tx_feat"),
            ]
        ),
        "customer_feat",
        "merchant_feat",
        "tx_feat",
    ),
)
def _(spark, sf):
    parts = []
    for name, df in store.serving_projection(_tables(spark, sf), store.SERVING_SERVICE).items():
        view = store.VIEWS[name]
        columns = list(store.SERVING_SERVICE.columns[name])
        wide = df.select(F.col(view.key).alias("entity"), *[F.col(c).cast("double").alias(c) for c in columns])
        long = wide.unpivot(["entity"], columns, "feature", "value")
        parts.append(long.select(F.lit(name).alias("view"), "entity", "feature", "value"))
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), "value", digits=4)


_CHECKED = {
    "customer_features": ([*CUSTOMER_COUNTS, *CUSTOMER_LATEST], "customer_feat"),
    "merchant_features": (["tx_count_1d", "tx_count_7d", *MERCHANT_LATEST], "merchant_feat"),
    "transaction_features": (store.TRANSACTION_VIEW.columns, "tx_feat"),
}


@query(
    "view_schema_check",
    sql(
        " UNION ALL ".join(
            f"SELECT '{view}' AS view, '{c}' AS feature, true AS ok, count({c}) AS filled FROM {source}"
            for view, (columns, source) in _CHECKED.items()
            for c in columns
        ),
        "customer_feat",
        "merchant_feat",
        "tx_feat",
    ),
)
def _(spark, sf):
    """Every feature of every view: declared type found, and how many rows fill it."""
    tables = _tables(spark, sf)
    checks = store.view_schema_check(spark, tables).select("view", "feature", "ok")
    filled = []
    for name, df in tables.items():
        columns = store.VIEWS[name].columns
        one = df.agg(*[F.count(c).alias(c) for c in columns])
        filled.append(one.unpivot([], columns, "feature", "filled").withColumn("view", F.lit(name)))
    counts = filled[0].unionByName(filled[1]).unionByName(filled[2])
    return checks.join(counts, ["view", "feature"])


