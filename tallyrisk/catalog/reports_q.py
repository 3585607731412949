"""Report, ranking and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrisk.catalog.inputs import cards, scored, silver, table, transfers
from tallyrisk.catalog.registry import cte, query, r, rounded, rs, sql, text_ts, text_ts_sql
from tallyrisk.operators import ordering, ranking, reports, sampling
from tallyrisk.plans.gold import batch_transforms, fraud_labels, model_inputs
from tallyrisk.plans.scoring import batch_summary

EXACT = None


@query(
    "label_summary",
    sql(
        f"""SELECT count(*) AS total, count(*) FILTER (is_fraud = 1) AS fraud_count,
  {rs('count(*) FILTER (is_fraud = 1) / greatest(count(*), 1)')} AS fraud_rate FROM silver WHERE is_fraud IS NOT NULL""",
        "silver",
    ),
)
def _(spark, sf):
    labels = fraud_labels(silver(spark, sf), F.lit("2024-02-01").cast("timestamp"))
    return rounded(reports.label_summary(labels), "fraud_rate")


@query(
    "class_balance",
    sql(
        f"""SELECT is_fraud, count(*) AS n, {rs('count(*) / (SELECT count(*) FROM silver)')} AS share
  FROM silver GROUP BY is_fraud""",
        "silver",
    ),
)
def _(spark, sf):
    return rounded(reports.class_balance(silver(spark, sf)), "share")


@query(
    "rate_by_hour",
    sql(
        f"""SELECT cast(hour(transaction_ts) AS integer) AS hour, {rs('avg(cast(is_fraud AS double))')} AS rate
  FROM silver GROUP BY 1""",
        "silver",
    ),
)
def _(spark, sf):
    return rounded(reports.rate_by(silver(spark, sf), F.hour("transaction_ts"), "hour"), "rate")


@query(
    "rate_by_dow",
    sql(
        f"""SELECT cast(dayofweek(transaction_ts) + 1 AS integer) AS dow, {rs('avg(cast(is_fraud AS double))')} AS rate
  FROM silver GROUP BY 1""",
        "silver",
    ),
)
def _(spark, sf):
    return rounded(reports.rate_by(silver(spark, sf), F.dayofweek("transaction_ts"), "dow"), "rate")


@query(
    "rate_by_type",
    sql(f"""SELECT type, {rs('avg(cast("isFraud" AS double))')} AS rate FROM transfers GROUP BY type""", "transfers"),
)
def _(spark, sf):
    return rounded(reports.rate_by(transfers(spark, sf), F.col("type"), "type", "isFraud"), "rate")


@query(
    "peak_hour",
    sql(
        f"""SELECT hour, {rs('rate')} AS rate FROM (SELECT cast(hour(transaction_ts) AS integer) AS hour,
  avg(cast(is_fraud AS double)) AS rate FROM silver GROUP BY 1) ORDER BY rate DESC, hour LIMIT 1""",
        "silver",
    ),
)
def _(spark, sf):
    rates = reports.rate_by(silver(spark, sf), F.hour("transaction_ts"), "hour")
    return rounded(reports.peak(rates, "hour"), "rate")


@query("value_counts", sql("SELECT type, count(*) AS n FROM transfers GROUP BY type", "transfers"))
def _(spark, sf):
    return reports.value_counts(transfers(spark, sf), "type")


@query(
    "time_range",
    f"SELECT {text_ts_sql('min(ts)')} AS first_ts, {text_ts_sql('max(ts)')} AS last_ts FROM events",
)
def _(spark, sf):
    df = reports.time_range(silver(spark, sf))
    return df.select(text_ts("first_ts").alias("first_ts"), text_ts("last_ts").alias("last_ts"))


def data_bins_sql(value: str, bins: int, source: str) -> str:
    """Bins over the range of the values themselves."""
    return sql(
        f"""SELECT is_fraud, cast(greatest(least(floor((v - lo) / (hi - lo) * {bins}) + 1, {bins}), 1) AS bigint) AS bin,
  count(*) AS n FROM (SELECT is_fraud, {value} AS v, min({value}) OVER () AS lo, max({value}) OVER () AS hi FROM {source})
  GROUP BY 1, 2""",
        source,
    )


def bins_sql(value: str, lo: float, hi: float, bins: int, source: str) -> str:
    width = f"({hi} - {lo})"
    at = f"""cast(CASE WHEN v < {lo} THEN 0 WHEN v >= {hi} THEN {bins}
  ELSE least(floor({bins} * (v - {lo}) / {width}) + 1, {bins}) END AS bigint)"""
    return sql(
        f"SELECT is_fraud, {at} AS bin, count(*) AS n FROM (SELECT is_fraud, {value} AS v FROM {source}) GROUP BY 1, 2",
        source,
    )


@query("amount_histogram", data_bins_sql("ln(1 + amount_usd)", 50, "silver"))
def _(spark, sf):
    return reports.histogram(silver(spark, sf), F.log(F.lit(1) + F.col("amount_usd")), "is_fraud", 50)


@query("score_histogram_80", bins_sql("score", 0.0, 1.0, 80, "scored"))
def _(spark, sf):
    return reports.histogram(scored(spark, sf), F.col("score"), "is_fraud", 80, 0.0, 1.0)


@query("score_histogram_50", bins_sql("score", 0.0, 1.0, 50, "scored"))
def _(spark, sf):
    return reports.histogram(scored(spark, sf), F.col("score"), "is_fraud", 50, 0.0, 1.0)


# Request latencies in seconds, some beyond the last bound.
_LATENCY = "(event_id * 31 % 7001) / 1000.0"
cte("latencies", f"SELECT event_type, {_LATENCY} AS seconds FROM events")


def _latencies(spark, sf):
    seconds = (F.col("event_id") * 31 % 7001).cast("double") / 1000.0
    return table(spark, sf, "events").select("event_type", seconds.alias("seconds"))


def le_sql(source: str, value: str, bounds) -> str:
    arms = [
        f"SELECT cast({b} AS double) AS le, count(*) FILTER ({value} <= {b}) AS n FROM {source}" for b in bounds
    ]
    arms.append(f"SELECT cast('inf' AS double), count({value}) FROM {source}")
    return " UNION ALL ".join(arms)


cte("score_le", le_sql("scored", "score", reports.SCORE_BOUNDS), ("scored",))
cte("latency_le", le_sql("latencies", "seconds", reports.LATENCY_BOUNDS), ("latencies",))
_LE_TEXT = "CASE WHEN isinf(le) THEN 'inf' ELSE cast(le AS varchar) END AS le"


def _le_text(df):
    inf = F.col("le") == F.lit(float("inf"))
    return df.withColumn("le", F.when(inf, "inf").otherwise(F.col("le").cast("string")))


@query("score_buckets", sql(f"SELECT {_LE_TEXT}, n FROM score_le", "score_le"))
def _(spark, sf):
    return _le_text(reports.le_buckets(scored(spark, sf), "score", reports.SCORE_BOUNDS))


@query("latency_buckets", sql(f"SELECT {_LE_TEXT}, n FROM latency_le", "latency_le"))
def _(spark, sf):
    return _le_text(reports.le_buckets(_latencies(spark, sf), "seconds", reports.LATENCY_BOUNDS))


def quantile_sql(q: float) -> str:
    return f"""SELECT {q} AS q, CASE WHEN isinf(le) THEN lower ELSE lower + (le - lower) * ({q} * total - below)
  / (n - below) END AS quantile FROM (SELECT le, n, coalesce(lag(le) OVER (ORDER BY le), 0) AS lower,
  coalesce(lag(n) OVER (ORDER BY le), 0) AS below, max(n) OVER () AS total FROM latency_le)
  WHERE n >= {q} * total ORDER BY le LIMIT 1"""


@query(
    "bucket_quantile",
    sql(
        f"""SELECT cast(q AS double) AS q, {rs('quantile')} AS quantile
  FROM (({quantile_sql(0.5)}) UNION ALL ({quantile_sql(0.95)}))""",
        "latency_le",
    ),
)
def _(spark, sf):
    buckets = reports.le_buckets(_latencies(spark, sf), "seconds", reports.LATENCY_BOUNDS)
    parts = [
        reports.bucket_quantile(buckets, q).select(F.lit(q).alias("q"), r("quantile").alias("quantile"))
        for q in (0.5, 0.95)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "alert_counts",
    sql(
        """SELECT merchant_id, is_night, count(*) AS requests, count(*) FILTER (score > 0.5) AS alerts
  FROM scored GROUP BY 1, 2""",
        "scored",
    ),
)
def _(spark, sf):
    return reports.alert_counts(scored(spark, sf), ["merchant_id", "is_night"])


@query(
    "batch_summary",
    sql("SELECT count(*) AS results, count(*) FILTER (score > 0.5) AS fraud_count FROM scored", "scored"),
)
def _(spark, sf):
    return batch_summary(scored(spark, sf))


@query(
    "windowed_rate",
    f"""SELECT {text_ts_sql("date_trunc('minute', ts)")} AS window_start, count(*) AS n,
  {rs('count(*) / 60.0')} AS per_second, count(*) FILTER (event_type = 'error') AS failed,
  {rs("count(*) FILTER (event_type = 'error') / 60.0")} AS failed_per_second FROM events GROUP BY 1""",
)
def _(spark, sf):
    df = reports.windowed_rate(
        silver(spark, sf), "transaction_ts", "1 minute", failed=F.col("merchant_id") == "error"
    )
    return rounded(df, "per_second", "failed_per_second").withColumn("window_start", text_ts("window_start"))


PROFILE_COLS = ["TransactionAmt", "C1", "D1", "V1", "V2"]


@query(
    "feature_profile",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, {rs(f'avg("{c}")')} AS mean, {rs(f'stddev("{c}")', 4)} AS std,
  quantile_disc("{c}", 0.5) AS p50 FROM cards"""
            for c in PROFILE_COLS
        ),
        "cards",
    ),
)
def _(spark, sf):
    df = reports.feature_profile(cards(spark, sf), PROFILE_COLS, EXACT)
    return rounded(rounded(df, "mean"), "std", digits=4)


# The serving side lacks the last half day, as a table refreshed at noon would.
SKEW_COLS = ["amount_log1p", "amount_zscore", "amount_vs_mean_ratio", "fraud_rate_30d"]
cte(
    "skew",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, (SELECT avg({c}) FROM scored) AS offline_mean, (SELECT avg({c}) FROM scored
  WHERE transaction_ts < timestamp '2024-01-30 12:00:00') AS online_mean"""
        for c in SKEW_COLS
    ),
    ("scored",),
)
cte(
    "skew_rows",
    """SELECT *, CASE WHEN abs(offline_mean) > 1e-10
  THEN abs(online_mean - offline_mean) / abs(offline_mean) * 100 ELSE 0 END AS pct FROM skew""",
    ("skew",),
)


def _skew(spark, sf):
    df = scored(spark, sf)
    online = df.filter(F.col("transaction_ts") < F.lit("2024-01-30 12:00:00").cast("timestamp"))
    return reports.skew_report(df, online, SKEW_COLS)


@query(
    "skew_report",
    sql(
        """SELECT feature, round(offline_mean, 6) AS offline_mean, round(online_mean, 6) AS online_mean,
  round(pct, 4) AS skew_pct, CASE WHEN pct < 1 THEN 'PASS' ELSE 'FAIL' END AS status FROM skew_rows""",
        "skew_rows",
    ),
)
def _(spark, sf):
    return _skew(spark, sf)


@query(
    "skew_summary",
    sql(
        """SELECT max(round(pct, 4)) AS max_skew_pct,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (pct >= 1), '') AS failing FROM skew_rows""",
        "skew_rows",
    ),
)
def _(spark, sf):
    return reports.skew_summary(_skew(spark, sf))


BATCH_SKEW = ["amount_log1p", "customer_tx_count_24h"]


@query(
    "batch_path_skew",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, cast(0 AS double) AS skew_pct, 'PASS' AS status WHERE (SELECT count(*) FROM silver) > 0"
            for c in BATCH_SKEW
        ),
        "silver",
    ),
)
def _(spark, sf):
    """The two code paths that make these features agree."""
    df = silver(spark, sf)
    report = reports.skew_report(batch_transforms(df), model_inputs(df), BATCH_SKEW)
    return report.select("feature", "skew_pct", "status")


# --- percentiles and ranking -------------------------------------------------------

_MS = "cast((event_id * 37 % 5003) + CASE WHEN event_id % 3 = 0 THEN 0 ELSE 250 END AS bigint)"


def pick_sql(q: float) -> str:
    return f"""(SELECT ms FROM latency_ms WHERE ms IS NOT NULL ORDER BY ms LIMIT 1
  OFFSET (SELECT cast(floor(count(ms) * {q}) AS bigint) FROM latency_ms))"""


cte("latency_ms", f"SELECT CASE WHEN event_id % 17 <> 0 THEN {_MS} END AS ms FROM events")


@query(
    "latency_percentiles",
    sql(
        f"""SELECT {pick_sql(0.5)} AS p50, {pick_sql(0.95)} AS p95, {pick_sql(0.99)} AS p99, count(ms) AS n,
  {pick_sql(0.95)} < 2000 AS target_met FROM latency_ms""",
        "latency_ms",
    ),
)
def _(spark, sf):
    e = F.col("event_id")
    ms = e * 37 % 5003 + F.when(e % 3 == 0, 0).otherwise(250)
    df = table(spark, sf, "events").select(F.when(e % 17 != 0, ms).alias("ms"))
    out = ordering.floor_percentiles(df, "ms", [0.5, 0.95, 0.99])
    return out.withColumn("target_met", F.col("p95") < 2000)


cte(
    "labelled",
    "SELECT score, is_fraud = 1 AS pos FROM scored WHERE is_fraud IS NOT NULL",
    ("scored",),
)
cte(
    "curve",
    """SELECT score, sum(p) OVER w AS tp, sum(q) OVER w AS fp, p, q, sum(p) OVER () AS np, sum(q) OVER () AS nn
  FROM (SELECT score, count(*) FILTER (pos) AS p, count(*) FILTER (NOT pos) AS q FROM labelled GROUP BY score)
  WINDOW w AS (ORDER BY score DESC)""",
    ("labelled",),
)


@query("roc_auc", sql(f"SELECT {rs('sum(q * (tp - p / 2.0)) / (max(np) * max(nn))')} AS roc_auc FROM curve", "curve"))
def _(spark, sf):
    return rounded(ranking.roc_auc(scored(spark, sf)), "roc_auc")


@query(
    "average_precision",
    sql(f"SELECT {rs('sum(p * tp / (tp + fp)) / max(np)')} AS average_precision FROM curve", "curve"),
)
def _(spark, sf):
    return rounded(ranking.average_precision(scored(spark, sf)), "average_precision")


@query(
    "roc_points",
    sql(f"SELECT {rs('score')} AS threshold, {rs('fp / nn')} AS fpr, {rs('tp / np')} AS tpr FROM curve", "curve"),
)
def _(spark, sf):
    return rounded(ranking.roc_points(scored(spark, sf)), "threshold", "fpr", "tpr")


@query(
    "pr_points",
    sql(
        f"""SELECT {rs('score')} AS threshold, {rs('tp / (tp + fp)')} AS "precision", {rs('tp / np')} AS recall
  FROM curve""",
        "curve",
    ),
)
def _(spark, sf):
    return rounded(ranking.pr_points(scored(spark, sf)), "threshold", "precision", "recall")


@query(
    "threshold_report",
    sql(
        f"""SELECT t AS threshold, tp, fp, fn, {rs('tp / (tp + fp)')} AS "precision", {rs('tp / (tp + fn)')} AS recall
  FROM (SELECT t, count(*) FILTER (score >= t AND pos) AS tp, count(*) FILTER (score >= t AND NOT pos) AS fp,
  count(*) FILTER (score < t AND pos) AS fn FROM labelled, (VALUES (0.3::double), (0.5::double)) v(t) GROUP BY t)""",
        "labelled",
    ),
)
def _(spark, sf):
    return rounded(ranking.threshold_report(scored(spark, sf)), "precision", "recall")


@query(
    "class_weight",
    sql(
        f"""SELECT {rs('count(*) FILTER (is_fraud = 0) / count(*) FILTER (is_fraud = 1)')} AS positive_weight
  FROM silver""",
        "silver",
    ),
)
def _(spark, sf):
    return rounded(ranking.class_weight(silver(spark, sf)), "positive_weight")


cte(
    "flagged",
    """SELECT *, cast(row_number() OVER (ORDER BY score DESC, md5(transaction_id), transaction_id)
  <= greatest(1, floor(0.01 * count(*) OVER ())) AS integer) AS anomaly_label FROM scored""",
    ("scored",),
)


def _flagged(spark, sf):
    return ordering.top_fraction_flag(scored(spark, sf), "score", "transaction_id")


@query("anomaly_label", sql("SELECT transaction_id, anomaly_label, is_fraud FROM flagged", "flagged"))
def _(spark, sf):
    return _flagged(spark, sf).select("transaction_id", "anomaly_label", "is_fraud")


@query(
    "anomaly_label_ties",
    sql(
        """SELECT transaction_id, cast(row_number() OVER (ORDER BY coarse DESC, md5(transaction_id), transaction_id)
  <= greatest(1, floor(0.03 * count(*) OVER ())) AS integer) AS anomaly_label
  FROM (SELECT transaction_id, floor(score * 4) AS coarse FROM scored)""",
        "scored",
    ),
)
def _(spark, sf):
    """A quarter of all rows share the border score."""
    df = scored(spark, sf).withColumn("coarse", F.floor(F.col("score") * 4))
    out = ordering.top_fraction_flag(df, "coarse", "transaction_id", 0.03)
    return out.select("transaction_id", "anomaly_label")


@query(
    "top_pct_overlap",
    sql(
        f"""SELECT n_samples, n_anomalies, {rs('n_anomalies / n_samples')} AS anomaly_rate,
  {rs('hits / n_anomalies')} AS anomaly_fraud_overlap, {rs('hits / n_anomalies')} AS precision_at_top1pct,
  {rs('hits / pos')} AS fraud_recall_at_1pct FROM (SELECT count(*) AS n_samples,
  count(*) FILTER (anomaly_label = 1) AS n_anomalies, count(*) FILTER (is_fraud = 1) AS pos,
  count(*) FILTER (anomaly_label = 1 AND is_fraud = 1) AS hits FROM flagged)""",
        "flagged",
    ),
)
def _(spark, sf):
    shares = ["anomaly_rate", "anomaly_fraud_overlap", "precision_at_top1pct", "fraud_recall_at_1pct"]
    return rounded(ranking.overlap_metrics(_flagged(spark, sf)), *shares)


@query(
    "confusion_counts",
    sql(
        """SELECT count(*) FILTER (anomaly_label = 1 AND is_fraud = 1) AS caught,
  count(*) FILTER (anomaly_label = 0 AND is_fraud = 1) AS missed,
  count(*) FILTER (anomaly_label = 1 AND is_fraud = 0) AS false_positive FROM flagged""",
        "flagged",
    ),
)
def _(spark, sf):
    return ranking.confusion_counts(_flagged(spark, sf))


# --- samples, splits, top-k ----------------------------------------------------------


@query(
    "top_amount_legit",
    sql(
        """SELECT transaction_id, amount_usd FROM silver WHERE is_fraud = 0
  ORDER BY amount_usd DESC, transaction_id LIMIT 200""",
        "silver",
    ),
)
def _(spark, sf):
    df = silver(spark, sf).filter(F.col("is_fraud") == 0)
    return sampling.top_k(df, F.col("amount_usd").desc(), "transaction_id", k=200).select(
        "transaction_id", "amount_usd"
    )


@query(
    "fraud_sample",
    sql("SELECT transaction_id, amount_usd FROM silver WHERE is_fraud = 1 ORDER BY transaction_id LIMIT 200", "silver"),
)
def _(spark, sf):
    df = silver(spark, sf).filter(F.col("is_fraud") == 1)
    return sampling.top_k(df, "transaction_id", k=200).select("transaction_id", "amount_usd")


@query(
    "balanced_sample",
    sql(
        """SELECT transaction_id, is_fraud FROM silver WHERE is_fraud = 1 UNION ALL SELECT transaction_id, is_fraud
  FROM silver WHERE is_fraud = 0 QUALIFY row_number() OVER (ORDER BY md5('42' || transaction_id), transaction_id)
  <= 5 * (SELECT count(*) FROM silver WHERE is_fraud = 1)""",
        "silver",
    ),
)
def _(spark, sf):
    return sampling.balanced_sample(silver(spark, sf)).select("transaction_id", "is_fraud")


cte(
    "split",
    """SELECT transaction_id, is_fraud, CASE WHEN row_number() OVER (PARTITION BY is_fraud
  ORDER BY md5('42' || transaction_id), transaction_id) <= floor(count(*) OVER (PARTITION BY is_fraud) * 0.2 + 0.5)
  THEN 'test' ELSE 'train' END AS split FROM silver WHERE is_fraud IS NOT NULL""",
    ("silver",),
)


@query("stratified_split", sql("SELECT * FROM split", "split"))
def _(spark, sf):
    labelled = silver(spark, sf).filter(F.col("is_fraud").isNotNull())
    return sampling.stratified_split(labelled).select("transaction_id", "is_fraud", "split")
