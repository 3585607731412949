"""Feature queries: windows, entity tables, transaction features, model input."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrisk.catalog.inputs import as_of, scored, silver, table
from tallyrisk.catalog.registry import cte, query, r, rounded, rs, sql, text_ts, text_ts_sql
from tallyrisk.functions.events import amount_features, amount_zscore_given, temporal_features, velocity_spike
from tallyrisk.operators.cleaning import new_pair_flag, ratio_to_entity_mean
from tallyrisk.operators.reports import amount_stats, amount_zscore
from tallyrisk.operators.rolling import DAY_S, HOUR_S, Rolling, rolling, velocity
from tallyrisk.operators.sketches import distinct_by_slices
from tallyrisk.plans import gold
from tallyrisk.plans.training import training_set
from tallyrisk.schemas import MODEL_FEATURES


def frame(name: str, entity: str, seconds: int, current: bool = True) -> str:
    end = "CURRENT ROW" if current else "1 PRECEDING"
    return f"{name} AS (PARTITION BY {entity} ORDER BY s RANGE BETWEEN {seconds} PRECEDING AND {end})"


@query(
    "temporal_features",
    sql(
        """SELECT transaction_id, cast(hour(transaction_ts) AS integer) AS hour_of_day,
  cast(dayofweek(transaction_ts) + 1 AS integer) AS day_of_week,
  CASE WHEN dayofweek(transaction_ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour(transaction_ts) >= 22 OR hour(transaction_ts) < 6 THEN 1 ELSE 0 END AS is_night FROM silver""",
        "silver",
    ),
)
def _(spark, sf):
    return temporal_features(silver(spark, sf)).select(
        "transaction_id", "hour_of_day", "day_of_week", "is_weekend", "is_night"
    )


AMOUNT_SQL = """{log1p} AS amount_log1p,
  CASE WHEN {a} <= 10 THEN '0-10' WHEN {a} <= 100 THEN '10-100' WHEN {a} <= 1000 THEN '100-1000' ELSE '1000+' END
    AS amount_bucket, cast({a} % 100 = 0 AS integer) AS is_round_amount"""


@query(
    "amount_features",
    sql(
        "SELECT transaction_id, "
        + AMOUNT_SQL.format(a="amount_usd", log1p=rs("ln(1 + greatest(amount_usd, 0))"))
        + " FROM silver",
        "silver",
    ),
)
def _(spark, sf):
    df = amount_features(silver(spark, sf))
    return rounded(df, "amount_log1p").select(
        "transaction_id", "amount_log1p", "amount_bucket", "is_round_amount"
    )


@query(
    "round_amount_flags",
    "SELECT o_orderkey, "
    + AMOUNT_SQL.format(a="a", log1p=rs("ln(1 + greatest(a, 0))"))
    + """ FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1
  THEN -round(o_totalprice) ELSE round(o_totalprice / 50) * 50 END AS a FROM orders)""",
)
def _(spark, sf):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    amount = F.when(key % 10 == 1, -F.round(price)).when(key % 10 != 0, F.round(price / 50) * 50)
    df = table(spark, sf, "orders").select("o_orderkey", amount.alias("a"))
    return rounded(amount_features(df, "a"), "amount_log1p").drop("a")


@query(
    "amount_stats",
    sql(f"SELECT {rs('avg(amount_usd)')} AS mean, {rs('stddev(amount_usd)')} AS std FROM silver", "silver"),
)
def _(spark, sf):
    return rounded(amount_stats(silver(spark, sf)), "mean", "std")


@query(
    "amount_zscore",
    sql(
        f"""SELECT transaction_id, {rs('(amount_usd - (SELECT avg(amount_usd) FROM silver))'
  ' / (SELECT stddev(amount_usd) FROM silver)')} AS amount_zscore FROM silver""",
        "silver",
    ),
)
def _(spark, sf):
    df = amount_zscore(silver(spark, sf))
    return rounded(df.select("transaction_id", "amount_zscore"), "amount_zscore")


@query(
    "amount_zscore_given",
    sql(f"SELECT transaction_id, {rs('(amount_usd - 100) / 250')} AS amount_zscore FROM silver", "silver"),
)
def _(spark, sf):
    df = amount_zscore_given(silver(spark, sf), 100.0, 250.0)
    return rounded(df.select("transaction_id", "amount_zscore"), "amount_zscore")


VELOCITY_SQL = ", ".join(
    f"count(*) OVER w{h} AS customer_tx_count_{h}h, "
    + rs(f"sum(amount_usd) OVER w{h}")
    + f" AS customer_tx_amount_sum_{h}h"
    for h in (1, 6, 24)
)


def velocity_windows(current: bool = True) -> str:
    return "WINDOW " + ", ".join(frame(f"w{h}", "customer_id", h * HOUR_S, current) for h in (1, 6, 24))


SUMS = [f"customer_tx_amount_sum_{h}h" for h in (1, 6, 24)]
COUNTS = [f"customer_tx_count_{h}h" for h in (1, 6, 24)]


@query("velocity", sql(f"SELECT transaction_id, {VELOCITY_SQL} FROM silver {velocity_windows()}", "silver"))
def _(spark, sf):
    return rounded(velocity(silver(spark, sf)), *SUMS).select("transaction_id", *COUNTS, *SUMS)


@query(
    "velocity_exclude_current",
    sql(f"SELECT transaction_id, {VELOCITY_SQL} FROM silver {velocity_windows(False)}", "silver"),
)
def _(spark, sf):
    df = velocity(silver(spark, sf), include_current=False)
    return rounded(df, *SUMS).select("transaction_id", *COUNTS, *SUMS)


DECIMAL_SQL = "(SELECT * REPLACE (cast(amount_usd AS decimal(18, 2)) AS amount_usd) FROM silver)"


@query(
    "velocity_decimal",
    sql(
        f"""SELECT transaction_id, {', '.join(COUNTS)}, {', '.join(f'cast({c} AS double) AS {c}' for c in SUMS)} FROM
  (SELECT transaction_id, {', '.join(f"count(*) OVER w{h} AS customer_tx_count_{h}h, sum(amount_usd) OVER w{h} AS customer_tx_amount_sum_{h}h" for h in (1, 6, 24))}
  FROM {DECIMAL_SQL} {velocity_windows()})""",
        "silver",
    ),
)
def _(spark, sf):
    """Amounts in a decimal type: sums are exact."""
    rows = silver(spark, sf).withColumn("amount_usd", F.col("amount_usd").cast("decimal(18,2)"))
    df = velocity(rows).withColumns({c: F.col(c).cast("double") for c in SUMS})
    return df.select("transaction_id", *COUNTS, *SUMS)


def day_windows(entity: str) -> str:
    return "WINDOW " + ", ".join(frame(f"d{d}", entity, d * DAY_S) for d in (1, 7, 30))


cte(
    "customer_roll",
    f"""SELECT *, count(*) OVER d1 AS tx_count_1d, count(*) OVER d7 AS tx_count_7d, count(*) OVER d30 AS tx_count_30d,
  sum(amount_usd) OVER d1 AS tx_amount_sum_1d, sum(amount_usd) OVER d7 AS tx_amount_sum_7d,
  sum(amount_usd) OVER d30 AS tx_amount_sum_30d, avg(amount_usd) OVER d7 AS tx_amount_mean_7d,
  stddev_samp(amount_usd) OVER d7 AS tx_amount_std_7d, count(DISTINCT merchant_id) OVER d7 AS unique_merchants_7d,
  avg(cast(is_fraud AS double)) OVER d30 AS fraud_rate_30d, avg(hour(transaction_ts)) OVER d7 AS avg_tx_hour_7d,
  avg(CASE WHEN dayofweek(transaction_ts) IN (0, 6) THEN 1 ELSE 0 END) OVER d7 AS weekend_ratio_7d
  FROM silver {day_windows('customer_id')}""",
    ("silver",),
)
cte(
    "merchant_roll",
    f"""SELECT *, count(*) OVER d1 AS tx_count_1d, count(*) OVER d7 AS tx_count_7d,
  cast(sum(is_fraud) OVER d30 AS bigint) AS fraud_count_30d, avg(cast(is_fraud AS double)) OVER d30 AS fraud_rate_30d,
  avg(amount_usd) OVER d7 AS avg_amount_7d, count(DISTINCT customer_id) OVER d7 AS unique_customers_7d
  FROM silver {day_windows('merchant_id')}""",
    ("silver",),
)

CUSTOMER_COUNTS = ["tx_count_1d", "tx_count_7d", "tx_count_30d"]
CUSTOMER_LATEST = [
    "tx_amount_sum_1d",
    "tx_amount_sum_7d",
    "tx_amount_sum_30d",
    "tx_amount_mean_7d",
    "tx_amount_std_7d",
    "unique_merchants_7d",
    "fraud_rate_30d",
    "avg_tx_hour_7d",
    "weekend_ratio_7d",
]
MERCHANT_LATEST = ["fraud_count_30d", "fraud_rate_30d", "avg_amount_7d", "unique_customers_7d"]
_WHOLE = {"unique_merchants_7d", "fraud_count_30d", "unique_customers_7d"}


def latest_sql(columns) -> str:
    return ", ".join(f"arg_max_null({c}, (transaction_ts, event_id)) AS {c}" for c in columns)


cte(
    "customer_feat",
    f"""SELECT customer_id, {', '.join(f'max({c}) AS {c}' for c in CUSTOMER_COUNTS)}, {latest_sql(CUSTOMER_LATEST)}
  FROM customer_roll WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    ("customer_roll",),
)
cte(
    "merchant_feat",
    f"""SELECT merchant_id, max(tx_count_1d) AS tx_count_1d, max(tx_count_7d) AS tx_count_7d, {latest_sql(MERCHANT_LATEST)}
  FROM merchant_roll WHERE merchant_id IS NOT NULL GROUP BY merchant_id""",
    ("merchant_roll",),
)


def shown(columns) -> str:
    return ", ".join(c if c in _WHOLE else f"{rs(c)} AS {c}" for c in columns)


def real(columns):
    return [c for c in columns if c not in _WHOLE]


def _customer_rolling(spark, sf):
    df = gold.with_time_profile(silver(spark, sf))
    return rolling(df, "customer_id", "transaction_ts", gold.CUSTOMER_ROLLING)


CUSTOMER_ROLL_SHOWN = [c for c in CUSTOMER_LATEST if c.startswith("tx_")]


@query(
    "customer_rolling",
    sql(
        f"SELECT transaction_id, {', '.join(CUSTOMER_COUNTS)}, {shown(CUSTOMER_ROLL_SHOWN)} FROM customer_roll",
        "customer_roll",
    ),
)
def _(spark, sf):
    specs = [s for s in gold.CUSTOMER_ROLLING if s.name.startswith("tx_")]
    df = rolling(silver(spark, sf), "customer_id", "transaction_ts", specs)
    return rounded(df, *CUSTOMER_ROLL_SHOWN).select("transaction_id", *CUSTOMER_COUNTS, *CUSTOMER_ROLL_SHOWN)


@query(
    "unique_merchants_exact",
    sql("SELECT transaction_id, unique_merchants_7d FROM customer_roll", "customer_roll"),
)
def _(spark, sf):
    spec = Rolling("unique_merchants_7d", "distinct", 7 * DAY_S, "merchant_id")
    df = rolling(silver(spark, sf), "customer_id", "transaction_ts", [spec])
    return df.select("transaction_id", "unique_merchants_7d")


@query(
    "unique_merchants_by_slices",
    sql(
        """SELECT DISTINCT customer_id, s // 86400 AS slice, count(DISTINCT merchant_id) OVER (PARTITION BY customer_id
  ORDER BY s // 86400 RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS unique_merchants_7d FROM silver""",
        "silver",
    ),
)
def _(spark, sf):
    """Distinct merchants of seven days from sketches, which are exact for sets of this size."""
    return distinct_by_slices(silver(spark, sf), "customer_id", "transaction_ts", "merchant_id", 7, name="unique_merchants_7d")


@query(
    "customer_fraud_rate",
    sql(f"SELECT transaction_id, {shown(['fraud_rate_30d'])} FROM customer_roll", "customer_roll"),
)
def _(spark, sf):
    spec = Rolling("fraud_rate_30d", "mean", 30 * DAY_S, "is_fraud")
    df = rolling(silver(spark, sf), "customer_id", "transaction_ts", [spec])
    return rounded(df, "fraud_rate_30d").select("transaction_id", "fraud_rate_30d")


@query(
    "customer_time_profile",
    sql(
        f"SELECT transaction_id, {shown(['avg_tx_hour_7d', 'weekend_ratio_7d'])} FROM customer_roll",
        "customer_roll",
    ),
)
def _(spark, sf):
    names = ["avg_tx_hour_7d", "weekend_ratio_7d"]
    specs = [s for s in gold.CUSTOMER_ROLLING if s.name in names]
    df = rolling(gold.with_time_profile(silver(spark, sf)), "customer_id", "transaction_ts", specs)
    return rounded(df, *names).select("transaction_id", *names)


@query(
    "merchant_rolling",
    sql(
        f"SELECT transaction_id, tx_count_1d, tx_count_7d, {shown(MERCHANT_LATEST)} FROM merchant_roll",
        "merchant_roll",
    ),
)
def _(spark, sf):
    df = rolling(silver(spark, sf), "merchant_id", "transaction_ts", gold.MERCHANT_ROLLING)
    return rounded(df, *real(MERCHANT_LATEST)).select(
        "transaction_id", "tx_count_1d", "tx_count_7d", *MERCHANT_LATEST
    )


@query(
    "customer_features",
    sql(
        f"""SELECT customer_id, {', '.join(CUSTOMER_COUNTS)}, {shown(CUSTOMER_LATEST)},
  '2024-02-01 00:00:00.000000' AS feature_date FROM customer_feat""",
        "customer_feat",
    ),
)
def _(spark, sf):
    df = gold.customer_features(silver(spark, sf), as_of())
    return rounded(df, *real(CUSTOMER_LATEST)).withColumn("feature_date", text_ts("feature_date"))


@query(
    "merchant_features",
    sql(
        f"""SELECT merchant_id, tx_count_1d, tx_count_7d, {shown(MERCHANT_LATEST)},
  '2024-02-01 00:00:00.000000' AS feature_date FROM merchant_feat""",
        "merchant_feat",
    ),
)
def _(spark, sf):
    df = gold.merchant_features(silver(spark, sf), as_of())
    return rounded(df, *real(MERCHANT_LATEST)).withColumn("feature_date", text_ts("feature_date"))


@query(
    "customer_mean",
    sql(
        f"SELECT customer_id, {rs('avg(amount_usd)')} AS mean_amount FROM silver GROUP BY customer_id", "silver"
    ),
)
def _(spark, sf):
    return silver(spark, sf).groupBy("customer_id").agg(r(F.mean("amount_usd")).alias("mean_amount"))


# Customer 3 and 7 have no mean, so that the default shows.
@query(
    "amount_vs_mean_ratio",
    sql(
        f"""SELECT transaction_id, {rs('amount_usd / (coalesce(m, 100) + 1e-6)')} AS ratio FROM silver
  LEFT JOIN (SELECT customer_id, avg(amount_usd) AS m FROM silver WHERE customer_id NOT IN ('3', '7')
  GROUP BY customer_id) USING (customer_id)""",
        "silver",
    ),
)
def _(spark, sf):
    df = silver(spark, sf)
    history = df.filter(~F.col("customer_id").isin("3", "7"))
    out = ratio_to_entity_mean(df, name="ratio", history=history)
    return rounded(out, "ratio").select("transaction_id", "ratio")


def _history(spark, sf):
    """Pairs seen in the first ten days."""
    return silver(spark, sf).filter(F.col("transaction_ts") < F.lit("2024-01-11").cast("timestamp"))


cte(
    "history",
    """SELECT DISTINCT customer_id, merchant_id, 1 AS seen FROM silver
  WHERE transaction_ts < timestamp '2024-01-11 00:00:00'""",
    ("silver",),
)


@query(
    "is_new_merchant",
    sql(
        """SELECT transaction_id, CASE WHEN seen IS NULL THEN 1 ELSE 0 END AS is_new_merchant
  FROM silver LEFT JOIN history USING (customer_id, merchant_id)""",
        "silver",
        "history",
    ),
)
def _(spark, sf):
    df = new_pair_flag(silver(spark, sf), _history(spark, sf))
    return df.select("transaction_id", "is_new_merchant")


@query(
    "risk_flags",
    sql(
        """SELECT transaction_id, CASE WHEN customer_tx_count_1h > 5 THEN 1 ELSE 0 END AS is_velocity_spike,
  CASE WHEN seen IS NULL THEN 1 ELSE 0 END AS is_new_merchant
  FROM scored LEFT JOIN history USING (customer_id, merchant_id)""",
        "scored",
        "history",
    ),
)
def _(spark, sf):
    df = gold.risk_flags(scored(spark, sf).drop("is_velocity_spike"), _history(spark, sf))
    return df.select("transaction_id", "is_velocity_spike", "is_new_merchant")


@query(
    "velocity_spike_24h",
    sql(
        f"""SELECT transaction_id, CASE WHEN count(*) OVER w > 5 THEN 1 ELSE 0 END AS is_velocity_spike
  FROM silver WINDOW {frame('w', 'customer_id', DAY_S)}""",
        "silver",
    ),
)
def _(spark, sf):
    df = velocity(silver(spark, sf), hours=(24,))
    return velocity_spike(df, 5, "customer_tx_count_24h").select("transaction_id", "is_velocity_spike")


TEMPORAL_SQL = """cast(hour(transaction_ts) AS integer) AS hour_of_day,
  cast(dayofweek(transaction_ts) + 1 AS integer) AS day_of_week,
  CASE WHEN dayofweek(transaction_ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour(transaction_ts) >= 22 OR hour(transaction_ts) < 6 THEN 1 ELSE 0 END AS is_night"""
ZSCORE_SQL = "(amount_usd - (SELECT avg(amount_usd) FROM silver)) / (SELECT stddev(amount_usd) FROM silver)"

cte(
    "tx_feat",
    f"""SELECT transaction_id, customer_id, merchant_id, transaction_ts, is_fraud, {TEMPORAL_SQL},
  {AMOUNT_SQL.format(a='amount_usd', log1p='ln(1 + greatest(amount_usd, 0))')},
  {ZSCORE_SQL} AS amount_zscore, {VELOCITY_SQL},
  CASE WHEN count(*) OVER w1 > 5 THEN 1 ELSE 0 END AS is_velocity_spike, 0 AS is_new_merchant,
  amount_usd / (avg(amount_usd) OVER (PARTITION BY customer_id) + 1e-6) AS amount_vs_customer_mean_ratio
  FROM silver {velocity_windows()}""",
    ("silver",),
)

BATCH_COLUMNS = [
    "transaction_id",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_night",
    "amount_log1p",
    "amount_bucket",
    "is_round_amount",
    "amount_zscore",
    *COUNTS,
    *SUMS,
    "is_velocity_spike",
    "is_new_merchant",
]
_TX_REAL = ["amount_log1p", "amount_zscore", "amount_vs_customer_mean_ratio"]


def tx_shown(columns) -> str:
    return ", ".join(f"{rs(c)} AS {c}" if c in _TX_REAL else c for c in columns)


@query("batch_transforms", sql(f"SELECT {tx_shown(BATCH_COLUMNS)} FROM tx_feat", "tx_feat"))
def _(spark, sf):
    df = gold.batch_transforms(silver(spark, sf))
    return rounded(df, "amount_log1p", "amount_zscore", *SUMS).select(*BATCH_COLUMNS)


@query(
    "stream_transforms_batch",
    sql(
        f"""SELECT transaction_id, {TEMPORAL_SQL},
  {AMOUNT_SQL.format(a='amount_usd', log1p=rs('ln(1 + greatest(amount_usd, 0))'))},
  {rs('(amount_usd - 100) / 200')} AS amount_zscore, {', '.join(f'cast(0 AS bigint) AS {c}' for c in COUNTS)},
  0 AS is_velocity_spike, 0 AS is_new_merchant FROM silver""",
        "silver",
    ),
)
def _(spark, sf):
    df = gold.stream_transforms(silver(spark, sf))
    return rounded(df, "amount_log1p", "amount_zscore").select(*[c for c in BATCH_COLUMNS if c not in SUMS])


TX_COLUMNS = [
    "transaction_id",
    "customer_id",
    "merchant_id",
    *[c for c in BATCH_COLUMNS[1:] if c not in SUMS],
    "amount_vs_customer_mean_ratio",
]


@query(
    "transaction_features",
    sql(
        f"""SELECT {tx_shown(TX_COLUMNS)}, {text_ts_sql('transaction_ts')} AS transaction_ts,
  '2024-02-01 00:00:00.000000' AS feature_date FROM tx_feat""",
        "tx_feat",
    ),
)
def _(spark, sf):
    df = gold.transaction_features(silver(spark, sf), as_of())
    return rounded(df, *_TX_REAL).select(
        *TX_COLUMNS,
        text_ts("transaction_ts").alias("transaction_ts"),
        text_ts("feature_date").alias("feature_date"),
    )


def training_sql(current: bool, mean_from: str, mean_join: str) -> str:
    windows = ", ".join(
        [frame(f"w{h}", "customer_id", h * HOUR_S, current) for h in (1, 6, 24, 168)]
        + [frame("w720", "customer_id", 30 * DAY_S, current)]
    )
    inner = f"""SELECT transaction_id, is_fraud, {TEMPORAL_SQL},
  ln(1 + greatest(amount_usd, 0)) AS amount_log1p, {ZSCORE_SQL} AS amount_zscore,
  cast(amount_usd % 100 = 0 AS integer) AS is_round_amount,
  {', '.join(f'count(*) OVER w{h} AS customer_tx_count_{h}h' for h in (1, 6, 24))},
  count(*) OVER w168 AS customer_tx_count_7d, avg(cast(is_fraud AS double)) OVER w720 AS fraud_rate_30d,
  CASE WHEN count(*) OVER w1 > 5 THEN 1 ELSE 0 END AS is_velocity_spike,
  amount_usd / (coalesce(m, 100) + 1e-6) AS amount_vs_mean_ratio
  FROM silver LEFT JOIN (SELECT customer_id, avg(amount_usd) AS m FROM silver {mean_from} GROUP BY customer_id)
  USING (customer_id) WINDOW {windows}"""
    reals = {"amount_log1p", "amount_zscore", "fraud_rate_30d", "amount_vs_mean_ratio"}
    columns = ", ".join(
        f"coalesce({rs(c)}, 0) AS {c}" if c in reals else f"coalesce({c}, 0) AS {c}" for c in MODEL_FEATURES
    )
    return sql(
        f"SELECT transaction_id, is_fraud, {columns} FROM ({inner}) WHERE is_fraud IS NOT NULL {mean_join}", "silver"
    )


_TRAIN_REAL = ["amount_log1p", "amount_zscore", "fraud_rate_30d", "amount_vs_mean_ratio"]


@query("training_set", training_sql(True, "", ""))
def _(spark, sf):
    return rounded(training_set(silver(spark, sf)), *_TRAIN_REAL)


@query(
    "training_set_no_leak",
    training_sql(False, "WHERE transaction_ts < timestamp '2024-01-16 00:00:00'", ""),
)
def _(spark, sf):
    df = silver(spark, sf)
    past = df.filter(F.col("transaction_ts") < F.lit("2024-01-16").cast("timestamp"))
    return rounded(training_set(df, include_current=False, mean_history=past), *_TRAIN_REAL)


