"""Fixed table schemas.  Readers never infer a schema."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "float": FloatType(),
    "timestamp": TimestampType(),
}


def _schema(spec: str) -> StructType:
    """``"a long!, b double"`` to a StructType; ``!`` marks a required column."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return StructType(fields)


def _numbered(prefix: str, last: int, kind: str, width: int = 1) -> str:
    return ", ".join(f"{prefix}{i:0{width}d} {kind}" for i in range(1, last + 1))


# Column groups of the card data set.
C_COLS = [f"C{i}" for i in range(1, 15)]
D_COLS = [f"D{i}" for i in range(1, 16)]
M_COLS = [f"M{i}" for i in range(1, 10)]
V_COLS = [f"V{i}" for i in range(1, 340)]

CARD_TRANSACTIONS = _schema(
    "TransactionID long!, isFraud int, TransactionDT long!, TransactionAmt double!, "
    "ProductCD string, card1 int, card2 double, card3 double, card4 string, card5 double, "
    "card6 string, addr1 double, addr2 double, dist1 double, dist2 double, "
    "P_emaildomain string, R_emaildomain string, "
    + ", ".join(
        [
            _numbered("C", 14, "double"),
            _numbered("D", 15, "double"),
            _numbered("M", 9, "string"),
            _numbered("V", 339, "double"),
        ]
    )
)

CARD_IDENTITY = _schema(
    "TransactionID long!, " + _numbered("id_", 38, "string", 2) + ", DeviceType string, DeviceInfo string"
)

TRANSFERS = _schema(
    "step int!, type string!, amount double!, nameOrig string!, oldbalanceOrg double!, "
    "newbalanceOrig double!, nameDest string!, oldbalanceDest double!, newbalanceDest double!, "
    "isFraud int!, isFlaggedFraud int!"
)

STREAM_EVENT = _schema(
    "transaction_id string!, customer_id string!, merchant_id string!, amount double!, "
    "currency string, channel string, merchant_category string, transaction_ts long!, "
    "producer_ts long!, lat double, lon double, device_fingerprint string, is_fraud int"
)

AUDIT = _schema("_ingest_ts timestamp, _source_file string, _batch_id string, _ingest_date string")

SILVER = _schema(
    "transaction_id string!, customer_id string, merchant_id string, transaction_ts timestamp!, "
    "amount_usd double!, currency string, channel string, merchant_category string, "
    "card_type string, is_fraud int, data_source string!, _ingest_ts timestamp!, _silver_ts timestamp!"
)

CUSTOMER_FEATURES = _schema(
    "customer_id string!, feature_date timestamp!, tx_count_1d long, tx_count_7d long, "
    "tx_count_30d long, tx_amount_sum_1d double, tx_amount_sum_7d double, tx_amount_sum_30d double, "
    "tx_amount_mean_7d double, tx_amount_std_7d double, unique_merchants_7d long, "
    "fraud_rate_30d double, avg_tx_hour_7d double, weekend_ratio_7d double"
)

MERCHANT_FEATURES = _schema(
    "merchant_id string!, feature_date timestamp!, tx_count_1d long, tx_count_7d long, "
    "fraud_count_30d long, fraud_rate_30d double, avg_amount_7d double, unique_customers_7d long"
)

TRANSACTION_FEATURES = _schema(
    "transaction_id string!, transaction_ts timestamp!, feature_date timestamp!, hour_of_day int, "
    "day_of_week int, is_weekend int, is_night int, amount_log1p double, amount_bucket string, "
    "amount_zscore double, customer_tx_count_1h long, customer_tx_count_6h long, "
    "customer_tx_count_24h long, amount_vs_customer_mean_ratio double, is_new_merchant int, "
    "is_round_amount int, is_velocity_spike int"
)

FRAUD_LABELS = _schema(
    "transaction_id string, customer_id string, transaction_ts timestamp, is_fraud int, "
    "data_source string, label_ts timestamp"
)

ANOMALY_SCORES = _schema(
    "transaction_id string!, anomaly_score float!, anomaly_label int!, is_fraud int!"
)

LATENCY_METRICS = _schema("batch_id long, latency_ms long, recorded_at timestamp")

JOB_METRICS = _schema(
    "job string!, metric string!, measured double, target double, direction string, recorded_at timestamp!"
)

# The model vector, in model order.
MODEL_FEATURES = [
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_night",
    "amount_log1p",
    "amount_zscore",
    "is_round_amount",
    "customer_tx_count_1h",
    "customer_tx_count_6h",
    "customer_tx_count_24h",
    "customer_tx_count_7d",
    "fraud_rate_30d",
    "is_velocity_spike",
    "amount_vs_mean_ratio",
]


def conforms(columns: StructType, wanted: StructType) -> list[str]:
    """Differences between a frame's schema and a registered one, as text."""
    have = {f.name: f.dataType for f in columns}
    problems = [f"missing {f.name}" for f in wanted if f.name not in have]
    problems += [
        f"{f.name}: {have[f.name].simpleString()} is not {f.dataType.simpleString()}"
        for f in wanted
        if f.name in have and have[f.name] != f.dataType
    ]
    return problems
