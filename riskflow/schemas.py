"""Every table riskflow reads or writes, as an explicit StructType (no schema inference)."""

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, MapType, StringType,
                               StructField, StructType, TimestampType)

# Raw message as it arrives (Kafka value or one JSON line per event)
BRONZE = StructType([StructField("json_str", StringType(), True)])

LOCATION = StructType([
    StructField("city", StringType(), True),
    StructField("state", StringType(), True),
    StructField("country", StringType(), True),
])

# Names, types and order of the transaction, feature and model-input fields
# Typed transaction parsed from json_str (silver)
TRANSACTION = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("user_id", StringType(), True),
    StructField("merchant_id", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("amount", DoubleType(), True),
    StructField("currency", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("merchant_category", StringType(), True),
    StructField("payment_method", StringType(), True),
    StructField("card_present", BooleanType(), True),
    StructField("location", LOCATION, True),
    StructField("ip_address", StringType(), True),
    StructField("is_fraud", IntegerType(), True),
])

CORRUPT_COL = "_malformed"
# Parse schema: the transaction plus the column where from_json keeps text it could not
# fully convert (PERMISSIVE mode)
TRANSACTION_PARSE = StructType(TRANSACTION.fields + [StructField(CORRUPT_COL, StringType(), True)])

# Fields silver requires (not null), in the order reasons are reported
REQUIRED_FIELDS = ["transaction_id", "user_id", "merchant_id", "device_id", "amount",
                   "currency", "timestamp"]

# Feature-store record (variant "store"); types are the contract
FEATURES = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("amount", DoubleType(), True),
    StructField("is_high_amount", IntegerType(), True),
    StructField("is_card_not_present", IntegerType(), True),
    StructField("tx_hour", IntegerType(), True),
    StructField("is_night_tx", IntegerType(), True),
    StructField("is_risky_payment", IntegerType(), True),
    StructField("risk_score", DoubleType(), True),
    StructField("is_fraud", IntegerType(), True),
    StructField("timestamp", StringType(), True),
])

# Model input, canonical order (the order of the assembled vector)
MODEL_INPUT = StructType([
    StructField("amount", DoubleType(), True),
    StructField("is_high_amount", IntegerType(), True),
    StructField("is_card_not_present", IntegerType(), True),
    StructField("tx_hour", IntegerType(), True),
    StructField("is_night_tx", IntegerType(), True),
    StructField("is_risky_payment", IntegerType(), True),
    StructField("risk_score", DoubleType(), True),
])
MODEL_FEATURES = [f.name for f in MODEL_INPUT.fields]

SCORE = StructType([
    StructField("prediction", IntegerType(), True),
    StructField("fraud_probability", DoubleType(), True),
    StructField("non_fraud_probability", DoubleType(), True),
])

PREDICTION_SHORT = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("features", MODEL_INPUT, True),
    StructField("prediction", SCORE, True),
])

PREDICTION = StructType([
    StructField("inference_timestamp", TimestampType(), True),
    StructField("model_run_id", StringType(), True),
    StructField("transaction_id", StringType(), True),
    StructField("transaction", TRANSACTION, True),
    StructField("features", MODEL_INPUT, True),
    StructField("prediction", SCORE, True),
])

DRIFT_REPORT = StructType([
    StructField("metric", StringType(), False),
    StructField("baseline", DoubleType(), True),
    StructField("recent", DoubleType(), True),
    StructField("diff", DoubleType(), True),
    StructField("pct_change", DoubleType(), True),
    StructField("drift_detected", BooleanType(), True),
])

MODEL_RUNS = StructType([
    StructField("model_name", StringType(), False),
    StructField("run_id", StringType(), False),
    StructField("version", IntegerType(), False),
    StructField("candidate", BooleanType(), False),
    StructField("params", MapType(StringType(), StringType()), True),
    StructField("auc", DoubleType(), True),
    StructField("f1_score", DoubleType(), True),
    StructField("accuracy", DoubleType(), True),
    StructField("model_path", StringType(), True),
    StructField("created_at", TimestampType(), True),
])

GAUGES = StructType([
    StructField("metric", StringType(), False),
    StructField("value", DoubleType(), True),
    StructField("computed_at", TimestampType(), True),
])

__all__ = ["BRONZE", "LOCATION", "TRANSACTION", "TRANSACTION_PARSE", "CORRUPT_COL",
           "REQUIRED_FIELDS", "FEATURES", "MODEL_INPUT", "MODEL_FEATURES", "SCORE",
           "PREDICTION_SHORT", "PREDICTION", "DRIFT_REPORT", "MODEL_RUNS", "GAUGES"]
