"""Scoring with a fitted pipeline or the rule stand-in, and prediction records.

``score`` works on batch and streaming frames: the fitted model is shipped to executors by
``transform``; there is no per-event job and no round trip through a service.
"""

from __future__ import annotations

from functools import cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MODEL_FEATURES, TRANSACTION

SCORE_COLS = ["prediction", "fraud_probability", "non_fraud_probability"]


def score(df: DataFrame, model) -> DataFrame:
    """Append prediction (INT), fraud_probability = P(1), non_fraud_probability = P(0).

    A model fitted on one class yields a length-1 probability vector; P(1) is then 0.0
    instead of an index error."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))
    drop = [c for c in ("features", "rawPrediction", "probability", "prediction")
            if c in out.columns and c not in df.columns]
    return out.select(
        *[F.col(c) for c in out.columns if c not in drop],
        F.col("prediction").cast("int").alias("_prediction"),
        F.coalesce(F.get(p, 1), F.lit(0.0)).alias("fraud_probability"),
        F.get(p, 0).alias("non_fraud_probability"),
    ).withColumnRenamed("_prediction", "prediction")


def rule_model_score(df: DataFrame) -> DataFrame:
    """Stand-in model with the same output columns as :func:`score`: the share of the three
    rule flags (high amount, card not present, night) is P(fraud), and prediction is 1 when at
    least two are set. Used where a deterministic, SQL-checkable scorer is needed."""
    return df.select("*", *_rule_score_columns())


@cache
def _rule_score_columns() -> tuple:
    s = (F.col("is_high_amount") + F.col("is_card_not_present") + F.col("is_night_tx"))
    p = s.cast("double") / F.lit(3.0)
    return (F.when(s >= 2, 1).otherwise(0).alias("prediction"), p.alias("fraud_probability"),
            (F.lit(1.0) - p).alias("non_fraud_probability"))


@cache
def features_struct() -> Column:
    return F.struct(*[F.col(c) for c in MODEL_FEATURES])


@cache
def prediction_struct() -> Column:
    return F.struct(*[F.col(c) for c in SCORE_COLS])


def short_record(scored: DataFrame) -> DataFrame:
    """transaction_id, features{7}, prediction{3}."""
    return scored.select("transaction_id", features_struct().alias("features"),
                         prediction_struct().alias("prediction"))


def rich_record(scored: DataFrame, run_id: str | None = None,
                inference_ts: Column | None = None) -> DataFrame:
    """inference_timestamp, model_run_id, transaction_id, transaction{13}, features, prediction.

    ``inference_ts`` defaults to ``current_timestamp()`` (one value per micro-batch, so the
    log's order key is (inference_timestamp, transaction_id)). ``run_id`` NULL -> "unknown".
    ``scored`` must carry the transaction fields."""
    ts = F.current_timestamp() if inference_ts is None else inference_ts
    return scored.select(ts.alias("inference_timestamp"), *_rich_columns(run_id))


@cache
def _rich_columns(run_id) -> tuple:
    tx = F.struct(*[F.col(f.name) for f in TRANSACTION.fields])
    return (F.coalesce(F.lit(run_id).cast("string"), F.lit("unknown")).alias("model_run_id"),
            F.col("transaction_id"), tx.alias("transaction"),
            features_struct().alias("features"), prediction_struct().alias("prediction"))


def to_json_value(records: DataFrame) -> DataFrame:
    """One JSON text per record (``value``), NULL fields kept, for a topic or file sink."""
    return records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
