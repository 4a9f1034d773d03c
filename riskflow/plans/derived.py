"""Frames every named query starts from: the driver's tables turned into raw events, parsed
transactions, feature-store records, a scored prediction log and a model-runs table. Each is
a lazy plan over ``events``, so its work grows with the table."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.features import online_features, store_features
from ..operators import contract, metrics, scoring, silver
from ..schemas import TRANSACTION
from ..session import ensure_utc
from ..sources.events import raw_events, transactions_from_events
from ..sources.tables import read_table
from .jobs import MODEL_NAME



def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table with the scan's own partitions."""
    ensure_utc(spark)
    return read_table(spark, sf_dir, "events")


def transactions(spark, sf_dir) -> DataFrame:
    return transactions_from_events(events(spark, sf_dir))


def raw(spark, sf_dir) -> DataFrame:
    """(event_id, json_str): what a producer would publish, with damaged rows."""
    return raw_events(events(spark, sf_dir))


def parsed(spark, sf_dir) -> DataFrame:
    return silver.parse_raw(raw(spark, sf_dir))


def parsed_fields(spark, sf_dir) -> DataFrame:
    """Every raw row flattened to transaction fields (NULLs where parsing failed): what the
    consumers see, since they read the raw topic rather than silver."""
    return silver.consumer_fields(parsed(spark, sf_dir), keep=("event_id",))


def store_input(spark, sf_dir) -> DataFrame:
    """Consumer fields as the feature-store path reads them (lenient amount)."""
    return silver.store_view(parsed_fields(spark, sf_dir))


def feature_store(spark, sf_dir) -> DataFrame:
    """Contract-passing feature-store records (preset ``store``)."""
    ok, _ = contract.split_contract(store_features(store_input(spark, sf_dir)))
    return ok


def scored_log(spark, sf_dir) -> DataFrame:
    """Rich prediction records of every scorable raw event, scored by the rule stand-in, with
    the event time as inference time (a replay of the stream)."""
    tx = parsed_fields(spark, sf_dir)
    # features.amount is the transaction's amount: carried once
    keep = tuple(f.name for f in TRANSACTION.fields if f.name != "amount")
    on = online_features(tx, keep=keep)
    ok, _ = contract.split_model_input(on, keep=keep)
    scored = scoring.rule_model_score(ok)
    return scoring.rich_record(scored, run_id=None, inference_ts=_event_time())


@cache
def _event_time():
    return F.try_to_timestamp(F.col("timestamp"))


def daily_runs(spark, sf_dir) -> DataFrame:
    """One candidate run per day of data: the rule model evaluated on that day's labelled
    feature-store rows, in the ``model_runs`` shape. Versions follow the days."""
    fs = feature_store(spark, sf_dir)
    lab = fs.select(F.substring("timestamp", 1, 10).alias("day"),
                    F.col("is_fraud").cast("double").alias("label"),
                    F.when(F.col("risk_score") >= 2, 1.0).otherwise(0.0).alias("prediction")) \
        .filter(F.try_to_date("day").isNotNull())
    per_day = metrics.classification_metrics(lab, by=("day",))
    # one row per calendar day: a small table, ranked in one window
    version = F.dense_rank().over(Window.orderBy("day"))
    return per_day.select(
        F.lit(MODEL_NAME).alias("model_name"),
        F.concat(F.lit("run-"), F.col("day")).alias("run_id"),
        version.cast("int").alias("version"),
        F.lit(True).alias("candidate"),
        F.to_date("day").alias("day"),
        F.col("f1").alias("f1_score"),
        F.col("accuracy"))
