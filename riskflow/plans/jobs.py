"""The reference's programs as Spark jobs over tables: train, retrain-and-promote, drift report
with retrain decision, gauge refresh, and the streaming medallion and scoring queries.

Paths are folders on shared storage (parquet tables unless stated). Every job is a function
of (spark, paths, options) so a scheduler can call it; ``python -m riskflow`` wraps them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, registry, training
from ..schemas import MODEL_FEATURES
from ..sources.tables import _exists, read_features, read_predictions
from ..streaming.scoring import summary_path

# Fixed value: the registered model name of the reference
MODEL_NAME = "fraud_model"


@dataclass
class Paths:
    features: str            # feature store (parquet, batch_id partitions)
    predictions: str         # prediction log (rich records)
    runs: str                # model_runs table
    models: str              # root folder of saved pipelines
    gauges: str | None = None  # gauge history table


def _train_eval(spark: SparkSession, paths: Paths, split: str):
    tf = training.training_frame(read_features(spark, paths.features),
                                 keep=("transaction_id",))
    if split == "random":
        train, test = training.random_split(tf.drop("transaction_id"))
    else:
        train, test = training.hash_split(tf)
        train = train.drop("transaction_id")
    # a stored table: the forest re-reads seven pruned columns for its metadata and split
    # candidates and caches its own bagged points, so the input is not persisted here
    model = training.fit_model(train)
    return model, training.evaluate(model, test)


def train_job(spark: SparkSession, paths: Paths, split: str = "hash") -> DataFrame:
    """First training: fit, evaluate (AUC, F1, accuracy), save the pipeline, register a
    version. It does not compete for champion (only retraining promotes)."""
    model, m = _train_eval(spark, paths, split)
    run_id = uuid.uuid4().hex
    model_path = f"{paths.models.rstrip('/')}/{MODEL_NAME}/{run_id}"
    model.write().overwrite().save(model_path)
    return registry.register_run(spark, paths.runs, MODEL_NAME, run_id, m,
                                 registry.run_params(MODEL_FEATURES), model_path,
                                 candidate=False)


def retrain_job(spark: SparkSession, paths: Paths, split: str = "hash") -> DataFrame:
    """Retrain, register as a candidate, and report whether it became the champion. A
    validation set with one class cannot rank models (AUC undefined): such a run is
    registered but does not compete."""
    model, m = _train_eval(spark, paths, split)
    run_id = uuid.uuid4().hex
    model_path = f"{paths.models.rstrip('/')}/{MODEL_NAME}/{run_id}"
    model.write().overwrite().save(model_path)
    competes = m["auc"] is not None
    registry.register_run(spark, paths.runs, MODEL_NAME, run_id, m,
                          registry.run_params(MODEL_FEATURES), model_path, candidate=competes)
    runs = registry.read_runs(spark, paths.runs)
    return registry.champion_history(runs).filter(F.col("run_id") == run_id)


def _summary(spark: SparkSession, paths: Paths):
    """The scoring stream's sums, or None for a log that has none (they are then computed)."""
    path = summary_path(paths.predictions)
    return spark.read.parquet(path) if _exists(spark, path) else None


def drift_job(spark: SparkSession, paths: Paths, retrain: bool = True, order: str = "time"):
    """Drift report over the prediction log, cut in order of inference time, or of arrival
    (``order="arrival"``, from the manifest that the scoring stream keeps); when risk score or amount drifted (and
    ``retrain``), run :func:`retrain_job`. Returns (report, decision, retrain result); the
    report is persisted (five rows), the caller unpersists it when done."""
    summary = _summary(spark, paths)
    if order == "arrival":
        if summary is None:
            raise ValueError(f"{paths.predictions} has no summary: only a log that the scoring stream wrote has an order of arrival")
        report = drift.arrival_report(spark, paths.predictions, summary).persist()
    else:
        report = drift.drift_report(read_predictions(spark, paths.predictions), summary=summary).persist()
    decision = drift.retrain_decision(report).first()
    result = None
    if retrain and decision is not None and decision["should_retrain"]:
        result = retrain_job(spark, paths)
    return report, decision, result


def gauges_job(spark: SparkSession, paths: Paths) -> DataFrame:
    """Refresh the drift gauges: append (metric, value, computed_at) rows to the gauge table
    (nothing when the log is shorter than 20 records). The eight rows are computed once; what
    is returned is what was written."""
    log = read_predictions(spark, paths.predictions)
    gauges = drift.gauge_rows(drift.drift_gauges(log, summary=_summary(spark, paths)))
    rows = spark.createDataFrame(gauges.collect(), gauges.schema)
    if paths.gauges and not rows.isEmpty():
        rows.write.mode("append").parquet(paths.gauges)
    return rows
