"""Model runs table and the champion derived from it.

The reference keeps versions and a ``champion`` alias in an external tracking service. Here
runs are rows of an append-only ``model_runs`` table (parquet), and the champion is *derived*
from it with a window, never updated in place, so concurrent readers always see a consistent
answer. Promotion rule: a candidate version is promoted iff there is no champion yet or its
F1 is strictly greater than the champion's.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import MODEL_RUNS
from .training import MAX_DEPTH, NUM_TREES


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    from ..sources.tables import _exists
    if not _exists(spark, path):
        return spark.createDataFrame([], MODEL_RUNS)
    return spark.read.schema(MODEL_RUNS).parquet(path)


def next_version(runs: DataFrame, model_name: str) -> int:
    """``max(version) + 1`` for the model (1 for the first). Not safe under concurrent
    registrations of the same model; a single trainer per model is assumed."""
    v = runs.filter(F.col("model_name") == model_name).agg(F.max("version")).first()[0]
    return (v or 0) + 1


def run_params(feature_cols: list, num_trees: int = NUM_TREES,
               max_depth: int = MAX_DEPTH) -> dict:
    return {"model_type": "RandomForest", "num_trees": str(num_trees),
            "max_depth": str(max_depth), "feature_cols": ",".join(feature_cols)}


def register_run(spark: SparkSession, path: str, model_name: str, run_id: str, metrics: dict,
                 params: dict, model_path: str | None, candidate: bool) -> DataFrame:
    """Append one run; returns the appended row. ``candidate`` runs compete for champion
    (retraining); a first training run only registers a version."""
    runs = read_runs(spark, path)
    version = next_version(runs, model_name)
    row = spark.createDataFrame([(model_name, run_id, version, candidate, params,
                                  metrics.get("auc"), metrics.get("f1_score"),
                                  metrics.get("accuracy"), model_path,
                                  _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))],
                                MODEL_RUNS)
    row.write.mode("append").parquet(path)
    return row


def champion_history(runs: DataFrame, f1_col: str = "f1_score") -> DataFrame:
    """Candidate versions in order with the champion F1 each one faced and whether it was
    promoted. Equal to replaying the promotion rule sequentially, including Python's NaN
    comparisons (a NaN never beats a champion; a NaN first champion is never beaten)."""
    c = runs.filter("candidate")
    f1 = F.col(f1_col)
    part = Window.partitionBy("model_name").orderBy("version")
    prev = part.rowsBetween(Window.unboundedPreceding, -1)
    whole = part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    has_prior = F.count(F.lit(1)).over(prev) > 0
    prior_best = F.max(F.when(~F.isnan(f1), f1)).over(prev)
    first_nan = F.coalesce(F.isnan(F.first(f1).over(whole)), F.lit(False))
    champion_before = F.when(~has_prior, F.lit(None).cast("double")) \
        .when(first_nan, F.lit(float("nan"))).otherwise(prior_best)
    promoted = ~has_prior | (~first_nan & F.coalesce(~F.isnan(f1) & (f1 > prior_best),
                                                     F.lit(False)))
    return c.select("*", champion_before.alias("champion_f1_before"),
                    promoted.alias("promoted"))


def current_champion(runs: DataFrame) -> DataFrame:
    """Per model: the run row of the last promoted version (the ``champion`` alias). One
    pass over the runs: the newest promoted row is picked with ``max_by``, no self-join."""
    h = champion_history(runs).filter("promoted")
    cols = [c for c in runs.columns if c != "model_name"]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("version"))
    return h.groupBy("model_name").agg(best.alias("_c")).select("model_name", "_c.*")


def champion_f1(runs: DataFrame, model_name: str):
    """The champion's F1, or None when there is no champion."""
    r = current_champion(runs).filter(F.col("model_name") == model_name) \
        .select("f1_score").first()
    return None if r is None else r[0]


def latest_version(runs: DataFrame, run_id: str | None = None) -> DataFrame:
    """Newest (numerically largest) version per (model, run); ``run_id`` filters one run."""
    r = runs if run_id is None else runs.filter(F.col("run_id") == run_id)
    return r.groupBy("model_name", "run_id").agg(F.max("version").alias("latest_version"))
