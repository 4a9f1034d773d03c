"""Model-quality metrics as aggregations: exact ROC AUC, class-weighted F1, accuracy.

All three reduce the scored rows by map-side-combined aggregation first (distinct scores,
confusion counts), so the work after the first shuffle is proportional to the number of
distinct scores or classes, not to the number of rows. Optional ``by`` columns compute the
metrics per group (e.g. per day) in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_sum


def _is_pos(label: Column) -> Column:
    # the evaluator's convention: label > 0.5 is the positive class
    return label > 0.5


def auc_exact(df: DataFrame, label_col: str = "label", score_col: str = "score",
              num_buckets: int = 1024, materialize: bool = True, by: tuple = ()) -> DataFrame:
    """``auc`` (one row, or one per group of ``by``): area under the ROC curve with ties counted
    half (Mann-Whitney), exact (the ML evaluator bins thresholds). NULL when one class is absent.
    ``materialize`` writes the distinct scores to the checkpoint folder once, for the quantiles,
    the bucket totals and the sums to read."""
    lab, sc = F.col(label_col), F.col(score_col)
    g = (df.filter(lab.isNotNull() & sc.isNotNull())
         .groupBy(*by, sc.alias("_s"))
         .agg(F.sum(F.when(_is_pos(lab), 1).otherwise(0)).cast("bigint").alias("pos"),
              F.sum(F.when(_is_pos(lab), 0).otherwise(1)).cast("bigint").alias("neg")))
    if materialize:
        g = g.checkpoint(eager=True)
    pref = running_sum(g, "_s", ["neg"], num_buckets=num_buckets, by=by)
    out = pref.groupBy(*by).agg(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") * 0.5))
                                .alias("_num"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return out.select(*by, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                                  F.col("_num") / (F.col("_p").cast("double") * F.col("_n").cast("double"))).alias("auc"))


def confusion(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
              by: tuple = ()) -> DataFrame:
    """Counts per (by..., label, prediction): at most classes^2 rows per group."""
    return (df.filter(F.col(label_col).isNotNull() & F.col(pred_col).isNotNull())
            .groupBy(*by, F.col(label_col).cast("double").alias("_l"),
                     F.col(pred_col).cast("double").alias("_p"))
            .agg(F.count(F.lit(1)).alias("_c")))


def classification_metrics(df: DataFrame, label_col: str = "label",
                           pred_col: str = "prediction", by: tuple = ()) -> DataFrame:
    """``f1`` (F-measure per label class, weighted by class frequency, as the ML evaluator's
    "f1"), and ``accuracy``, per group of ``by``.

    Join-free: every confusion cell (l, p, n) is stacked into its label class (actual n,
    true positives n when l = p) and its predicted class (predicted n), then summed per class.
    """
    c = confusion(df, label_col, pred_col, by)
    by = list(by)
    cells = c.select(*by, F.expr(
        "stack(2, _l, _c, CASE WHEN _l = _p THEN _c ELSE 0L END, 0L, "
        "_p, 0L, 0L, _c) AS (cls, actual, tp, predicted)"))
    per = cells.groupBy(*by, "cls").agg(F.sum("actual").alias("actual"),
                                        F.sum("tp").alias("tp"),
                                        F.sum("predicted").alias("predicted"))
    per = per.filter(F.col("actual") > 0)      # classes present among the labels
    prec = F.when(F.col("predicted") == 0, F.lit(0.0)) \
        .otherwise(F.col("tp") / F.col("predicted"))
    rec = F.col("tp") / F.col("actual")
    per = per.select(*by, "actual", "tp", prec.alias("p"), rec.alias("r"))
    f = F.when(F.col("p") + F.col("r") == 0, F.lit(0.0)) \
        .otherwise(2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r")))
    return per.groupBy(*by).agg(
        (F.sum(f * F.col("actual")) / F.sum("actual")).alias("f1"),
        (F.sum("tp") / F.sum("actual")).alias("accuracy"))


def weighted_f1(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                by: tuple = ()) -> DataFrame:
    return classification_metrics(df, label_col, pred_col, by).select(*by, "f1")


def accuracy(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
             by: tuple = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg((F.col(label_col).cast("double") == F.col(pred_col).cast("double"))
              .cast("double")).alias("accuracy"))


def evaluator_metrics(scored: DataFrame, label_col: str = "label") -> dict:
    """Cross-check with Spark ML's evaluators (AUC there is binned, ``numBins``)."""
    from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                       MulticlassClassificationEvaluator)
    auc = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol="rawPrediction",
                                        metricName="areaUnderROC").evaluate(scored)
    f1 = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction",
                                           metricName="f1").evaluate(scored)
    acc = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction",
                                            metricName="accuracy").evaluate(scored)
    return {"auc": auc, "f1_score": f1, "accuracy": acc}
