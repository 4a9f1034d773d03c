"""AUC / F1 / accuracy: exact forms against brute force and Spark ML's evaluators."""

import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators import metrics


def _auc_brute(rows):
    pos = [s for l, s in rows if l > 0.5]
    neg = [s for l, s in rows if l <= 0.5]
    tot = 0.0
    for p in pos:
        for n in neg:
            tot += 1.0 if p > n else (0.5 if p == n else 0.0)
    return tot / (len(pos) * len(neg))


def test_auc_ties_and_spread(spark):
    random.seed(3)
    rows = [(float(random.random() < 0.3), round(random.random(), 2)) for _ in range(600)]
    df = spark.createDataFrame(rows, "label double, score double")
    want = _auc_brute(rows)
    got = metrics.auc_exact(df, num_buckets=16).first()["auc"]            # small path
    assert got == pytest.approx(want, abs=1e-12)
    got = metrics.auc_exact(df, num_buckets=16).first()["auc"]  # bucketed
    assert got == pytest.approx(want, abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.6)], "label double, score double")
    assert metrics.auc_exact(df).first()["auc"] is None


def test_f1_accuracy_match_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    random.seed(5)
    rows = [(float(random.random() < 0.4), float(random.random() < 0.5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = metrics.classification_metrics(df).first()
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert m["f1"] == pytest.approx(f1, abs=1e-12)
    assert m["accuracy"] == pytest.approx(acc, abs=1e-12)
    assert metrics.accuracy(df).first()["accuracy"] == pytest.approx(acc, abs=1e-12)


def test_never_predicted_class_counts_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert metrics.weighted_f1(df).first()["f1"] == pytest.approx(f1)


def test_rule_model_figures_at_sf001(spark):
    """FIXTURES 3: rule score >= 2 vs label over all 10,000 derived transactions."""
    from riskflow.functions.features import rule_score
    from riskflow.plans import derived as D
    t = D.transactions(spark, "/root/testdata/sf0.01")
    df = t.select(F.col("is_fraud").cast("double").alias("label"),
                  (rule_score() / 3.0).alias("score"),
                  F.when(rule_score() >= 2, 1.0).otherwise(0.0).alias("prediction"))
    assert round(metrics.auc_exact(df, "label", "score").first()["auc"], 4) == 0.8561
    m = metrics.classification_metrics(df).first()
    assert round(m["f1"], 4) == 0.8657 and round(m["accuracy"], 4) == 0.8653


def test_auc_by_group_equals_brute_force(spark):
    """One group holds most rows; ties, a group of one class, NULL group."""
    rng = random.Random(9)
    rows = [(g, float(rng.random() < 0.3), rng.choice([0.1, 0.2, 0.5, rng.random()]))
            for g, n in (("hot", 900), ("b", 40), (None, 30)) for _ in range(n)] + [("one", 1.0, 0.4)] * 3
    df = spark.createDataFrame(rows, "g string, label double, score double")
    got = {r["g"]: r["auc"] for r in metrics.auc_exact(df, num_buckets=16, by=("g",)).collect()}
    assert set(got) == {"hot", "b", None, "one"} and got["one"] is None
    for g in ("hot", "b", None):
        pos = [s for h, y, s in rows if h == g and y > 0.5]
        neg = [s for h, y, s in rows if h == g and y <= 0.5]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got[g] == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)
