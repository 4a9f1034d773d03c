"""Scoring outputs, model fit/save/load, single-class models."""

import pytest
from pyspark.ml import PipelineModel

from riskflow.operators import scoring, training
from riskflow.schemas import MODEL_FEATURES


def _train_rows(spark, label_fn, n=120):
    rows = [(float(i * 40), i % 2, i % 2, i % 24, int(i % 24 < 6), i % 3 == 0 and 1 or 0,
             float(i % 4), float(label_fn(i))) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(
        [f"{c} {'double' if c in ('amount', 'risk_score') else 'int'}" for c in MODEL_FEATURES]
        + ["label double"]))


def test_fit_score_roundtrip(spark, tmp_path):
    df = _train_rows(spark, lambda i: i % 4 >= 2)
    model = training.fit_model(df, num_trees=5, max_depth=3)
    out = scoring.score(df, model)
    assert set(scoring.SCORE_COLS) <= set(out.columns)
    r = out.select(*scoring.SCORE_COLS).first()
    assert r["fraud_probability"] + r["non_fraud_probability"] == pytest.approx(1.0)
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = scoring.score(df, PipelineModel.load(path)).select("fraud_probability").collect()
    assert again == out.select("fraud_probability").collect()


def test_fit_is_repeatable(spark):
    df = _train_rows(spark, lambda i: (i * 7) % 5 < 2)
    a = training.evaluate(training.fit_model(df, num_trees=5), df)
    b = training.evaluate(training.fit_model(df, num_trees=5), df)
    assert a == b


def test_single_class_model(spark):
    """A forest fitted on label 0 only has a length-1 probability vector: P(1) = 0.0."""
    df = _train_rows(spark, lambda i: 0)
    model = training.fit_model(df, num_trees=3, max_depth=2)
    r = scoring.score(df, model).select(*scoring.SCORE_COLS).first()
    assert r["fraud_probability"] == 0.0 and r["non_fraud_probability"] == 1.0
    assert r["prediction"] == 0


def test_rule_model_and_records(spark):
    rows = [("t1", 2500.0, 1, 1, 23, 1, 0, 3.0), ("t2", 10.0, 0, 0, 12, 0, 0, 0.0)]
    df = spark.createDataFrame(rows, "transaction_id string, amount double, is_high_amount int, "
                               "is_card_not_present int, tx_hour int, is_night_tx int, "
                               "is_risky_payment int, risk_score double")
    s = scoring.rule_model_score(df)
    rec = scoring.short_record(s).orderBy("transaction_id").collect()
    assert rec[0]["prediction"]["prediction"] == 1
    assert rec[0]["prediction"]["fraud_probability"] == 1.0
    assert rec[1]["prediction"]["prediction"] == 0
    js = scoring.to_json_value(scoring.short_record(s)).first()["value"]
    assert '"features"' in js and '"prediction"' in js


def test_hash_split_stable(spark, sf_small):
    from riskflow.plans import derived as D
    tf = training.training_frame(D.feature_store(spark, sf_small), keep=("transaction_id",))
    a, _ = training.hash_split(tf)
    b, _ = training.hash_split(tf.repartition(3))
    assert sorted(r[0] for r in a.select("transaction_id").collect()) == \
        sorted(r[0] for r in b.select("transaction_id").collect())
