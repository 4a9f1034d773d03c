"""Table readers: JSON-lines prediction log semantics, explicit schemas, raw sources."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from riskflow import schemas
from riskflow.session import scratch_path
from riskflow.sources.raw import read_raw
from riskflow.sources.tables import read_features, read_predictions
from riskflow.streaming.sinks import write_batch


def _write_text(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def test_missing_log_is_empty(spark):
    df = read_predictions(spark, scratch_path(spark, "nope"), fmt="json")
    assert df.count() == 0 and df.schema == schemas.PREDICTION


def test_log_skips_blank_lines(spark):
    path = scratch_path(spark, "log")
    rec = {"inference_timestamp": "2024-01-01T00:00:00Z", "model_run_id": "r",
           "transaction_id": "t", "features": {"amount": 1.0}, "prediction": {"prediction": 1}}
    _write_text(spark, path, [json.dumps(rec), "", "   ", json.dumps(rec)])
    df = read_predictions(spark, path, fmt="json")
    assert df.count() == 2
    assert df.select("features.amount").first()[0] == 1.0


def test_malformed_log_line_fails(spark):
    path = scratch_path(spark, "badlog")
    _write_text(spark, path, ['{"transaction_id": "t"}', "{torn"])
    with pytest.raises((Py4JJavaError, PySparkException, Exception)):
        read_predictions(spark, path, fmt="json").collect()


def test_features_explicit_schema(spark):
    path = scratch_path(spark, "fs")
    _write_text(spark, path, ['{"transaction_id": "t", "amount": 1, "tx_hour": 3}'])
    df = read_features(spark, path, fmt="json")
    assert df.schema == schemas.FEATURES
    r = df.first()
    assert r["amount"] == 1.0 and r["tx_hour"] == 3 and r["is_fraud"] is None


def test_raw_text_and_json_sources(spark):
    path = scratch_path(spark, "raw")
    _write_text(spark, path, ['{"transaction_id": "t1"}', '{"transaction_id": "t2"}'])
    assert read_raw(spark, "text", path).count() == 2
    bronze = scratch_path(spark, "bronze")
    read_raw(spark, "text", path).write.json(bronze)
    assert sorted(r[0] for r in read_raw(spark, "json", bronze).collect()) == \
        ['{"transaction_id": "t1"}', '{"transaction_id": "t2"}']


def test_uncompressed_batch(spark):
    path = scratch_path(spark, "unc")
    write_batch(spark.range(5), path, 0, compression="uncompressed")
    files = [f for f in os.listdir(f"{path}/query_id=batch/batch_id=0") if f.endswith(".parquet")]
    assert files and all(".snappy." not in f for f in files)
    assert spark.read.parquet(path).count() == 5


def test_kafka_source_reports_missing_connector(spark):
    from riskflow.sources.raw import read_raw_stream
    with pytest.raises((RuntimeError, ValueError)) as ei:
        read_raw_stream(spark, "kafka", servers="localhost:1", topic="transactions_raw")
    assert "kafka" in str(ei.value).lower()
    with pytest.raises(ValueError):
        read_raw_stream(spark, "kafka")


def test_log_snapshot_is_stable(spark):
    """A log frame keeps the file list it was read with: appends during a drift report do not
    change the counts its selection passes see."""
    path = scratch_path(spark, "snap")
    write_batch(spark.range(10), path, 0)
    df = spark.read.parquet(path)
    assert df.count() == 10
    write_batch(spark.range(5), path, 1)
    assert df.filter("id >= 0").count() == 10
    assert spark.read.parquet(path).count() == 15


def test_bronze_projection_from_bytes(spark):
    """PRJ1: a topic's binary value becomes the json_str text, verbatim."""
    from riskflow.sources.raw import bronze_projection
    df = spark.createDataFrame([(bytearray(b'{"a": 1}'),), (None,)], "value binary")
    assert [r[0] for r in bronze_projection(df).collect()] == ['{"a": 1}', None]
