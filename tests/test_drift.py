"""Drift report: gates, split sizes, zero baseline, threshold, decision."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskflow.operators import drift


def _log(spark, amounts, risk=None, prob=None):
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i, a in enumerate(amounts):
        r = risk[i] if risk else 1.0
        p = prob[i] if prob else 0.5
        rows.append((t0 + dt.timedelta(minutes=i), f"t{i:05d}", a, 12, r, p, 1 if p >= .5 else 0))
    df = spark.createDataFrame(rows, "ts timestamp, id string, amount double, h int, "
                                     "risk double, p double, pred int")
    return df.select(
        F.col("ts").alias("inference_timestamp"), F.col("id").alias("transaction_id"),
        F.struct(F.col("amount").alias("amount"), F.col("h").alias("tx_hour"),
                 F.col("risk").alias("risk_score")).alias("features"),
        F.struct(F.col("pred").alias("prediction"),
                 F.col("p").alias("fraud_probability")).alias("prediction"))


def test_baseline_count_binary_float():
    assert drift.baseline_count(90) == 62       # int(90 * 0.7) in binary floating point
    assert drift.baseline_count(20) == 14


@pytest.mark.parametrize("n,expect", [(19, None), (20, (14, 6)), (90, (62, 28))])
def test_gate_and_sizes(spark, n, expect):
    seg = drift.segment_summaries(_log(spark, [float(i) for i in range(n)]))
    rows = {r["segment"]: r["count"] for r in seg.collect()}
    if expect is None:
        assert rows == {}
        assert drift.drift_report(_log(spark, [1.0] * n)).count() == 0
        assert drift.retrain_decision(drift.drift_report(_log(spark, [1.0] * n))).count() == 0
    else:
        assert (rows["baseline"], rows["recent"]) == expect


def test_zero_baseline_and_threshold(spark):
    # amount: baseline 100 -> recent 110 is exactly +10 %: not drift
    amounts = [100.0] * 14 + [110.0] * 6
    risk = [0.0] * 14 + [2.0] * 6         # zero baseline: pct 0, no drift
    rep = {r["metric"]: r for r in drift.drift_report(_log(spark, amounts, risk)).collect()}
    assert rep["avg_amount"]["pct_change"] == 10.0 and not rep["avg_amount"]["drift_detected"]
    assert rep["avg_risk_score"]["pct_change"] == 0.0
    assert not rep["avg_risk_score"]["drift_detected"]
    amounts2 = [100.0] * 14 + [110.01] * 6
    rep2 = {r["metric"]: r for r in drift.drift_report(_log(spark, amounts2)).collect()}
    assert rep2["avg_amount"]["drift_detected"]


def test_decision_ignores_probability(spark):
    prob = [0.2] * 14 + [0.9] * 6
    rep = drift.drift_report(_log(spark, [100.0] * 20, prob=prob))
    d = drift.retrain_decision(rep).first()
    assert not d["should_retrain"]
    alerts = {r["metric"] for r in drift.drift_alerts(rep).collect()}
    assert "avg_fraud_probability" in alerts
    rep2 = drift.drift_report(_log(spark, [100.0] * 14 + [150.0] * 6))
    assert drift.retrain_decision(rep2).first()["should_retrain"]


def test_gauges_unrounded(spark):
    g = {r["metric"]: r for r in
         drift.drift_gauges(_log(spark, [3.0] * 14 + [4.0] * 6)).collect()}
    assert set(g) == set(drift.GAUGE_METRICS)
    assert g["avg_amount"]["pct_change"] == pytest.approx(100 / 3)
    assert g["avg_amount"]["drift_detected"] == 1


def test_partition_independent(spark):
    log = _log(spark, [float(i % 13) for i in range(300)])
    a = sorted(drift.segment_summaries(log).collect())
    b = sorted(drift.segment_summaries(log.repartition(7)).collect())
    assert a == b


def test_partitioned_log_prunes_and_matches(spark):
    """A stored log partitioned by inference_date gives the same report, and the selection
    passes carry a partition filter."""
    from riskflow.operators.ordered import raw_range
    from riskflow.session import scratch_path
    log = _log(spark, [float(i % 17) for i in range(400)])
    path = scratch_path(spark, "plog")
    log.withColumn("inference_date", F.to_date("inference_timestamp")) \
        .write.partitionBy("inference_date").parquet(path)
    stored = spark.read.parquet(path)
    assert "inference_date" in stored.columns
    a = sorted(drift.drift_report(log).collect())
    b = sorted(drift.drift_report(stored).collect())
    assert a == b
    lo = 1704067200 * 1_000_000
    plan = stored.filter(raw_range(stored, "inference_timestamp", lo, lo + 3_600_000_000,
                                   "inference_date"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(inference_date" in plan


def test_report_from_stored_summaries(spark):
    """Sums written per batch give the same report as the log; rows of a batch that is not
    summed up yet do not count; the raw log is read inside one bucket of time only."""
    import datetime as dt
    from riskflow.session import scratch_path
    amounts = [float(i % 17) for i in range(300)]
    log = _log(spark, amounts, prob=[(i % 10) / 10 for i in range(300)])
    path = scratch_path(spark, "summaries")
    n = (F.unix_timestamp("inference_timestamp") / 60).cast("long") % 2
    for b in (0, 1):
        part = log.filter(n == b)
        part.write.parquet(f"{path}/log/query_id=q/batch_id={b}")
        drift.summarise(part, seconds=1800).write.parquet(f"{path}/sums/query_id=q/batch_id={b}")
    extra = log.withColumn("inference_timestamp", F.col("inference_timestamp") + F.lit(dt.timedelta(seconds=5)))
    extra.write.parquet(f"{path}/log/query_id=q/batch_id=2")
    stored, sums = spark.read.parquet(f"{path}/log"), spark.read.parquet(f"{path}/sums")
    want = sorted(map(tuple, drift.drift_report(log).collect()))
    assert sorted(map(tuple, drift.drift_report(log, seconds=1800, exact_limit=4).collect())) == want
    got = drift.drift_report(stored, summary=sums, seconds=1800)
    assert sorted(map(tuple, got.collect())) == want


def test_null_metric_weighs_nothing(spark):
    log = _log(spark, [100.0 if i % 2 else None for i in range(40)])
    seg = {r["segment"]: r["avg_amount"] for r in drift.segment_summaries(log).collect()}
    assert seg == {"baseline": 100.0, "recent": 100.0}
