"""Drift between the oldest 70 % and the newest 30 % of the prediction log.

The reference loads the whole log into one process and slices a list. Here the split is an
exact positional cut: it is found on a summary by buckets of time (one pass, or none where the
scoring stream has written it), and only the rows of the bucket that holds it are read and
ranked (``ordered.positional_cut``). No row is sorted globally or shuffled. A log shorter than ``min_rows`` gives an empty report, not an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import pct_change
from ..schemas import DRIFT_REPORT, PREDICTION
from .arrival import arrival_cut, cut_batch, read_manifest
from .ordered import label_first_k, order_number, positional_cut, raw_range, running_sum

# Drift parameters and metric definitions of the reference
BASELINE_FRACTION = 0.7
DRIFT_THRESHOLD_PCT = 10.0
MIN_ROWS = 20
METRICS = [
    ("avg_amount", "features.amount"),
    ("avg_tx_hour", "features.tx_hour"),
    ("avg_risk_score", "features.risk_score"),
    ("avg_fraud_probability", "prediction.fraud_probability"),
    ("fraud_prediction_rate", "prediction.prediction"),
]
GAUGE_METRICS = ["avg_amount", "avg_risk_score", "avg_fraud_probability",
                 "fraud_prediction_rate"]
RETRAIN_METRICS = ["avg_risk_score", "avg_amount"]
# The published gauge names, per metric (percent change, drift flag 0/1)
GAUGE_NAMES = {
    "avg_amount": ("fraud_avg_amount_pct_change", "fraud_avg_amount_drift_detected"),
    "avg_risk_score": ("fraud_avg_risk_score_pct_change", "fraud_avg_risk_score_drift_detected"),
    "avg_fraud_probability": ("fraud_avg_fraud_probability_pct_change",
                              "fraud_avg_fraud_probability_drift_detected"),
    "fraud_prediction_rate": ("fraud_prediction_rate_pct_change",
                              "fraud_prediction_rate_drift_detected"),
}
ORDER = ("inference_timestamp", "transaction_id")


DATE_COL = "inference_date"
BATCH_COLS = ("query_id", "batch_id")
#: Width of a summary's buckets of time.
BUCKET_SECONDS = 60
_SUMS = [f"{m}_{x}" for m, _ in METRICS for x in ("sum", "n")]


def _flat(log: DataFrame, order=ORDER) -> DataFrame:
    # only the nested leaves that are used: parquet reads just these columns; the partition
    # columns (when the log has them) let range reads prune folders
    extra = [F.col(DATE_COL)] if DATE_COL in log.columns and order[0] == ORDER[0] else []
    extra += [F.col(c) for c in BATCH_COLS if set(BATCH_COLS) <= set(log.columns)]
    return log.select(*[F.col(c) for c in order], *extra,
                      *[F.col(path).cast("double").alias(m) for m, path in METRICS])


def _materialized(flat: DataFrame, materialize: bool) -> DataFrame:
    """The report reads the log twice. A stored log is re-read cheaply (pruned columns, the
    second time one bucket of time, pushed down); a computed one (``materialize=True``) is
    checkpointed once in its flat form (Spark removes it when no longer referenced)."""
    return flat.checkpoint(eager=True) if materialize else flat


def _parts(weight) -> list:
    """Per metric the weighted sum and the weight of its values (NULL adds to neither)."""
    out = []
    for m, _ in METRICS:
        out += [(F.col(m) * weight).alias(f"{m}_sum"), F.when(F.col(m).isNotNull(), weight).alias(f"{m}_n")]
    return out


def summarise(log: DataFrame, order=ORDER, seconds: int = BUCKET_SECONDS, by: tuple = ()) -> DataFrame:
    """What the report needs of every bucket of time: (bucket, rows, and per metric the sum and
    number of its values), per ``by`` columns. Bucket NULL holds rows without a time. One pass,
    combined on the map side; the result has a row per bucket, whatever the log's rate."""
    flat = _flat(log, order)
    return _summary_of(flat, order_number(flat, order[0]), seconds, by)


def _summary_of(flat: DataFrame, t, seconds: int, by: tuple = ()) -> DataFrame:
    one = F.lit(1).cast("bigint")
    bucket = (t - F.pmod(t, F.lit(seconds * 1_000_000))).alias("bucket")
    rows = flat.select(bucket, *[F.col(c) for c in by], one.alias("rows"), *_parts(one))
    return rows.groupBy("bucket", *by).agg(*[F.sum(c).alias(c) for c in ("rows", *_SUMS)])


def baseline_count(n: int, fraction: float = BASELINE_FRACTION) -> int:
    """``int(n * fraction)`` with binary floating point, as the reference slices (90 -> 62)."""
    return int(n * fraction)


def labelled_log(log: DataFrame, fraction: float = BASELINE_FRACTION, min_rows: int = MIN_ROWS,
                 order=ORDER, materialize: bool = False, summary: DataFrame | None = None,
                 seconds: int = BUCKET_SECONDS, **cut_options):
    """(parts of the log with ``is_baseline``, ``rows`` and the sums of ``summarise``; n), or
    (None, n) below ``min_rows``.

    The cut is found on the bucket summary. Buckets on one side of it are parts as they are;
    only the rows of the bucket that holds it are read, and ranked. ``summary``: a stored
    summary (rows of ``summarise``, any number per bucket, with the batch columns of the log);
    the log then counts as far as the summary reaches. ``materialize``: the log is computed."""
    flat = _materialized(_flat(log, order), materialize)
    t = order_number(flat, order[0])
    known = summary if summary is not None else _summary_of(flat, t, seconds)
    known = known.checkpoint(eager=True)
    per = known.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("rows", *_SUMS)])
    st = per.agg(F.sum("rows").alias("n"), F.sum(F.when(F.col("bucket").isNull(), F.col("rows"))).alias("none")).first()
    n = st["n"] or 0
    if n < min_rows:
        return None, n
    if st["none"]:
        raise ValueError(f"{st['none']} log rows have a NULL {order[0]}")
    k = baseline_count(n, fraction)
    if k == 0:
        return per.withColumn("is_baseline", F.lit(False)), n
    placed = running_sum(per.select("bucket", "rows"), "bucket", ["rows"])
    at = placed.where((F.col("rows_before") < k) & (F.col("rows_before") + F.col("rows") >= k)).first()
    lo, hi = at["bucket"], at["bucket"] + seconds * 1_000_000 - 1
    date_col = DATE_COL if DATE_COL in flat.columns else None
    inside = flat.filter(raw_range(flat, order[0], lo, hi, date_col) & t.between(lo, hi))
    if summary is not None and set(BATCH_COLS) <= set(known.columns):
        # rows of batches that are not summed up yet do not count
        inside = inside.join(known.where(F.col("bucket") == lo).select(*BATCH_COLS).distinct(),
                             list(BATCH_COLS), "left_semi")
    if summary is not None:
        found = inside.count()
        if found != at["rows"]:
            raise RuntimeError(f"the log holds {found} rows of the {seconds} s from {lo} (microseconds), its summary "
                               f"says {at['rows']}: the summary was not made from this log")
    cut = positional_cut(inside, k - at["rows_before"], order[0], order[1] if len(order) > 1 else None,
                         n=at["rows"], bounds=(lo, hi), date_col=date_col, **cut_options)
    rows = label_first_k(inside, cut, "is_baseline", "_w")
    rows = rows.select("is_baseline", F.col("_w").alias("rows"), *_parts(F.col("_w")))
    whole = per.where(F.col("bucket") != lo).select((F.col("bucket") < lo).alias("is_baseline"), "rows", *_SUMS)
    return whole.unionByName(rows), n


def labelled_arrivals(spark, predictions_path: str, summary: DataFrame, fraction: float = BASELINE_FRACTION,
                      min_rows: int = MIN_ROWS):
    """As ``labelled_log``, but cut in order of arrival, from the stored log's manifest: batches
    before and after the one that holds the cut are taken from ``summary`` (rows with the batch
    columns), and only that batch is read. Batches without a manifest are not committed yet and
    do not count."""
    manifest = read_manifest(spark, predictions_path)
    n = manifest.agg(F.sum("rows")).first()[0] or 0
    if n < min_rows:
        return None, n
    batches = manifest.select(*BATCH_COLS).distinct()
    sums = (summary.join(batches, list(BATCH_COLS), "left_semi").groupBy(*BATCH_COLS)
            .agg(*[F.sum(c).alias(c) for c in ("rows", *_SUMS)]))
    k = baseline_count(n, fraction)
    if k == 0:
        return sums.withColumn("is_baseline", F.lit(False)), n
    cut = arrival_cut(manifest, k)
    here = F.struct("query_id", F.col("batch_id").cast("bigint"))
    at = F.struct(F.lit(cut.query_id), F.lit(cut.batch_id).cast("bigint"))
    whole = sums.where(here != at).select((here < at).alias("is_baseline"), "rows", *_SUMS)
    rows = cut_batch(spark, predictions_path, PREDICTION, cut)
    flat = rows.select("is_baseline", *[F.col(path).cast("double").alias(m) for m, path in METRICS])
    one = F.lit(1).cast("bigint")
    return whole.unionByName(flat.select("is_baseline", one.alias("rows"), *_parts(one))), n


def _mean(m: str, cond=None):
    """Mean of a metric over the parts where ``cond`` holds; NULL values weigh nothing."""
    total, number = F.col(f"{m}_sum"), F.col(f"{m}_n")
    if cond is not None:
        total, number = F.when(cond, total), F.when(cond, number)
    return F.sum(total) / F.sum(number)


def segment_summaries(log: DataFrame, fraction: float = BASELINE_FRACTION,
                      min_rows: int = MIN_ROWS, order=ORDER, digits: int | None = 4,
                      **cut_options) -> DataFrame:
    """One row per segment (baseline, recent): row count and the five means."""
    lab, _ = labelled_log(log, fraction, min_rows, order, **cut_options)
    cols = ["segment", "count"] + [m for m, _ in METRICS]
    if lab is None:
        return log.sparkSession.createDataFrame(
            [], "segment string, count bigint, " + ", ".join(f"{m} double" for m, _ in METRICS))
    seg = F.when(F.col("is_baseline"), F.lit("baseline")).otherwise(F.lit("recent"))
    out = lab.groupBy(seg.alias("segment")).agg(
        F.sum("rows").alias("count"), *[_mean(m).alias(m) for m, _ in METRICS])
    if digits is not None:
        out = out.select("segment", "count", *[F.round(m, digits).alias(m) for m, _ in METRICS])
    return out.select(*cols)


def _compare(lab: DataFrame, metrics: list, threshold: float) -> DataFrame:
    """Both segments' means in one pass, then one row per metric."""
    b = F.col("is_baseline")
    wide = lab.agg(*[F.coalesce(_mean(m, b), F.lit(0.0)).alias(f"b_{m}") for m in metrics],
                   *[F.coalesce(_mean(m, ~b), F.lit(0.0)).alias(f"r_{m}") for m in metrics])
    stack = "stack({}, {}) as (metric, base, recent)".format(
        len(metrics), ", ".join(f"'{m}', b_{m}, r_{m}" for m in metrics))
    long = wide.select(F.expr(stack))
    pct = pct_change(F.col("base"), F.col("recent"))
    return long.select("metric", "base", "recent",
                       (F.col("recent") - F.col("base")).alias("diff"), pct.alias("pct"),
                       (F.abs(pct) > F.lit(threshold)).alias("drift"))


def drift_report(log: DataFrame, fraction: float = BASELINE_FRACTION,
                 threshold: float = DRIFT_THRESHOLD_PCT, min_rows: int = MIN_ROWS,
                 order=ORDER, **cut_options) -> DataFrame:
    """metric, baseline, recent, diff (4 digits), pct_change (2 digits), drift_detected
    (decided on the unrounded change) for the five metrics."""
    lab, _ = labelled_log(log, fraction, min_rows, order, **cut_options)
    return _report(log.sparkSession, lab, threshold)


def arrival_report(spark, predictions_path: str, summary: DataFrame, fraction: float = BASELINE_FRACTION,
                   threshold: float = DRIFT_THRESHOLD_PCT, min_rows: int = MIN_ROWS) -> DataFrame:
    """``drift_report`` of a stored log, cut in order of arrival as the reference cuts its file."""
    lab, _ = labelled_arrivals(spark, predictions_path, summary, fraction, min_rows)
    return _report(spark, lab, threshold)


def _report(spark, lab: DataFrame | None, threshold: float) -> DataFrame:
    if lab is None:
        return spark.createDataFrame([], DRIFT_REPORT)
    c = _compare(lab, [m for m, _ in METRICS], threshold)
    return c.select("metric", F.round("base", 4).alias("baseline"),
                    F.round("recent", 4).alias("recent"), F.round("diff", 4).alias("diff"),
                    F.round("pct", 2).alias("pct_change"), F.col("drift").alias("drift_detected"))


def drift_gauges(log: DataFrame, fraction: float = BASELINE_FRACTION,
                 threshold: float = DRIFT_THRESHOLD_PCT, min_rows: int = MIN_ROWS,
                 order=ORDER, digits: int | None = None, **cut_options) -> DataFrame:
    """Gauge values: metric, pct_change (unrounded unless ``digits``), drift_detected 0/1, for
    the four monitored metrics."""
    lab, _ = labelled_log(log, fraction, min_rows, order, **cut_options)
    if lab is None:
        return log.sparkSession.createDataFrame(
            [], "metric string, pct_change double, drift_detected int")
    c = _compare(lab, GAUGE_METRICS, threshold)
    pct = F.col("pct") if digits is None else F.round("pct", digits)
    return c.select("metric", pct.alias("pct_change"),
                    F.col("drift").cast("int").alias("drift_detected"))


def gauge_rows(gauges: DataFrame) -> DataFrame:
    """Long gauge table (metric, value, computed_at) to append to a metrics table: the
    percent-change gauge and the drift-flag gauge of each metric, under the published names."""
    pct_name = F.create_map(*[x for m, (p, _) in GAUGE_NAMES.items() for x in (F.lit(m), F.lit(p))])
    flag_name = F.create_map(*[x for m, (_, d) in GAUGE_NAMES.items()
                               for x in (F.lit(m), F.lit(d))])
    named = gauges.select(pct_name[F.col("metric")].alias("pct_name"), "pct_change",
                          flag_name[F.col("metric")].alias("flag_name"), "drift_detected")
    rows = named.select(F.expr(
        "stack(2, pct_name, pct_change, flag_name, CAST(drift_detected AS DOUBLE)) "
        "AS (metric, value)"))
    return rows.select("metric", "value", F.current_timestamp().alias("computed_at"))


def drift_alerts(report: DataFrame) -> DataFrame:
    """Only the metrics that drifted, with their change."""
    return report.filter("drift_detected").select("metric", "pct_change")


def retrain_decision(report: DataFrame, metrics=tuple(RETRAIN_METRICS)) -> DataFrame:
    """One row: retrain when risk score or amount drifted (probability and rate do not count).
    Empty when the report is empty (too few predictions)."""
    m = F.col("metric").isin(list(metrics))
    return report.agg(
        F.count(F.lit(1)).alias("_n"),
        F.coalesce(F.bool_or(F.when(m, F.col("drift_detected"))), F.lit(False))
        .alias("should_retrain"),
        F.coalesce(F.bool_or(F.when(F.col("metric") == "avg_risk_score",
                                    F.col("drift_detected"))), F.lit(False))
        .alias("risk_score_drift"),
        F.coalesce(F.bool_or(F.when(F.col("metric") == "avg_amount",
                                    F.col("drift_detected"))), F.lit(False))
        .alias("amount_drift"),
    ).filter(F.col("_n") > 0).drop("_n")
