"""The named queries: one callable (spark, sf_dir) -> DataFrame per operator family of the
survey's verification map. ``oracle.py`` holds the matching DuckDB SQL. Every computed column
is aliased to the name the oracle uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import (ONLINE, gold_features, online_features, rule_score, rule_tier,
                                  rule_tier_rate, store_features)
from ..operators import contract, drift, metrics, registry, scoring, silver, training
from ..schemas import MODEL_FEATURES, MODEL_RUNS, TRANSACTION
from ..session import remove_path, scratch_path
from ..sources.events import raw_events
from ..sources.raw import bronze_projection, read_raw, read_raw_stream
from ..sources.tables import read_features, read_predictions
from ..streaming.medallion import bronze_query, gold_query, silver_query
from ..streaming.scoring import ChampionLoader, scoring_query, scoring_writer, summary_path
from . import derived as D


def _flat_location(df: DataFrame) -> DataFrame:
    cols = []
    for c in df.columns:
        if c == "location":
            cols += [F.col("location.city").alias("location_city"),
                     F.col("location.state").alias("location_state"),
                     F.col("location.country").alias("location_country")]
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def _reasons_text(c) -> F.Column:
    return F.array_join(c, ",")


# --- sources / silver -------------------------------------------------------------------

def bronze_json(spark, sf_dir):
    """PRJ1, FN16, SNK13: the raw text per event."""
    return D.raw(spark, sf_dir).select("event_id", "json_str")


def silver_valid(spark, sf_dir):
    """PRJ2, PRJ3, FLT1: parsed, valid transactions."""
    return _flat_location(silver.flatten_valid(D.parsed(spark, sf_dir)))


def silver_quarantine_reasons(spark, sf_dir):
    """FLT2, PRJ4: rejected rows with their text and reasons."""
    q = silver.quarantine(D.parsed(spark, sf_dir), keep=("data",))
    return q.select(F.col("data.transaction_id").alias("transaction_id"),
                    _reasons_text(F.col("reasons")).alias("reasons"), "json_str")


def silver_partition_counts(spark, sf_dir):
    """FLT1 + FLT2: valid + quarantine = input."""
    return silver.silver_counts(D.raw(spark, sf_dir))


# --- features -----------------------------------------------------------------------------

def features_gold(spark, sf_dir):
    """PRJ5, PRJ6, FN1, FN2, FN5-FN9: gold features of valid rows (timestamp as NTZ)."""
    g = gold_features(silver.flatten_valid(D.parsed(spark, sf_dir)))
    return g.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def features_store(spark, sf_dir):
    """PRJ7, FN3, FN10: feature-store records that pass the contract."""
    return D.feature_store(spark, sf_dir)


def features_online(spark, sf_dir):
    """PRJ8, FN4: online scorer's inputs for every raw row."""
    return online_features(D.parsed_fields(spark, sf_dir))


def rule_tiers(spark, sf_dir):
    """PRJ9: simulator rule score and tiers vs the labels."""
    t = D.transactions(spark, sf_dir)
    s = rule_score()
    x = t.select(s.alias("rule_score"), F.col("is_fraud"))
    return (x.groupBy("rule_score")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.round(F.avg("is_fraud"), 4).alias("fraud_rate"))
            .select("rule_score", rule_tier(F.col("rule_score")).alias("rule_tier"),
                    rule_tier_rate(rule_tier(F.col("rule_score"))).alias("expected_rate"),
                    "rows", "fraud_rate"))


# --- contract / scoring input ------------------------------------------------------------

def feature_contract_violations(spark, sf_dir):
    """FLT3, FLT4: rejected feature records and the keys that failed."""
    _, bad = contract.split_contract(store_features(D.store_input(spark, sf_dir)))
    return bad.select("transaction_id", _reasons_text(F.col("violations")).alias("violations"))


def scoring_input_rejects(spark, sf_dir):
    """FLT5, FLT6, PRJ10: scoring payloads that cannot be scored."""
    on = online_features(D.parsed_fields(spark, sf_dir))
    _, bad = contract.split_model_input(on)
    return bad.select("transaction_id", _reasons_text(F.col("violations")).alias("violations"))


# --- prediction records ------------------------------------------------------------------

def prediction_record_short(spark, sf_dir):
    """PRJ11, PRJ18: feature consumer's record (store features, rule stand-in), flattened."""
    fs = D.feature_store(spark, sf_dir)
    payload = fs.select("transaction_id", *MODEL_FEATURES)
    rec = scoring.short_record(scoring.rule_model_score(payload))
    return rec.select("transaction_id", *[F.col(f"features.{c}").alias(c) for c in MODEL_FEATURES],
                      *[F.col(f"prediction.{c}").alias(c) for c in scoring.SCORE_COLS])


def prediction_record_rich(spark, sf_dir):
    """PRJ12-14, PRJ18, FN15: scorer's rich record, flattened (inference time as NTZ)."""
    log = D.scored_log(spark, sf_dir)
    return log.select(
        F.col("inference_timestamp").cast("timestamp_ntz").alias("inference_timestamp"),
        "model_run_id", "transaction_id",
        F.col("transaction.user_id").alias("user_id"),
        F.col("transaction.payment_method").alias("payment_method"),
        F.col("transaction.card_present").alias("card_present"),
        *[F.col(f"features.{c}").alias(c) for c in MODEL_FEATURES],
        *[F.col(f"prediction.{c}").alias(c) for c in scoring.SCORE_COLS])


# --- training / evaluation ---------------------------------------------------------------

def training_frame(spark, sf_dir):
    """PRJ15-17: model inputs + label, no NULLs."""
    return training.training_frame(D.feature_store(spark, sf_dir), keep=("transaction_id",))


def hash_split_counts(spark, sf_dir):
    """SMP1: 80/20 split by key hash, rows and positives per side."""
    tf = training.training_frame(D.feature_store(spark, sf_dir), keep=("transaction_id",))
    side = F.when(training.split_bucket() < 8, "train").otherwise("test")
    return tf.groupBy(side.alias("split")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"))


def _eval_frame(spark, sf_dir):
    tf = training.training_frame(D.feature_store(spark, sf_dir), keep=("transaction_id",))
    _, test = training.hash_split(tf)
    return test.select("label", (F.col("risk_score") / 3.0).alias("score"),
                       F.when(F.col("risk_score") >= 2, 1.0).otherwise(0.0).alias("prediction"))


def eval_auc(spark, sf_dir):
    """AGG5: exact ROC AUC of the rule stand-in on the held-out split."""
    return metrics.auc_exact(_eval_frame(spark, sf_dir), "label", "score") \
        .select(F.round("auc", 6).alias("auc"))


def daily_auc(spark, sf_dir):
    """AGG5, REG2: exact ROC AUC of every daily run, keyed by day."""
    fs = D.feature_store(spark, sf_dir).select(
        F.substring("timestamp", 1, 10).alias("day"), F.col("is_fraud").cast("double").alias("label"),
        (F.col("risk_score") * 1000000 + F.col("amount")).alias("score"))
    per_day = metrics.auc_exact(fs.filter(F.try_to_date("day").isNotNull()), by=("day",))
    return per_day.select(F.concat(F.lit("run-"), F.col("day")).alias("run_id"), F.round("auc", 6).alias("auc"))


def eval_f1(spark, sf_dir):
    """AGG6: class-weighted F1 on the held-out split."""
    return metrics.weighted_f1(_eval_frame(spark, sf_dir)).select(F.round("f1", 6).alias("f1"))


def eval_accuracy(spark, sf_dir):
    """AGG7: accuracy on the held-out split."""
    return metrics.accuracy(_eval_frame(spark, sf_dir)) \
        .select(F.round("accuracy", 6).alias("accuracy"))


# --- drift -------------------------------------------------------------------------------

#: Rows that the cut ranks at last: small, so that the range passes run at every size.
CUT_ROWS = 256
_CUT = {"materialize": True, "exact_limit": CUT_ROWS}
#: A threshold that several metrics exceed in the derived log (the default is 10 %).
LOW_THRESHOLD_PCT = 1.0


def drift_segments(spark, sf_dir):
    """WIN1, AGG1-AGG3, FN14: 70/30 positional split of the log and the segment summaries."""
    return drift.segment_summaries(D.scored_log(spark, sf_dir), **_CUT)


def drift_report(spark, sf_dir):
    """DRF1, DRF2, FN11-FN13, FN20, FN21."""
    return drift.drift_report(D.scored_log(spark, sf_dir), **_CUT)


def drift_gauges(spark, sf_dir):
    """DRF3, AGG4: gauge values (pct change published to 6 digits here)."""
    return drift.drift_gauges(D.scored_log(spark, sf_dir), digits=6, **_CUT)


def drift_alerts(spark, sf_dir):
    """DRF5: only the drifted metrics."""
    return drift.drift_alerts(drift_report(spark, sf_dir))


def retrain_decision(spark, sf_dir):
    """DRF4, AGG8: retrain when risk score or amount drifted."""
    return drift.retrain_decision(drift_report(spark, sf_dir))


def _low_report(spark, sf_dir):
    return drift.drift_report(D.scored_log(spark, sf_dir), threshold=LOW_THRESHOLD_PCT, **_CUT)


def drift_alerts_1pct(spark, sf_dir):
    """DRF5, FN12 with metrics that drift."""
    return drift.drift_alerts(_low_report(spark, sf_dir))


def retrain_decision_1pct(spark, sf_dir):
    """DRF4, AGG8 with metrics that drift."""
    return drift.retrain_decision(_low_report(spark, sf_dir))


def drift_gauges_1pct(spark, sf_dir):
    """DRF3, SNK11 with flags that are set."""
    return drift.drift_gauges(D.scored_log(spark, sf_dir), digits=6, threshold=LOW_THRESHOLD_PCT, **_CUT)


def drift_min_rows(spark, sf_dir):
    """LIM2: a log below the least number of rows has an empty report, not an error."""
    log = D.scored_log(spark, sf_dir)
    report = drift.drift_report(log, min_rows=10 ** 15, **_CUT)
    return log.agg(F.count(F.lit(1)).alias("log_rows")).crossJoin(
        report.agg(F.count(F.lit(1)).alias("report_rows")))


# --- registry ----------------------------------------------------------------------------

def champion_history(spark, sf_dir):
    """WIN2, REG3, REG4: daily candidate runs and which were promoted."""
    h = registry.champion_history(D.daily_runs(spark, sf_dir))
    return h.select("model_name", "version", "run_id",
                    F.round("f1_score", 6).alias("f1_score"),
                    F.round("champion_f1_before", 6).alias("champion_f1_before"), "promoted")


def current_champion(spark, sf_dir):
    """REG3, REG4, SRC10: the version the champion alias points to after the daily runs."""
    c = registry.current_champion(D.daily_runs(spark, sf_dir))
    return c.select("model_name", "version", "run_id", F.round("f1_score", 6).alias("f1_score"))


def drift_gauge_rows(spark, sf_dir):
    """SNK11: the gauge table rows (metric, value) a refresh appends (time column left out)."""
    g = drift.gauge_rows(drift.drift_gauges(D.scored_log(spark, sf_dir), **_CUT))
    return g.select("metric", F.round("value", 6).alias("value"))


def latest_version(spark, sf_dir):
    """SRT1, FLT7, REG5: newest version of each weekly run (versions are numbers)."""
    runs = D.daily_runs(spark, sf_dir)
    weekly = runs.withColumn("run_id", F.concat(F.lit("week-"),
                                                F.date_format(F.date_trunc("week", "day"),
                                                              "yyyy-MM-dd")))
    return registry.latest_version(weekly)


def registry_cycle(spark, sf_dir):
    """REG1-REG5, SRC10, SNK10, FLT7: runs written to the runs table, one more registered, and
    read back: the newest version of that run, the next version and the champion."""
    root = scratch_path(spark, "registry_cycle")
    path = f"{root}/runs"
    daily = D.daily_runs(spark, sf_dir)
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in daily.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in MODEL_RUNS.fields]
    daily.select(*cols).write.parquet(path)
    f1 = metrics.weighted_f1(_eval_frame(spark, sf_dir)).first()["f1"]
    registry.register_run(spark, path, D.MODEL_NAME, "run-all", {"f1_score": f1},
                          registry.run_params(MODEL_FEATURES), None, candidate=True)
    runs = registry.read_runs(spark, path)
    champion = registry.current_champion(runs).select(
        F.col("version").alias("champion_version"), F.col("run_id").alias("champion_run"), "model_name")
    newest = registry.latest_version(runs, run_id="run-all")
    out = newest.join(champion, "model_name").select(
        "run_id", "latest_version", F.lit(registry.next_version(runs, D.MODEL_NAME)).alias("next_version"),
        "champion_version", "champion_run")
    return _kept(spark, out, root)


def store_training_frame(spark, sf_dir):
    """SRC6, SRC7: the training frame read from a stored feature table."""
    root = scratch_path(spark, "store_training_frame")
    D.feature_store(spark, sf_dir).write.parquet(f"{root}/features")
    tf = training.training_frame(read_features(spark, f"{root}/features"), keep=("transaction_id",))
    return _kept(spark, tf, root)


def _kept(spark, df, root):
    """``df`` in the checkpoint folder, after which the scratch tables it was read from go."""
    out = df.checkpoint(eager=True)
    remove_path(spark, root)
    return out


# --- model (Spark ML) --------------------------------------------------------------------

def _fit(spark, sf_dir):
    # the labelled rows are derived once: the forest reads its input several times (metadata,
    # split candidates, bagging), and the held-out side is read again
    tf = training.training_frame(D.feature_store(spark, sf_dir), keep=("transaction_id",)) \
        .checkpoint(eager=True)
    train, test = training.hash_split(tf)
    return training.fit_model(train.drop("transaction_id")), train, test


def scored_sample(spark, sf_dir):
    """LIM1, ML1-ML4, PRJ19, FN18, FN19: 20 scored held-out rows. Of the forest's answers, what
    any forest must satisfy is returned."""
    model, _, test = _fit(spark, sf_dir)
    p = F.col("probability")
    return training.scored_sample(model, test).select(
        "transaction_id", "label", "amount", "risk_score",
        (F.abs(p[0] + p[1] - 1) < 1e-9).alias("probabilities_sum_to_1"),
        (F.col("prediction") == F.when(p[1] > p[0], 1).otherwise(0)).alias("prediction_follows"))


def rf_metrics(spark, sf_dir):
    """ML1-ML5, REG1, REG2, FN22: fit the forest, evaluate on the held-out split; F1 and
    accuracy are held against Spark ML's evaluators."""
    model, train, test = _fit(spark, sf_dir)
    m, check = training.evaluate(model, test), metrics.evaluator_metrics(model.transform(test))
    params = registry.run_params(MODEL_FEATURES)

    def side(df, name):
        return df.agg(F.count(F.lit(1)).alias(f"{name}_rows"), F.sum("label").alias(f"{name}_positives"))

    same = {k: abs(m[v] - check[v]) < 1e-9 for k, v in (("f1", "f1_score"), ("accuracy", "accuracy"))}
    return side(train, "train").crossJoin(side(test, "test")).select(
        "*", *[F.lit(params[k]).alias(k) for k in ("num_trees", "max_depth", "feature_cols")],
        F.lit(same["f1"]).alias("f1_is_evaluators"), F.lit(same["accuracy"]).alias("accuracy_is_evaluators"),
        F.lit(0.0 <= m["auc"] <= 1.0).alias("auc_in_range"))


QUERIES = {
    "bronze_json": bronze_json,
    "silver_valid": silver_valid,
    "silver_quarantine_reasons": silver_quarantine_reasons,
    "silver_partition_counts": silver_partition_counts,
    "features_gold": features_gold,
    "features_store": features_store,
    "features_online": features_online,
    "rule_tiers": rule_tiers,
    "feature_contract_violations": feature_contract_violations,
    "scoring_input_rejects": scoring_input_rejects,
    "prediction_record_short": prediction_record_short,
    "prediction_record_rich": prediction_record_rich,
    "training_frame": training_frame,
    "hash_split_counts": hash_split_counts,
    "eval_auc": eval_auc,
    "daily_auc": daily_auc,
    "eval_f1": eval_f1,
    "eval_accuracy": eval_accuracy,
    "drift_segments": drift_segments,
    "drift_report": drift_report,
    "drift_gauges": drift_gauges,
    "drift_alerts": drift_alerts,
    "retrain_decision": retrain_decision,
    "champion_history": champion_history,
    "latest_version": latest_version,
    "current_champion": current_champion,
    "drift_gauge_rows": drift_gauge_rows,
    "scored_sample": scored_sample,
    "rf_metrics": rf_metrics,
    "drift_alerts_1pct": drift_alerts_1pct,
    "retrain_decision_1pct": retrain_decision_1pct,
    "drift_gauges_1pct": drift_gauges_1pct,
    "drift_min_rows": drift_min_rows,
    "registry_cycle": registry_cycle,
    "store_training_frame": store_training_frame,
}


# --- streams (availableNow runs over files in the shared checkpoint folder) --------------

#: Bound of a micro-batch of the registered streams.
BATCH_BYTES = 8 << 30
_NOW = {"availableNow": True}


def _publish_bronze(spark, sf_dir, root, condition=None, name="bronze"):
    """Producer side (SNK13): raw text written as bronze JSON lines, by the scan's partitions."""
    path = f"{root}/{name}"
    rows = D.raw(spark, sf_dir)
    (rows if condition is None else rows.where(condition)).select("json_str").write \
        .option("ignoreNullFields", "false").json(path)
    return path


def _run_silver(spark, sf_dir, root, condition=None, name=""):
    bronze = _publish_bronze(spark, sf_dir, root, condition, f"bronze{name}")
    silver_query(spark, bronze, f"{root}/silver", f"{root}/quarantine", f"{root}/_chk/silver{name}",
                 trigger=_NOW, max_bytes_per_trigger=BATCH_BYTES).awaitTermination()


def _silver_rows(spark, root):
    df = spark.read.schema(TRANSACTION).option("recursiveFileLookup", "true").parquet(f"{root}/silver")
    return _kept(spark, _flat_location(df), root)


def stream_silver(spark, sf_dir):
    """SRC4, SNK2, STR1-STR5: bronze files -> silver stream (one parse per batch)."""
    root = scratch_path(spark, "stream_silver")
    _run_silver(spark, sf_dir, root)
    return _silver_rows(spark, root)


def stream_two_writers(spark, sf_dir):
    """SNK2, STR7: two queries with checkpoints of their own write one table; both number
    their batches from 0."""
    root = scratch_path(spark, "stream_two_writers")
    _run_silver(spark, sf_dir, root, F.col("event_id") % 2 == 0, "_a")
    _run_silver(spark, sf_dir, root, F.col("event_id") % 2 != 0, "_b")
    return _silver_rows(spark, root)


def stream_quarantine(spark, sf_dir):
    """SNK3: the silver stream's quarantine, with the text."""
    root = scratch_path(spark, "stream_quarantine")
    _run_silver(spark, sf_dir, root)
    q = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/quarantine")
    parsed = silver.parse_raw(q)
    return _kept(spark, parsed.select(F.col("data.transaction_id").alias("transaction_id"),
                                      _reasons_text(F.col("reasons")).alias("reasons"), "json_str"), root)


def stream_bronze(spark, sf_dir):
    """SRC1-SRC3's projection, PRJ1, SNK1: message bytes -> text -> bronze file sink."""
    root = scratch_path(spark, "stream_bronze")
    D.raw(spark, sf_dir).select(F.encode("json_str", "UTF-8").alias("value")).write.parquet(f"{root}/topic")
    topic = spark.readStream.schema("value binary").parquet(f"{root}/topic")
    bronze_query(bronze_projection(topic), f"{root}/bronze", f"{root}/_chk", trigger=_NOW).awaitTermination()
    return _kept(spark, read_raw(spark, "json", f"{root}/bronze"), root)


def _run_gold(spark, root):
    gold_query(spark, f"{root}/silver", f"{root}/gold", f"{root}/_chk/gold", trigger=_NOW).awaitTermination()


def _gold_rows(spark, root):
    g = spark.read.parquet(f"{root}/gold").drop("query_id", "batch_id")
    return _kept(spark, g.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), root)


def stream_gold(spark, sf_dir):
    """SRC5, SNK4: committed silver batches -> gold stream."""
    root = scratch_path(spark, "stream_gold")
    _run_silver(spark, sf_dir, root)
    _run_gold(spark, root)
    return _gold_rows(spark, root)


def stream_gold_replay(spark, sf_dir):
    """STR5, STR7: all announcements are replayed by a second gold query on a checkpoint of its
    own; output is filed under silver's ids, so every row is there once."""
    root = scratch_path(spark, "stream_gold_replay")
    _run_silver(spark, sf_dir, root)
    _run_gold(spark, root)
    gold_query(spark, f"{root}/silver", f"{root}/gold", f"{root}/_chk/gold_again", trigger=_NOW).awaitTermination()
    return _gold_rows(spark, root)


def _run_scoring(spark, sf_dir, root, **options):
    bronze = _publish_bronze(spark, sf_dir, root)
    raw = read_raw_stream(spark, "json", bronze, maxBytesPerTrigger=BATCH_BYTES)
    scoring_query(raw, f"{root}/features", f"{root}/predictions", f"{root}/rejects",
                  f"{root}/_chk/scoring", trigger=_NOW, **options).awaitTermination()


def stream_scored(spark, sf_dir):
    """SRC2/SRC3 (file source), ML7, SNK8, STR6, STR7: the second consumer: raw stream ->
    online features -> input check -> score -> rich prediction log."""
    root = scratch_path(spark, "stream_scored")
    _run_scoring(spark, sf_dir, root, spec=ONLINE)
    log = spark.read.parquet(f"{root}/predictions")
    return _kept(spark, log.select(
        "model_run_id", "transaction_id",
        F.col("transaction.user_id").alias("user_id"),
        F.col("transaction.payment_method").alias("payment_method"),
        F.col("transaction.card_present").alias("card_present"),
        *[F.col(f"features.{c}").alias(c) for c in MODEL_FEATURES],
        *[F.col(f"prediction.{c}").alias(c) for c in scoring.SCORE_COLS]), root)


def stream_scored_store(spark, sf_dir):
    """ML7, SNK5/SNK6's record: the first consumer: raw stream -> store features -> contract ->
    score on those features -> short record."""
    root = scratch_path(spark, "stream_scored_store")
    _run_scoring(spark, sf_dir, root, record="short")
    log = spark.read.parquet(f"{root}/predictions")
    return _kept(spark, log.select(
        "transaction_id", *[F.col(f"features.{c}").alias(c) for c in MODEL_FEATURES],
        *[F.col(f"prediction.{c}").alias(c) for c in scoring.SCORE_COLS]), root)


def stream_features(spark, sf_dir):
    """SNK7: the feature store that the scoring stream writes."""
    root = scratch_path(spark, "stream_features")
    _run_scoring(spark, sf_dir, root)
    rows = read_features(spark, f"{root}/features").select(*contract.FEATURE_KEYS)
    return _kept(spark, rows, root)


def stream_rejects(spark, sf_dir):
    """FLT4, FLT6: rejects keep the text; without a champion every scorable row is there too."""
    root = scratch_path(spark, "stream_rejects")
    _run_scoring(spark, sf_dir, root, champion=ChampionLoader(spark, f"{root}/runs", D.MODEL_NAME))
    r = spark.read.parquet(f"{root}/rejects")
    return _kept(spark, r.select("transaction_id", "stage", _reasons_text(F.col("violations")).alias("violations"),
                                 "json_str"), root)


def stream_drift_report(spark, sf_dir):
    """DRF2, STR6: the scoring stream replays history (inference at the event's time) and keeps sums
    of every batch; the report takes them and reads only the minute that holds the cut."""
    root = scratch_path(spark, "stream_drift_report")
    _run_scoring(spark, sf_dir, root, spec=ONLINE, inference_ts=F.try_to_timestamp("timestamp"))
    log = read_predictions(spark, f"{root}/predictions")
    report = drift.drift_report(log, summary=spark.read.parquet(summary_path(f"{root}/predictions")), exact_limit=CUT_ROWS)
    return _kept(spark, report, root)


#: Batches that the log of ``drift_report_arrival`` arrives in, and events of one task (and file) of a batch.
ARRIVALS, ARRIVAL_ROWS = 4, 1 << 17


def _arrivals(events):
    """Raw texts in order of their event's id, one frame per batch (an equal range of ids). Only the table's own
    columns are sampled and shuffled; texts are made behind the shuffle, by as many tasks as the batch needs."""
    lo, hi = events.agg(F.min("event_id"), F.max("event_id")).first()
    lo = lo or 0
    width = -(-((hi or 0) - lo + 1) // ARRIVALS)
    batch = F.floor((F.col("event_id").cast("double") - float(lo)) / width).cast("int")
    sizes = dict(events.where("event_id IS NOT NULL").groupBy(batch).count().collect())
    for i in range(ARRIVALS):
        part = events.where(F.col("event_id").between(lo + i * width, lo + (i + 1) * width - 1))
        tasks = max(events.sparkSession.sparkContext.defaultParallelism, -(-sizes.get(i, 0) // ARRIVAL_ROWS))
        yield raw_events(part.repartitionByRange(tasks, "event_id").sortWithinPartitions("event_id")).select("json_str")


def drift_report_arrival(spark, sf_dir):
    """WIN1, DRF1: events arrive in order of their id, in batches; the log is cut in order of
    arrival, from the manifest."""
    root = scratch_path(spark, "drift_report_arrival")
    write = scoring_writer(f"{root}/features", f"{root}/predictions", f"{root}/rejects", spec=ONLINE)
    for i, texts in enumerate(_arrivals(D.events(spark, sf_dir))):
        write(texts, i)
    summary = spark.read.parquet(summary_path(f"{root}/predictions"))
    return _kept(spark, drift.arrival_report(spark, f"{root}/predictions", summary), root)


def drift_report_json(spark, sf_dir):
    """SRC8, FN16: the log as a file of JSON lines with blank lines between them, read back."""
    root = scratch_path(spark, "drift_report_json")
    lines = scoring.to_json_value(D.scored_log(spark, sf_dir))
    blank = F.explode(F.array(F.col("value"), F.lit(""))).alias("value")
    lines.select(blank).write.text(f"{root}/predictions")
    log = read_predictions(spark, f"{root}/predictions", fmt="json")
    return _kept(spark, drift.drift_report(log, **_CUT), root)


QUERIES.update({f.__name__: f for f in (
    stream_drift_report, drift_report_arrival, drift_report_json,
    stream_silver, stream_two_writers, stream_quarantine, stream_bronze, stream_gold, stream_gold_replay,
    stream_scored, stream_scored_store, stream_features, stream_rejects)})
