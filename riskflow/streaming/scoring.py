"""Streaming scoring: raw events -> features -> contract -> model -> feature store, prediction
log and rejects, in one query.

Replaces the reference's per-message consumers that call a scoring service once per event:
here the fitted pipeline is applied to whole micro-batches on the executors. The champion is
looked up once per micro-batch and reloaded only when its version changes.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.features import (ONLINE, STORE, FeatureSpec, model_input_columns,
                                  online_features, store_features)
from ..operators import arrival, contract, drift, registry, scoring, silver
from ..schemas import TRANSACTION
from .sinks import apply_trigger, batch_folder, query_id, write_batch, write_kafka

# Topic names of the reference's deployment
RAW_TOPIC = "transactions_raw"
PREDICTION_TOPIC = "fraud_predictions"

_TX_FIELDS = tuple(f.name for f in TRANSACTION.fields)
_KEEP = tuple(c for c in _TX_FIELDS if c != "amount")


class ChampionLoader:
    """Current champion of ``model_name`` from the runs table; cached per version."""

    def __init__(self, spark: SparkSession, runs_path: str, model_name: str):
        self.spark, self.runs_path, self.model_name = spark, runs_path, model_name
        self._version, self._model, self._run_id = None, None, None

    def get(self):
        champ = registry.current_champion(registry.read_runs(self.spark, self.runs_path)) \
            .filter(F.col("model_name") == self.model_name) \
            .select("version", "run_id", "model_path").first()
        if champ is None:
            return None, None
        if champ["version"] != self._version:
            self._model = PipelineModel.load(champ["model_path"])
            self._version, self._run_id = champ["version"], champ["run_id"]
        return self._model, self._run_id


def summary_path(predictions_path: str) -> str:
    """Where the sums per batch and bucket of time of a prediction log are."""
    return f"{predictions_path.rstrip('/')}_summary"


def parse_fields(batch: DataFrame) -> DataFrame:
    """Raw text -> one row of transaction fields per message (NULLs where parsing failed),
    plus the feature store's own reading and the text itself."""
    return silver.consumer_fields(silver.parse_raw(batch), keep=("json_str",))


def _scorable(fields: DataFrame, spec: FeatureSpec):
    """(rows whose ``spec`` features can be scored, with the transaction fields; rows that
    cannot be, with ``violations``). The store preset takes rows that pass the feature
    contract, so the model sees exactly what it was trained on; the online preset takes rows
    that pass the scorer's input check."""
    keep = ("json_str", *_KEEP)
    if spec.name == STORE.name:
        view = silver.store_view(fields)
        flat = view.select(*[F.col(c) for c in keep], *model_input_columns(spec))
        ok = contract.passes(contract.FEATURE_KEYS)
        return flat.filter(ok), flat.filter(~ok).withColumn("violations", contract.violations(contract.FEATURE_KEYS))
    if spec.name == ONLINE.name:
        return contract.split_model_input(online_features(fields, keep=keep), keep=keep)
    raise ValueError(f"no consumer scores the {spec.name} preset")


def score_batch(fields: DataFrame, model=None, run_id: str | None = None,
                inference_ts=None, spec: FeatureSpec = STORE, record: str = "rich",
                can_score: bool = True):
    """(feature-store rows, prediction records, rejects) from parsed transaction fields.

    ``spec`` is the preset that is scored: ``store`` (default) is the one that training reads;
    ``online`` is the second consumer's. ``record``: "rich" or "short". Rejects keep the text
    and say at which stage a row left: ``feature_contract``, ``scoring_input``, or
    ``no_champion`` when ``can_score`` is false and a row would otherwise be scored."""
    store = store_features(silver.store_view(fields), keep=("json_str",))
    store_ok, store_bad = contract.split_contract(store, keep=("json_str",))
    ok, bad = _scorable(fields, spec)

    def stage(df, name, violations="violations"):
        return df.select("transaction_id", F.lit(name).alias("stage"), violations, "json_str")

    rejects = stage(store_bad, "feature_contract")
    if spec.name != STORE.name:
        rejects = rejects.unionByName(stage(bad, "scoring_input"))
    if not can_score:
        none = F.array().cast("array<string>").alias("violations")
        rejects = rejects.unionByName(stage(ok, "no_champion", none))
    scored = scoring.score(ok, model) if model is not None else scoring.rule_model_score(ok)
    records = (scoring.short_record(scored) if record == "short"
               else scoring.rich_record(scored, run_id=run_id, inference_ts=inference_ts))
    return store_ok.drop("json_str"), records, rejects


def scoring_writer(feature_store_path: str, predictions_path: str, rejects_path: str,
                   champion: ChampionLoader | None = None, kafka: dict | None = None,
                   partition_by_date: bool = False, spec: FeatureSpec = STORE,
                   record: str = "rich", inference_ts=None):
    """foreachBatch function. Feature rows are written before scoring, so they survive a
    failed scoring step; every output is keyed by query and batch, so a replay is idempotent.

    With a ``champion`` loader and no champion yet, features and rejects are still written and
    nothing is scored (the reference's service answers "model not available"): the rows go to
    the rejects, with their text, as ``no_champion``. Without a loader the rule stand-in scores.

    ``partition_by_date`` adds ``inference_date`` / ``event_date`` folders below each batch.
    Off by default: one micro-batch stamps one inference time, so each batch's files already
    carry tight min/max statistics for the time range; dates pay off for a replay of history
    (many dates per batch) only when readers filter by them.

    What follows a batch's predictions (sums, manifest, topic) is made from the committed folder as
    read back, so a replay after a crash between the two repeats the stored records, with their
    times. ``inference_ts``: see ``score_batch``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # parsed once per micro-batch; the three outputs read the persisted fields
        fields = parse_fields(batch).persist()
        try:
            model, run_id = champion.get() if champion is not None else (None, None)
            can_score = champion is None or model is not None
            feats, records, rejects = score_batch(fields, model, run_id, inference_ts, spec=spec,
                                                  record=record, can_score=can_score)
            if partition_by_date:
                feats = feats.withColumn("event_date",
                                         F.to_date(F.try_to_timestamp("timestamp")))
            write_batch(feats, feature_store_path, batch_id,
                        partition_by=["event_date"] if partition_by_date else None)
            write_batch(rejects, rejects_path, batch_id, rebalance=True)
            if not can_score:
                return
            dated = partition_by_date and "inference_timestamp" in records.columns
            if dated:
                records = records.withColumn("inference_date", F.to_date("inference_timestamp"))
            write_batch(records, predictions_path, batch_id,
                        partition_by=["inference_date"] if dated else None)
            spark = batch.sparkSession
            stored = spark.read.schema(records.schema).parquet(
                batch_folder(predictions_path, query_id(spark), batch_id))
            if "inference_timestamp" in records.columns:
                # committed after the batch's records: the drift report trusts what is here
                write_batch(drift.summarise(stored).coalesce(1), summary_path(predictions_path), batch_id)
                if not dated:  # date folders have no one order of files
                    write_batch(arrival.manifest_of(stored).coalesce(1), arrival.manifest_path(predictions_path), batch_id)
            if kafka:
                write_kafka(scoring.to_json_value(stored.drop("inference_date")),
                            kafka["servers"], kafka["topic"])
        finally:
            fields.unpersist()
    return write


def without_replays(raw: DataFrame, within: str) -> DataFrame:
    """Streaming ``raw`` without events whose transaction id came in during the last ``within``
    (e.g. "1 hour"). Spark's own deduplication within a watermark on the time of arrival: ids
    older than that leave the state. Rows without an id stand for themselves (a key of their
    own), so they still reach the rejects."""
    tid = F.get_json_object("json_str", "$.transaction_id")
    return (raw.withColumn("_at", F.current_timestamp()).withWatermark("_at", within)
            .withColumn("_tid", F.coalesce(F.concat(F.lit("id:"), tid), F.uuid()))
            .dropDuplicatesWithinWatermark(["_tid"]).drop("_at", "_tid"))


def scoring_query(raw: DataFrame, feature_store_path: str, predictions_path: str,
                  rejects_path: str, checkpoint: str, champion: ChampionLoader | None = None,
                  trigger: dict | None = None, kafka: dict | None = None,
                  dedup_within: str | None = None, partition_by_date: bool = False,
                  spec: FeatureSpec = STORE, record: str = "rich", inference_ts=None) -> StreamingQuery:
    """``raw`` is a streaming frame with ``json_str``. ``dedup_within`` (e.g. "1 hour") drops
    replayed events by transaction id (see ``without_replays``); off by default, as the
    reference does not deduplicate. ``spec`` and ``record``: see ``score_batch``."""
    if dedup_within:
        raw = without_replays(raw, dedup_within)
    w = (raw.writeStream
         .foreachBatch(scoring_writer(feature_store_path, predictions_path, rejects_path,
                                      champion, kafka, partition_by_date, spec, record, inference_ts))
         .option("checkpointLocation", checkpoint))
    return apply_trigger(w, trigger).start()
