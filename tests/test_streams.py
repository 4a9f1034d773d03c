"""Streams equal their batch twins; a restart adds nothing; replayed batches are idempotent."""

import pytest
from pyspark.sql import functions as F

from riskflow.plans import catalog as C
from riskflow.plans import derived as D
from riskflow.session import scratch_path
from riskflow.sources.events import raw_events
from riskflow.streaming.medallion import silver_query
from riskflow.streaming.sinks import batch_folder, write_batch


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_silver_equals_batch(spark, sf_small):
    s = C.stream_silver(spark, sf_small)
    b = C.silver_valid(spark, sf_small)
    assert _sorted(s.select(*b.columns)) == _sorted(b)


def test_stream_gold_equals_batch(spark, sf_small):
    s = C.stream_gold(spark, sf_small)
    b = C.features_gold(spark, sf_small)
    assert _sorted(s.select(*b.columns)) == _sorted(b)


def test_stream_scored_counts(spark, sf_small):
    s = C.stream_scored(spark, sf_small)
    assert s.count() == D.scored_log(spark, sf_small).count()


def test_two_writers_and_replayed_silver_batch(spark, sf_small):
    """Queries on checkpoints of their own both start at batch 0 of one table; gold takes a
    silver batch only once it is committed, and only once."""
    b = C.silver_valid(spark, sf_small)
    assert _sorted(C.stream_two_writers(spark, sf_small).select(*b.columns)) == _sorted(b)
    g = C.features_gold(spark, sf_small)
    assert _sorted(C.stream_gold_replay(spark, sf_small).select(*g.columns)) == _sorted(g)


def test_scored_rows_are_the_training_rows(spark, sf_small):
    """The default preset scores the features that training reads, row by row."""
    from riskflow.schemas import MODEL_FEATURES
    scored = C.stream_scored_store(spark, sf_small).select("transaction_id", *MODEL_FEATURES)
    trained = C.training_frame(spark, sf_small).select("transaction_id", *MODEL_FEATURES)
    assert _sorted(scored) == _sorted(trained)


def test_no_champion_rows_are_kept(spark, sf_small):
    r = C.stream_rejects(spark, sf_small)
    assert r.count() == D.raw(spark, sf_small).count()
    waiting = r.filter("stage = 'no_champion'")
    assert waiting.count() == C.features_store(spark, sf_small).count()
    assert waiting.filter("json_str IS NULL").count() == 0


def test_restart_adds_nothing(spark, sf_small):
    root = scratch_path(spark, "test_restart")
    bronze = C._publish_bronze(spark, sf_small, root)
    args = (spark, bronze, f"{root}/silver", f"{root}/q", f"{root}/_chk")
    silver_query(*args, trigger={"availableNow": True}).awaitTermination()
    n1 = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/silver").count()
    silver_query(*args, trigger={"availableNow": True}).awaitTermination()
    n2 = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/silver").count()
    assert n1 == n2 > 0


def test_replayed_batch_is_idempotent(spark):
    import os
    root = scratch_path(spark, "test_idem")
    df = spark.range(10)
    write_batch(df, root, 3)
    folder = batch_folder(root, "batch", 3)
    files = sorted(os.listdir(folder))
    write_batch(df, root, 3)              # replay of a committed batch: left alone
    assert sorted(os.listdir(folder)) == files
    assert spark.read.parquet(root).count() == 10
    os.remove(f"{folder}/_SUCCESS")       # an uncommitted attempt is overwritten
    write_batch(df, root, 3)
    assert spark.read.parquet(root).count() == 10
    write_batch(spark.range(100, 105), root, 3, query="another")   # its own batch 3
    assert spark.read.parquet(root).count() == 15


def test_scoring_dedup_option(spark, sf_small):
    """Replayed events (same transaction id) are dropped when dedup is on; off by default."""
    from riskflow.sources.raw import read_raw_stream
    from riskflow.streaming.scoring import scoring_query
    root = scratch_path(spark, "test_dedup")
    raw = D.raw(spark, sf_small).select("json_str")
    # every event twice, in different files (so in different micro-batches too)
    raw.coalesce(1).write.json(f"{root}/bronze/a")
    raw.coalesce(1).write.json(f"{root}/bronze/b")
    counts = {}
    for dedup in (None, "1 hour"):
        tag = "on" if dedup else "off"
        src = read_raw_stream(spark, "json", f"{root}/bronze/*", max_files_per_trigger=1)
        q = scoring_query(src, f"{root}/f_{tag}", f"{root}/p_{tag}", f"{root}/r_{tag}",
                          f"{root}/_chk_{tag}", trigger={"availableNow": True},
                          dedup_within=dedup)
        q.awaitTermination()
        counts[tag] = (spark.read.parquet(f"{root}/p_{tag}").count(),
                       spark.read.parquet(f"{root}/r_{tag}").count())
    tid = F.get_json_object("json_str", "$.transaction_id")
    store = C.features_store(spark, sf_small)
    assert counts["off"] == (2 * store.count(), 2 * (raw.count() - store.count()))
    # one row per id; rows without an id are never collapsed: both copies keep their rejects
    ids = raw.filter(tid.isNotNull()).select(tid).distinct().count()
    assert sum(counts["on"]) == ids + 2 * raw.filter(tid.isNull()).count()


def test_scoring_partition_by_date(spark, sf_small):
    from riskflow.functions.features import ONLINE
    from riskflow.operators import drift
    from riskflow.sources.raw import read_raw_stream
    from riskflow.sources.tables import read_predictions
    from riskflow.streaming.scoring import scoring_query
    root = scratch_path(spark, "test_pdate")
    bronze = C._publish_bronze(spark, sf_small, root)
    q = scoring_query(read_raw_stream(spark, "json", bronze), f"{root}/f", f"{root}/p",
                      f"{root}/r", f"{root}/_chk", trigger={"availableNow": True},
                      partition_by_date=True, spec=ONLINE)
    q.awaitTermination()
    log = read_predictions(spark, f"{root}/p")
    assert "inference_date" in log.columns
    assert log.count() == D.scored_log(spark, sf_small).count()
    assert "event_date" in spark.read.parquet(f"{root}/f").columns
    assert drift.drift_report(log).count() == 5


def test_bronze_sink_and_stream_quarantine(spark, sf_small):
    """SNK1: raw text appended verbatim as JSON lines; SNK3: quarantine of the silver stream
    equals the batch quarantine (text and reasons)."""
    from riskflow.operators import silver
    from riskflow.sources.raw import read_raw, read_raw_stream
    from riskflow.streaming.medallion import bronze_query
    root = scratch_path(spark, "test_bronze")
    raw = D.raw(spark, sf_small).select("json_str").filter("json_str IS NOT NULL")
    raw.coalesce(2).write.text(f"{root}/raw")
    q = bronze_query(read_raw_stream(spark, "text", f"{root}/raw"), f"{root}/bronze",
                     f"{root}/_chk", trigger={"availableNow": True})
    q.awaitTermination()
    bronze = read_raw(spark, "json", f"{root}/bronze")
    assert _sorted(bronze) == _sorted(raw)
    silver_query(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quar", f"{root}/_chk2",
                 trigger={"availableNow": True}).awaitTermination()
    streamed = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/quar") \
        .select("json_str", F.array_join("reasons", ",").alias("r"))
    batch = silver.quarantine(silver.parse_raw(raw)) \
        .select("json_str", F.array_join("reasons", ",").alias("r"))
    assert _sorted(streamed) == _sorted(batch)


def test_rebalanced_side_output_has_few_files(spark):
    import os
    root = scratch_path(spark, "test_rebal")
    df = spark.range(0, 2000, numPartitions=16).filter("id % 100 = 0")   # sparse rows
    write_batch(df, f"{root}/plain", 0)
    write_batch(df, f"{root}/rebal", 0, rebalance=True)
    files = lambda p: [f for f in os.listdir(batch_folder(p, "batch", 0)) if f.endswith(".parquet")]  # noqa
    assert len(files(f"{root}/rebal")) < len(files(f"{root}/plain"))
    assert spark.read.parquet(f"{root}/rebal").count() == 20


def test_crash_between_the_log_and_its_sums(spark, sf_small):
    """The predictions of a batch are committed, its sums and manifest are not; the replay makes
    them from the stored records, so times agree and the report is the one of the whole log."""
    import time

    from riskflow.functions.features import ONLINE
    from riskflow.operators import arrival, drift
    from riskflow.sources.tables import read_predictions
    from riskflow.streaming.scoring import scoring_writer, summary_path
    root = scratch_path(spark, "test_crash")
    batch = D.raw(spark, sf_small).select("json_str").repartition(3)
    write = scoring_writer(f"{root}/f", f"{root}/p", f"{root}/r", spec=ONLINE)
    write(batch, 0)
    before = read_predictions(spark, f"{root}/p").agg(F.min("inference_timestamp"), F.count("*")).first()
    for path in (summary_path(f"{root}/p"), arrival.manifest_path(f"{root}/p")):
        C.remove_path(spark, path)
    time.sleep(1.1)
    write(batch, 0)
    log = read_predictions(spark, f"{root}/p")
    assert log.agg(F.min("inference_timestamp"), F.count("*")).first() == before
    stored = spark.read.parquet(summary_path(f"{root}/p"))
    assert _sorted(drift.segment_summaries(log, summary=stored)) == _sorted(drift.segment_summaries(log))
    assert arrival.read_manifest(spark, f"{root}/p").agg(F.sum("rows")).first()[0] == before[1]
    # sums that were made from another log are an error, not an empty report
    moved = stored.withColumn("bucket", F.col("bucket") + 60_000_000)
    with pytest.raises(RuntimeError, match="summary"):
        drift.segment_summaries(log, summary=moved).collect()


def test_gold_waits_for_the_commit_of_a_silver_batch(spark, sf_small):
    """A silver batch whose files are there but not its announcement (the writer died just before)
    is not gold's yet; its replay brings it there once. The crash is staged by taking back what
    the last step of a batch leaves."""
    from riskflow.streaming.medallion import COMMITS, commits_path
    root = scratch_path(spark, "test_gold_crash")
    C._run_silver(spark, sf_small, root)
    marks = spark.read.schema(COMMITS).option("recursiveFileLookup", "true").json(commits_path(f"{root}/silver")).collect()
    for r in marks:
        C.remove_path(spark, batch_folder(commits_path(f"{root}/silver"), r["query_id"], r["batch_id"]))
        C.remove_path(spark, batch_folder(f"{root}/silver", r["query_id"], r["batch_id"]) + "/_SUCCESS")
        C.remove_path(spark, f"{root}/_chk/silver/commits/{r['batch_id']}")
        C.remove_path(spark, f"{root}/_chk/silver/commits/.{r['batch_id']}.crc")
    C._run_gold(spark, root)
    silver_query(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", f"{root}/_chk/silver",
                 trigger={"availableNow": True}).awaitTermination()
    C._run_gold(spark, root)
    g = C.features_gold(spark, sf_small)
    assert _sorted(C._gold_rows(spark, root).select(*g.columns)) == _sorted(g)


def test_arrival_cut_equals_positions(spark, monkeypatch):
    """Every k: the rows before the cut are the first k in order of batch, file and row."""
    from pyspark.sql.types import LongType, StructField, StructType

    from riskflow.operators import arrival
    monkeypatch.setattr(arrival, "CELL", 2)
    root = scratch_path(spark, "test_arrival")
    sizes = [5, 0, 1, 7, 3]
    at = 0
    for b, n in enumerate(sizes):
        part = spark.range(at, at + n, numPartitions=2)
        write_batch(part, f"{root}/log", b)
        stored = spark.read.schema(part.schema).parquet(batch_folder(f"{root}/log", "batch", b))
        write_batch(arrival.manifest_of(stored), arrival.manifest_path(f"{root}/log"), b)
        at += n
    manifest = arrival.read_manifest(spark, f"{root}/log")
    ends = [sum(sizes[:b]) for b in range(len(sizes))]
    for k in (1, 4, 5, 6, 7, 13, 16):
        cut = arrival.arrival_cut(manifest, k)
        rows = arrival.cut_batch(spark, f"{root}/log", StructType([StructField("id", LongType())]), cut).collect()
        assert {r["id"] for r in rows if r["is_baseline"]} == set(range(ends[cut.batch_id], k))
        assert len(rows) == sizes[cut.batch_id]


def test_arrivals_are_in_order_and_tasks_grow_with_the_batch(spark, monkeypatch):
    monkeypatch.setattr(C, "ARRIVAL_ROWS", 50)
    rows = spark.range(4000).withColumnRenamed("id", "event_id").selectExpr(
        "event_id", "TIMESTAMP'2026-04-01' + make_dt_interval(0, 0, 0, event_id) AS ts", "event_id % 7 AS user_id", "'x' AS event_type",
        "CAST(event_id AS DOUBLE) AS value", "'{}' AS props").orderBy(F.rand(1))
    want = dict(raw_events(rows).collect())
    at = 0
    for batch in C._arrivals(rows):
        # the texts are made behind the shuffle
        plan = batch._jdf.queryExecution().optimizedPlan().toString()
        assert "AS json_str" in plan and "json_str" not in plan[plan.index("RepartitionByExpression"):]
        parts = batch.rdd.glom().collect()
        assert len(parts) == 20 and max(len(p) for p in parts) < 150
        texts = [r.json_str for p in parts for r in p]
        assert texts == [want[i] for i in range(at, at + len(texts))]
        at += len(texts)
    assert at == 4000
