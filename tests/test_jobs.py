"""End to end: events -> raw stream -> features -> train -> retrain/promote -> scoring with the
champion -> prediction log -> drift report and decision -> gauges."""

from pyspark.sql import functions as F

from riskflow.plans import catalog as C
from riskflow.plans.jobs import Paths, drift_job, gauges_job, retrain_job, train_job
from riskflow.session import scratch_path
from riskflow.sources.raw import read_raw_stream
from riskflow.streaming.scoring import ChampionLoader, scoring_query


def test_end_to_end(spark, sf_small):
    root = scratch_path(spark, "test_e2e")
    paths = Paths(features=f"{root}/features", predictions=f"{root}/predictions",
                  runs=f"{root}/runs", models=f"{root}/models", gauges=f"{root}/gauges")
    bronze = C._publish_bronze(spark, sf_small, root)
    champ = ChampionLoader(spark, paths.runs, "fraud_model")

    def run(tag):
        raw = read_raw_stream(spark, "json", bronze)
        q = scoring_query(raw, paths.features if tag == "a" else f"{root}/features_{tag}",
                          f"{root}/pred_{tag}" if tag == "a" else paths.predictions,
                          f"{root}/rejects_{tag}", f"{root}/_chk_{tag}", champion=champ,
                          trigger={"availableNow": True})
        q.awaitTermination()

    run("a")                              # no champion yet: features only, no predictions
    n_features = spark.read.parquet(paths.features).count()
    assert n_features > 0
    assert not champ.get()[0]

    first = train_job(spark, paths).first()
    assert first["version"] == 1 and not first["candidate"]
    assert champ.get()[0] is None         # first training does not promote

    promoted = retrain_job(spark, paths).first()
    assert promoted["version"] == 2 and promoted["promoted"]
    model, run_id = champ.get()
    assert model is not None and run_id == promoted["run_id"]

    run("b")                              # scored by the champion
    log = spark.read.parquet(paths.predictions)
    assert log.count() > 0
    assert log.filter(F.col("model_run_id") != run_id).count() == 0

    report, decision, _ = drift_job(spark, paths, retrain=False)
    assert report.count() == 5 and decision is not None
    report.unpersist()
    g = gauges_job(spark, paths)
    assert g.count() == 8
    assert "fraud_avg_amount_pct_change" in {r["metric"] for r in g.collect()}
    assert spark.read.parquet(paths.gauges).count() == 8


def test_single_class_retrain_does_not_compete(spark):
    """SURVEY 7.5: with one class in the validation split the AUC is undefined; the run is
    registered but cannot become champion."""
    from riskflow import schemas
    from riskflow.operators import registry as reg
    root = scratch_path(spark, "test_oneclass")
    rows = [(f"t{i}", float(i), i % 2, i % 2, i % 24, 0, 0, float(i % 3), 0,
             "2024-01-01T00:00:00+00:00") for i in range(60)]
    spark.createDataFrame(rows, schemas.FEATURES).write.parquet(f"{root}/features")
    paths = Paths(features=f"{root}/features", predictions=f"{root}/p", runs=f"{root}/runs",
                  models=f"{root}/models")
    assert retrain_job(spark, paths).count() == 0
    runs = reg.read_runs(spark, paths.runs).collect()
    assert len(runs) == 1 and not runs[0]["candidate"]
    assert reg.champion_f1(reg.read_runs(spark, paths.runs), "fraud_model") is None


def test_cli_jobs_on_empty_lake(spark, capsys):
    """The command line runs drift and gauges on a lake with no predictions yet: empty
    report, no decision, no error."""
    from riskflow.__main__ import main
    root = scratch_path(spark, "test_cli")
    main(["gauges", "--root", root])
    main(["drift", "--root", root, "--no-retrain"])
    out = capsys.readouterr().out
    assert "None" in out            # no decision below 20 predictions
