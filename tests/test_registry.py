"""Champion derivation and versions (FIXTURES 2)."""

from riskflow.operators import registry
from riskflow.schemas import MODEL_RUNS


def _runs(spark, f1s, model="m"):
    rows = [(model, f"r{i}", i + 1, True, {}, None, f, None, None, None)
            for i, f in enumerate(f1s)]
    return spark.createDataFrame(rows, MODEL_RUNS)


def _promoted(spark, f1s):
    h = registry.champion_history(_runs(spark, f1s)).orderBy("version").collect()
    return [r["promoted"] for r in h]


def test_champion_sequence(spark):
    assert _promoted(spark, [0.5, 0.4, 0.6, 0.6, 0.7]) == [True, False, True, False, True]


def test_champion_nan(spark):
    nan = float("nan")
    assert _promoted(spark, [0.5, nan, 0.6]) == [True, False, True]
    assert _promoted(spark, [nan, 0.9, 1.0]) == [True, False, False]


def test_sequential_replay_equivalence(spark):
    import random
    random.seed(11)
    f1s = [round(random.random(), 2) for _ in range(40)]
    champ, expect = None, []
    for f in f1s:
        ok = champ is None or f > champ
        expect.append(ok)
        if ok:
            champ = f
    assert _promoted(spark, f1s) == expect


def test_latest_version_numeric(spark):
    rows = [("m", "run", 9, True, {}, None, 0.1, None, None, None),
            ("m", "run", 10, True, {}, None, 0.2, None, None, None)]
    df = spark.createDataFrame(rows, MODEL_RUNS)
    assert registry.latest_version(df, "run").first()["latest_version"] == 10


def test_register_and_champion(spark, tmp_path):
    path = str(tmp_path / "runs")
    for f in (0.5, 0.7, 0.6):
        registry.register_run(spark, path, "fraud_model", f"run-{f}", {"f1_score": f},
                              {"k": "v"}, None, candidate=True)
    registry.register_run(spark, path, "fraud_model", "first", {"f1_score": 0.99}, {}, None,
                          candidate=False)
    runs = registry.read_runs(spark, path)
    assert sorted(r["version"] for r in runs.collect()) == [1, 2, 3, 4]
    assert registry.champion_f1(runs, "fraud_model") == 0.7
    assert registry.champion_f1(runs, "other") is None
