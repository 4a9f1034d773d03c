import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import ann


def exact(ids, x, k, every):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        other = np.flatnonzero(ids != ids[i])
        score = ann.cosine(x[other], x[i])
        best = np.lexsort((ids[other], -score))[:k]
        out[int(ids[i])] = [(int(a), float(s)) for a, s in zip(ids[other][best], score[best])]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("clusters", [1, 12])
def test_recall_and_exact_scores(spark, clusters):
    rng = np.random.default_rng(clusters)
    x = (rng.standard_normal((clusters, 48))[rng.integers(0, clusters, 3000)] + 0.4 * rng.standard_normal((3000, 48))).astype(np.float32).astype(float)
    ids = np.arange(3000)
    want, got = exact(ids, x, 5, 50), found(ann.search(frame(spark, ids, x)))
    assert got.keys() == want.keys()
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        true = dict(zip(ids.tolist(), ann.cosine(x, x[q])))
        assert all(s == pytest.approx(true[a], abs=1e-12) for a, s in rows)


def test_copies_tie_to_smaller_ids(spark):
    x = np.tile([0.3, -0.2, 0.9, 0.1], (400, 1))
    x[::7] = [1.0, 0.5, 0.25, 0.0]
    got = found(ann.search(frame(spark, np.arange(400), x.astype(np.float32).astype(float))))
    copies = [i for i in range(400) if i % 7]
    assert [a for a, _ in got[50]] == [i for i in copies if i != 50][:5]
    assert [a for a, _ in got[350]] == [i for i in range(0, 400, 7) if i != 350][:5]


def test_lone_vectors_beside_dense_clusters_get_k_neighbours(spark):
    rng = np.random.default_rng(5)
    ids = np.arange(4000)
    x = rng.standard_normal((8, 32))[rng.integers(0, 8, 4000)] + 1e-4 * rng.standard_normal((4000, 32))
    lone = ids[ids % 1000 == 50]
    x[lone] = 20 * rng.standard_normal((len(lone), 32))
    got = found(ann.search(frame(spark, ids, x)))
    assert sorted(got) == ids[ids % 50 == 0].tolist()
    assert {len(rows) for rows in got.values()} == {5}


def test_k_distinct_neighbours_beside_a_repeated_id():
    rng = np.random.default_rng(6)
    x = np.concatenate([np.ones((40, 32)), rng.standard_normal((60, 32))])
    ids = np.append(np.full(40, 7), np.arange(100, 160))
    unit, q = ann._unit(x) @ ann.rotation(32), np.ones(32)
    got, _ = ann.scan_list(ids, x, unit, 0, q, ann._unit(q[None])[0] @ ann.rotation(32), 5)
    assert got[0] == 7 and len(set(got.tolist())) == 5


def test_unusable_vectors_few_rows_and_repeats(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, []), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (50, [0.0, 2.0]), (50, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit("x"))
    got = found(ann.search(df))
    assert {q: [a for a, _ in v] for q, v in got.items()} == {0: [7, 50], 50: [7, 0]}
    assert ann.search(df.limit(0)).count() == 0
    assert ann.search(df.where("vec_id = 7")).count() == 0
