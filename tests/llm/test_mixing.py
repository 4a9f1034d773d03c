import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.llm import mixing
from riskflow.llm.common import n_words


def targets_by_hand(sizes):
    """Water filling by repeated rounds: capped sources leave, the rest share what is left."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while True:
        left = total - sum(out.values())
        w = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 3 * sizes[s]] if w else []
        if not over:
            return out | {s: left * weight[s] / w for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
            free.discard(s)


def planned(docs):
    return mixing.plan(docs, n_words(F.col("text"))).collect()


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_repeated_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 5, 40, 1000, 9000]) for s in [None, "", "a", "b", "B", "é", "z"]}
    sizes["a"] = 7
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = targets_by_hand(sizes)
    assert got.keys() == want.keys()
    for s in got:
        assert got[s] == pytest.approx(want[s])


def test_taken_words_come_near_targets(make_docs):
    rng = random.Random(1)
    docs = make_docs([(i, "w " * rng.randint(1, 60), None, rng.choice("aaabcd")) for i in range(1500)])
    by = {}
    for r in planned(docs):
        assert 0 <= r["copies"] <= 3
        t = by.setdefault(r["source"], [r["target"], 0])
        t[1] += r["copies"] * r["size"]
    for target, taken in by.values():
        assert abs(taken - target) <= 4 * 60


def test_reruns_and_partitioning_agree(make_docs):
    docs = make_docs([(i % 40, "x " * (i % 7), None, "ab"[i % 2]) for i in range(300)])
    key = lambda d: sorted((r["doc_id"], r["source"], r["size"], r["copies"]) for r in planned(d))
    assert key(docs) == key(docs.repartition(5))


def test_nulls_empty_and_zero(make_docs):
    docs = make_docs([(1, None, None, None), (None, "a b", None, None), (2, "", None, "s"), (2, " \n", None, "s")])
    rows = planned(docs)
    assert len(rows) == 4
    assert sum(r["copies"] for r in rows if r["size"] == 0) == 0
    assert {r["target"] for r in rows if r["source"] == "s"} == {0.0}
    assert planned(make_docs([])) == []


def test_mix_keeps_columns_and_clashing_names(make_docs):
    docs = make_docs([(1, "a b c", "en", "s"), (2, "d e", "en", "t")]).withColumn("size", F.lit("x")).withColumn("copies", F.lit(9))
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert {r["size"] for r in out.collect()} == {"x"}


def test_hot_repeated_rows_take_their_share(make_docs):
    docs = make_docs([(7, "a b c d", None, "s")] * 90 + [(8, "q", None, "t")])
    rows = [r for r in planned(docs) if r["source"] == "s"]
    taken = sum(r["copies"] * r["size"] for r in rows)
    assert abs(taken - rows[0]["target"]) <= 8


def test_rows_that_share_id_and_size_mix_alike_in_reruns(make_docs):
    docs = make_docs([(7, f"w{i} x", "en", "a") for i in range(600)] + [(8, "y " * 900, "en", "b")])
    got = [Counter(r["text"] for r in mixing.mix(docs.repartition(n, F.xxhash64("text", F.lit(n)))).collect()) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and sum(got[0].values()) > 0
