import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import graph, ngram_join, wordhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def by_hand(rows):
    """[(doc_id, text)] -> sorted (doc_id, set size, component) of every row."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    low = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        low[root(i)].append(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return sorted(((d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def got(docs):
    return sorted((tuple(r) for r in ngram_join.near_groups(docs).collect()), key=repr)


def corpus(rng, n, words=60):
    """Texts with near copies around the threshold, chains of edits and common passages."""
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    out = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.35 or not out:
            text = [rng.choice(vocabulary) for _ in range(rng.randint(0, words))]
        else:
            text = list(rng.choice(out))
            for _ in range(rng.randint(0, 4)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            text = text + passage
        out.append(text)
    return [(i, " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(make_docs, seed):
    rows = corpus(random.Random(seed), 250)
    assert got(make_docs(rows)) == by_hand(rows)


def test_common_shingles_take_the_long_prefix(make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "COMMON", 2)
    monkeypatch.setattr(ngram_join, "BLOCK", 400)
    rows = corpus(random.Random(9), 200)
    assert got(make_docs(rows)) == by_hand(rows)


def test_one_large_group_of_near_copies(make_docs):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(len(text))] = f"x{rng.randint(0, 10 ** 6)}"
        rows.append((i, " ".join(text)))
    assert got(make_docs(rows)) == by_hand(rows)


def test_a_group_beyond_a_block_is_held_in_no_task(spark, make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 1000)
    sets = [(p, 1000 * p + i, 50, b"") for p, size in ((1, 200), (2, 3)) for i in range(size)]
    rows = ngram_join.dealt(spark.createDataFrame(sets, "part long, cls long, n long, tokens binary")).collect()
    keys = defaultdict(list)
    for r in rows:
        keys[r["part"], r["low"], r["high"]].append(r)
    # the group of part 1 has 10 blocks' shingles; a task holds two of them
    assert max(sum(r["n"] for r in held) for held in keys.values()) <= 4 * 1000
    met = defaultdict(int)
    for held in keys.values():
        for a in held:
            for b in held:
                if a["cls"] < b["cls"] and (a["indexed"] or b["indexed"]):
                    met[a["cls"], b["cls"]] += 1
    assert len(met) == 200 * 199 // 2 + 3
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    texts = [(i, " ".join(f"x{rng.randint(0, 10 ** 6)}" if rng.random() < 0.02 else w for w in base)) for i in range(80)]
    assert got(make_docs(texts)) == by_hand(texts)


def test_edge_cases(make_docs):
    text = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, text), (7, text), (8, text.upper()),
            (None, text), (None, "only null has this text"), (9, " "), (9, "Ä b"), (10, "ä b"), (11, "w " * 50_000)]
    docs = make_docs(rows).withColumn("cls", F.lit(1)).withColumn("token", F.lit("x"))
    assert got(docs) == by_hand(rows)
    assert got(make_docs([])) == []


def test_keep_one_keeps_one_of_each_group(make_docs):
    text = "one two three four five six seven"
    rows = [(5, text, "en"), (3, text, "de"), (3, text, "fr"), (4, "other words stand here now", "en"), (None, "", "a"), (1, "", "b"), (1, "", "b")]
    out = ngram_join.keep_one(make_docs(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, out), key=repr) == sorted([(3, text), (4, rows[3][1]), (None, ""), (1, ""), (1, "")], key=repr)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(60, 60), (201, 200), (200, 201)]
    df = spark.createDataFrame(edges, "u long, v long")
    roots = {r["node"]: r["root"] for r in graph.components(df).collect()}
    assert roots == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 201: 200}


def test_rounds_of_a_long_path_leave_the_estimated_size_small(spark):
    names = list(range(300))
    random.Random(3).shuffle(names)
    out = graph.components(spark.createDataFrame(list(zip(names, names[1:])), "u long, v long"))
    assert {r["node"]: r["root"] for r in out.collect()} == {i: 0 for i in range(1, 300)}
    # a join's estimate is the product of its sides': its digits multiplied by four each round
    assert out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2 ** 64


def test_word_hashes_of_long_texts_are_those_of_their_parts(monkeypatch):
    data = ("Word éa b " * 3000 + "x" * 5000 + " \t\n end").encode()
    whole = wordhash.word_hashes(data)
    assert len(whole) == len(data.split())
    monkeypatch.setattr(wordhash, "_PIECE", 1000)
    assert np.array_equal(whole, wordhash.word_hashes(data))
    assert np.array_equal(whole[:2], wordhash.word_hashes("wORD éa b".encode()))
