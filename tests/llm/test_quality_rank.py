import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from riskflow.llm import quality_rank as q


def samples(rng, n):
    words = ["".join(rng.choice("abdeghinorst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        good = rng.random() < 0.8
        out.append((i, " ".join(text if good else [w.upper() + "!!" for w in text]), int(good)))
    return out


def test_held_out_ranking(spark, make_docs):
    rows = samples(random.Random(1), 400)
    docs = make_docs([(i, t) for i, t, _ in rows] + [(1000, None), (1001, ""), (None, "x y"), (1002, "word " * 50_000)])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(7, None), (None, 1), (5000, 1)], "doc_id long, quality int")
    got = q.score_documents(docs, labels).collect()
    assert len(got) == 404 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= q.CUT) for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 40
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.97


def test_labels_of_held_out_rows_do_not_matter(spark, make_docs):
    rows = samples(random.Random(2), 200)
    docs = make_docs([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert q.train(docs, labels).weights.tolist() == q.train(docs, flipped).weights.tolist()


def test_one_kind_of_label_repeats_and_clashing_columns(spark, make_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "doc_id long, quality int")
    docs = make_docs([(1, "a b"), (1, "a b"), (2, None)]).withColumn("score", F.lit("s")).withColumn("features", F.lit(1))
    out = q.rate(docs, q.train(docs, labels))
    assert [c for c in out.columns if c == "score"] == ["score"] and out.count() == 3
    assert {round(r["score"], 6) for r in out.collect()} == {q.CUT}
    assert q.score_documents(make_docs([]), labels.limit(0)).count() == 0


def test_repeated_ids_do_not_swell_the_sample(spark, make_docs, monkeypatch):
    monkeypatch.setattr(q, "SAMPLE", 3)
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    docs = make_docs([(i, f"text {n}") for i in ids for n in range(30)])
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    assert q.training_rows(docs, labels).count() == 3
