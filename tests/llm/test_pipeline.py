import random
import re
from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from riskflow.llm import packing, queries


def words(rng, n):
    return " ".join("".join(rng.choice("abdeghinorst") for _ in range(rng.randint(2, 8))) for _ in range(n))


def write_tables(spark, make_docs, folder):
    rng = random.Random(8)
    footer = "all sites carry this very footer line"
    rows, labels = [], []
    for i in range(120):
        lines = [words(rng, 12) for _ in range(8)]
        if i % 4 == 0:
            lines.append(footer)
        good = i % 6 != 5
        rows.append((i, "\n".join(lines) if good else "\n".join(x.upper() + "!! $$" for x in lines), "en", f"s{i % 13}"))
        labels.append((i, int(good)))
    rows += [(200, rows[1][1], "en", "s1"), (201, rows[1][1] + " more", "en", "s2"), (202, None, "en", "s1"), (203, footer, "en", "s3")]
    make_docs(rows).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return rows, footer


def test_stages(spark, make_docs, tmp_path):
    rows, footer = write_tables(spark, make_docs, str(tmp_path))
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        out = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert out.columns == docs.columns
        docs = out
        kept.append(out.collect())
    good = {r[0] for r in rows if r[0] < 120 and r[0] % 6 != 5}
    first = {r["doc_id"] for r in kept[0]}
    assert good <= first and not any(i < 120 and i % 6 == 5 for i in first)
    assert sum(footer in (r["text"] or "") for r in kept[1]) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in kept[1] if r["text"])
    third = [r["doc_id"] for r in kept[2]]
    assert len(third) == len(set(third)) and {1, 200, 201} & set(third) == {1} and good <= set(third)
    copies = Counter(r["doc_id"] for r in kept[3])
    assert set(copies) <= set(third) and max(copies.values()) <= 3
    starts = Counter(r["doc_id"] for r in kept[4] if r["start"] == 0)
    assert starts == copies
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(r["doc_id"] for r in run.collect() if r["start"] == 0) == copies
    assert run.columns == ["doc_id", *(x.split()[0] for x in packing.PIECE.split(", "))]


def test_stages_on_empty_tables_and_odd_rows(spark, make_docs, tmp_path):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd = [(None, None, None, None), (None, "", None, None), (1, "a b", None, None), (1, "a b", None, None), (2, "W!! X!!", None, "s")]
    for rows in ([], odd):
        docs = make_docs(rows).withColumnRenamed("lang", "score").withColumnRenamed("n_chars", "copies")
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert i == 4 or out.columns == docs.columns
            docs = out
        assert docs.count() == 0 or rows


def test_documents_made_of_boilerplate_go(spark, make_docs):
    line = "one line that every site repeats"
    rows = [(i, f"{line}\nok." if i else f"{line}\nbody of the first", None, f"s{i}") for i in range(12)]
    out = corpus_pipeline.line_dedup(spark, make_docs(rows), "").collect()
    assert [(r["doc_id"], r["text"]) for r in out] == [(0, rows[0][1])]


def test_registration():
    names = list(entry.queries())
    assert "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES if k.startswith("op")) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert set(queries.QUERIES) <= set(names)
