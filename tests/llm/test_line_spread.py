import random

from pyspark.sql import functions as F

from riskflow.llm import line_spread


def by_hand(rows, min_sites):
    sites, first = {}, {}
    for doc_id, text, _, source in sorted(rows, key=lambda r: r[0]):
        for pos, line in enumerate((text or "").split("\n")):
            k = line.strip(" \t\r\x0b\x0c")
            if len(k) >= line_spread.MIN_CHARS:
                sites.setdefault(k, set()).add(source)
                first.setdefault(k, (doc_id, pos))
    out = {}
    for doc_id, text, _, source in rows:
        if text is None:
            out[doc_id] = None
            continue
        left = []
        for pos, line in enumerate(text.split("\n")):
            k = line.strip(" \t\r\x0b\x0c")
            if len(k) < line_spread.MIN_CHARS or len(sites[k]) < min_sites or first[k] == (doc_id, pos):
                left.append(line)
        out[doc_id] = "\n".join(left)
    return out


def test_matches_exact_counts(make_docs):
    rng = random.Random(3)
    lines = [f"shared line number {i}" for i in range(30)] + ["short", "", "  padded shared line  "]
    # line i is drawn with a different frequency, so spreads lie on both sides of the threshold
    rows = [(i, "\n".join(rng.choice(lines[: rng.randint(1, len(lines))]) for _ in range(rng.randint(0, 6))), None,
             f"s{rng.randint(0, 24)}") for i in range(400)]
    got = {r["doc_id"]: r["text"] for r in line_spread.remove_spread_lines(make_docs(rows), min_sites=12).collect()}
    assert got == by_hand(rows, 12)


def test_nulls_sites_and_columns(make_docs):
    line = "the very same footer line"
    rows = [(i, f"body of {i} only\n{line}", None, None if i == 3 else f"s{i}") for i in range(12)] + [(99, None, None, "s1")]
    docs = make_docs(rows).withColumn("lines", F.lit("old")).withColumn("pos", F.lit(1)).withColumn("h1", F.lit("k"))
    out = line_spread.remove_spread_lines(docs, min_sites=12).collect()
    assert {r["doc_id"]: r["lines_removed"] for r in out} == {0: 0, **{i: 1 for i in range(1, 12)}, 99: 0}
    assert next(r for r in out if r["doc_id"] == 99)["text"] is None
    assert {r["h1"] for r in out} == {"k"}


def test_one_site_is_no_spread(make_docs):
    rows = [(i, "a line on one site only", None, "s") for i in range(50)]
    assert all(r["lines_removed"] == 0 for r in line_spread.remove_spread_lines(make_docs(rows)).collect())


def test_identical_rows_are_treated_alike(make_docs):
    rows = [(5, "a line that all sites hold", None, "s0")] * 3 + [(6 + i, "a line that all sites hold", None, f"s{i}") for i in range(12)]
    out = line_spread.remove_spread_lines(make_docs(rows)).collect()
    assert [r["lines_removed"] for r in out if r["doc_id"] == 5] == [0, 0, 0]
    assert all(r["lines_removed"] == 1 for r in out if r["doc_id"] != 5)


def test_a_line_on_few_sites_is_boilerplate(make_docs):
    line = "a passage that very many documents on a handful of sites share"
    rows = [(i, f"body of {i} only\n{line}", None, f"s{i % 6}") for i in range(60)]
    out = line_spread.remove_spread_lines(make_docs(rows)).collect()
    assert {r["doc_id"]: r["lines_removed"] for r in out} == {i: int(i > 0) for i in range(60)}


def test_empty_table(make_docs):
    assert line_spread.remove_spread_lines(make_docs([])).count() == 0
