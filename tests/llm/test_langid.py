import random
import zlib

import numpy as np

from riskflow.llm import langid


def test_gradients_match_finite_differences():
    net = langid.Network(["a", "b", "c"], seed=1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, (7, 4)).astype(np.uint8)
    data[5:, 0] = 0
    label = np.array([0, 1, 2, 1])
    _, grads = net.gradients(data, label)
    for name in ("xf", "xb", "cf", "cb", "uf", "ub", "rf", "rb", "vf", "vb", "o"):
        flat, g = net.w[name].reshape(-1), grads[name].reshape(-1)
        for i in np.argsort(-np.abs(g))[:4]:
            keep, e = flat[i], 1e-3
            flat[i] = keep + e
            up = net.gradients(data, label)[0]
            flat[i] = keep - e
            down = net.gradients(data, label)[0]
            flat[i] = keep
            assert abs((up - down) / (2 * e) - g[i]) < 2e-3 * max(1, abs(g[i])), name


def corpus(n):
    rng = random.Random(3)
    parts = {"aa": ["the", "ing", "wh", "tion", "and"], "bb": ["ción", "que", "os", "ado", "ll"], "cc": ["ung", "sch", "keit", "pf", "ü"]}
    out = []
    for i in range(n):
        lang = rng.choice("aa aa bb cc".split())
        out.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 80))), lang))
    return out


def test_held_out_accuracy_and_edges(make_docs, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 80)
    rows = corpus(300)
    extra = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 $$ 4!", None), (None, rows[0][1], rows[0][2]), (1003, "the whing and " * 30_000, None),
             (1004, "中文", None)]
    docs = make_docs(rows + extra).withColumnRenamed("n_chars", "score")
    got = langid.identify_documents(docs).collect()
    assert len(got) == 306 and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1003]["lang_pred"] == "aa"
    assert by[1004]["lang_pred"] in ("aa", "bb", "cc") and by[None]["held_out"] is False
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.97


def test_without_languages_all_is_unknown(make_docs):
    got = langid.identify_documents(make_docs([(1, "some text"), (1, "some text")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2
    assert langid.identify_documents(make_docs([])).count() == 0


def test_repeated_ids_do_not_swell_the_sample(make_docs, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 4)
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    docs = make_docs([(i, f"w{n}", "en" if i % 2 else "de") for i in ids for n in range(30)])
    assert langid.training_windows(docs).count() == 4
