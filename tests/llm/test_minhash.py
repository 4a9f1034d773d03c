import hashlib
import random

import numpy as np

from riskflow.llm import minhash, wordhash


def brute(rows):
    """(doc_id, n_chars, sha of the edited text) by the definition, for distinct ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (doc, text) in enumerate(order):
        t, n = text or "", order[(i + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        out[doc] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, n)
    return out


def corpus(n=150, seed=4):
    rng = random.Random(seed)
    words = [a + b for a in "abcdefghij" for b in "éklmnopqrs"]
    rows = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 5, 90, 400])))) for i in range(n)]
    return rows + [(7000, None), (7001, ""), (7002, " \n\t"), (None, "null id " * 9), (7004, "x" * 5000), (7005, "𝒳é " * 40)]


def jaccard(a, b):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_equal_the_definition(make_docs, monkeypatch):
    monkeypatch.setattr(minhash, "RANGE_CHARS", 9000)
    rows = corpus()
    got = minhash.fingerprints(make_docs(rows).withColumnRenamed("lang", "part").withColumnRenamed("source", "own")).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        n, sha, edited, after = want[r["doc_id"]]
        text = texts[r["doc_id"]] or ""
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        mine, other, next_ = minhash.signatures([text, edited, after])
        assert r["fingerprint"] == minhash._hex(mine) and r["edited_fingerprint"] == minhash._hex(other)
        assert r["near_edited"] == (mine == other).mean() and r["near_next"] == (mine == next_).mean()
        assert abs(r["near_edited"] - jaccard(text, edited)) < 0.25


def test_ties_repeats_single_and_empty(make_docs):
    rows = [(5, "a b c d e f")] * 3 + [(5, "g h i j k l")] * 2 + [(1, "m n o p q r")]
    got = minhash.fingerprints(make_docs(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 5, 5, 5, 5, 5]
    assert len({r["fingerprint"] for r in got}) == 3
    one = minhash.fingerprints(make_docs([(3, "a b c d e f g")])).collect()[0]
    assert one["near_next"] == 1.0
    assert minhash.fingerprints(make_docs([])).count() == 0
    assert minhash.near_duplicates(make_docs([])).count() == 0


def test_signatures_do_not_depend_on_how_texts_are_gathered(monkeypatch):
    texts = [t for _, t in corpus(60)] + ["ab cd " * 3000, "one", "one two three four five", "One two THREE four five"]
    whole = minhash.signatures(texts)
    assert (whole[-1] == whole[-2]).all()
    for i, t in enumerate(texts):
        assert (minhash.signatures([t])[0] == whole[i]).all()
    monkeypatch.setattr(wordhash, "_PIECE", 100)
    monkeypatch.setattr(minhash, "_SHINGLES", 7)
    for i, t in enumerate(texts):
        assert (minhash._signature_of_long((t or "").encode()) == whole[i]).all()
        assert (minhash.signatures([t])[0] == whole[i]).all()


def test_likeness_estimates_jaccard():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    errors = []
    for _ in range(60):
        a = [rng.choice(words) for _ in range(400)]
        b = a[:rng.randint(100, 400)] + [rng.choice(words) for _ in range(100)]
        x, y = minhash.signatures([" ".join(a), " ".join(b)])
        errors.append((x == y).mean() - jaccard(" ".join(a), " ".join(b)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_near_duplicates_equal_all_pairs(make_docs):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "abcdefghijklmno" for b in "pqrstuvwxyz"]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, " "), (903, texts[0]), (None, texts[0].upper())]
    got = minhash.near_duplicates(make_docs(rows).withColumnRenamed("lang", "cls").withColumnRenamed("source", "band")).collect()
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if (a or "").split() and (b or "").split() and jaccard(a, b) >= 0.8:
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    want = sorted((str(d), str(min([x for x in g if x is not None], default=None)), len(g)) for g in groups.values() for d in g)
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["class_size"]) for r in got) == want


def test_a_large_group_of_copies_and_a_chain(make_docs):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(400)]
    rows += [(1000 + i, " ".join(base[:55] + [f"x{i}y{k}" for k in range(3)])) for i in range(60)]
    got = {r["doc_id"]: r for r in minhash.near_duplicates(make_docs(rows)).collect()}
    assert {got[i]["class_id"] for i in range(400)} == {0}
    assert {r["class_id"] for r in got.values()} == {0} and got[5]["class_size"] == 460
