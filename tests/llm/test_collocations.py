import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskflow.llm import collocations


def brute(rows, threshold, top):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        good = {p: n for p, n in counts.items() if len(p) > 1 and n >= threshold}
        inside = {q for p, n in good.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                  if counts[q := p[i:i + k]] <= n}
        rows_ = []
        for p, a in good.items():
            if p not in inside:
                score, j = min((1000 * a * total[lang] // (counts[p[:j]] * counts[p[j:]]), j) for j in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), counts[p[:j]], counts[p[j:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, docs=400):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdé" for b in "xyZ"]
    fixed = ["the quick brown fox jumps", "over a lazy", "In the end of"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.15 else rng.choice(words) if rng.random() < 0.8 else f"u{rng.randrange(2000)}")
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", " ", ": "]))
        rows.append((rng.choice(["en", "en", "fr", None]), "".join(parts)))
    return rows + [("en", None), ("en", ""), (None, "?!"), ("de", "aa aa aa aa " * 40)]


@pytest.mark.parametrize("seed,shards,row_words", [(1, 4, 1 << 18), (2, 3, 7), (3, 1, 20)])
def test_equals_the_definition(spark, monkeypatch, seed, shards, row_words):
    # a filter of few cells gives many false hits, which must not change a count
    monkeypatch.setattr(collocations, "CELLS", 1 << (24 if seed == 1 else 15))
    monkeypatch.setattr(collocations, "SHARDS", shards)
    monkeypatch.setattr(collocations, "ROW_WORDS", row_words)
    monkeypatch.setattr(collocations, "_GATHER", 900)
    monkeypatch.setattr(collocations, "BUCKET_WORDS", 1000)
    monkeypatch.setattr(collocations, "_TOGETHER", 400)
    monkeypatch.setattr(collocations, "_PHRASES", 300)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, text string, words string").repartition(3)
    assert got(collocations.mine(df, threshold=12, top=60)) == brute(rows, 12, 60)


def test_empty_and_nothing_frequent(spark):
    kind = "lang string, text string"
    assert collocations.mine(spark.createDataFrame([], kind)).count() == 0
    assert collocations.mine(spark.createDataFrame([("en", "a b c"), (None, None)], kind)).count() == 0


def test_scores_beyond_64_bits(spark):
    # 1000 * a * n passes 2^63 where a and n do not
    df = spark.sql("SELECT CAST(3e9 AS BIGINT) AS a, CAST(5e12 AS BIGINT) AS total, CAST(4e9 AS BIGINT) AS l, CAST(7e9 AS BIGINT) AS r")
    score = df.selectExpr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(total AS DECIMAL(17,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0))) AS s").first()["s"]
    assert score == 1000 * 3 * 10 ** 9 * 5 * 10 ** 12 // (4 * 10 ** 9 * 7 * 10 ** 9)


def test_a_phrase_is_counted_once_per_shard_from_its_activation():
    rng = np.random.default_rng(5)
    shards = [rng.integers(1, 6, 400).astype(np.uint64) for _ in range(3)]
    for s in shards:
        s[rng.integers(0, 400, 30)] = 0
    cells = np.full(collocations.CELLS, 255, np.uint8)
    key = collocations._keys(np.arange(1, 6, dtype=np.uint64)[:, None], "en")
    for k, step in zip(range(5), (1, 2, 2, 3, 1)):
        for place in collocations._places(key[k:k + 1], len(cells)):
            cells[place] = np.minimum(cells[place], step)
    seen = Counter()
    for step in range(1, 9):
        for words, since, count in collocations.count_active(shards[step % 3], np.ones(400, bool), "en", cells, step, 3):
            for w, n in zip(words.tolist(), count.tolist()):
                seen[tuple(w)] += n
    want = Counter((int(a), int(b)) for s in shards for a, b in zip(s, s[1:]) if a and b)
    assert seen == want


@pytest.mark.parametrize("false_step", [1, 2])
def test_a_false_hit_before_its_activation_loses_no_count(false_step):
    # 1 2 is known at step 3, all else at step 1; 1 2 3 and 2 3 4 are false hits of an earlier step
    shards = [np.tile(np.array([1, 2, 3, 4, 0], np.uint64), 10 + s) for s in range(2)]
    cells = np.full(collocations.CELLS, 255, np.uint8)
    known = {(1,): 1, (2,): 1, (3,): 1, (4,): 1, (1, 2): 3, (2, 3): 1, (3, 4): 1, (1, 2, 3): false_step, (2, 3, 4): false_step}
    for words, step in known.items():
        for place in collocations._places(collocations._keys(np.array([words], np.uint64), "en"), len(cells)):
            cells[place] = step
    seen = Counter()
    for step in range(1, 8):
        w = shards[step % 2]
        for words, since, count in collocations.count_active(w, np.ones(len(w), bool), "en", cells, step, 2):
            for x, n in zip(words.tolist(), count.tolist()):
                seen[tuple(x)] += n
    assert seen == {(1, 2): 21, (2, 3): 21, (3, 4): 21, (1, 2, 3): 21, (2, 3, 4): 21, (1, 2, 3, 4): 21}


def test_long_regular_words_are_told_apart(spark):
    a = "a"
    while len(a) < 1024:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [("en", f"{a} x {b} y\n" * 6)] * 3 + [("en", f"{b} x. {a} y z")] * 2
    df = spark.createDataFrame(rows, "lang string, text string")
    assert got(collocations.mine(df, threshold=12)) == brute(rows, 12, 2000)


def test_sums_of_phrases_whose_keys_are_equal(monkeypatch):
    rng = np.random.default_rng(7)
    words = rng.integers(1, 4, (200, 2)).astype(np.uint64)
    since, n, known = rng.integers(1, 5, 200).astype(np.uint8), rng.integers(1, 9, 200), rng.integers(1, 9, 200).astype(np.uint8)
    want = {}
    for w, s, c, k in zip(words.tolist(), since.tolist(), n.tolist(), known.tolist()):
        old = want.get(tuple(w), (255, 0, 255))
        want[tuple(w)] = (min(old[0], s), old[1] + c, min(old[2], k))
    for keys in (collocations._keys, lambda w, lang: np.zeros(len(w), np.uint64)):
        monkeypatch.setattr(collocations, "_keys", keys)
        out = collocations.summed("en", words, since, n, known)
        assert {tuple(w): tuple(r) for w, *r in zip(*(x.tolist() for x in out[:4]))} == want and len(out[0]) == len(want)


def test_a_long_text_is_read_in_slices(monkeypatch):
    texts = [t.encode() for _, t in corpus(6, 60) if t]
    whole = [collocations.sequence(t) for t in texts]
    monkeypatch.setattr(collocations, "_SLICE", 9)
    for t, (seq, hashes, counts, words) in zip(texts, whole):
        cut, h, n, w = collocations.sequence(t)
        assert cut.tolist() == seq.tolist() and h.tolist() == hashes.tolist()
        assert n.tolist() == counts.tolist() and w == words


@pytest.mark.parametrize("rows, distinct", [(0, 1), (1, 1), (5, 3), (70_000, 70_000)])
def test_phrases_survive_their_coding(rows, distinct):
    rng = np.random.default_rng(rows)
    words = rng.integers(0, 2**64, distinct, np.uint64)[rng.integers(0, distinct, (rows, 3))]
    assert (collocations._words_of(pa.scalar(collocations._squeezed(words)), 3) == words).all()
    n = rng.integers(0, 2**40, rows)
    assert (collocations._numbers(collocations._packed(n), np.int64) == n).all()


@pytest.mark.parametrize("common", [0, 3, 1000])
def test_words_that_all_tasks_know_travel_as_numbers(common):
    rng = np.random.default_rng(common)
    every = rng.integers(0, 2**64, 1000, np.uint64)
    known = np.unique(every[:common])
    words = every[rng.integers(0, 1000, (500, 2))]
    blob = collocations._squeezed(words, known)
    assert (collocations._words_of(pa.scalar(blob), 2, known) == words).all()
    if common == 1000:  # a hash costs 8 bytes, a number about one
        assert len(blob) < len(collocations._squeezed(words)) - 4 * len(np.unique(words))
    # without numbers, any list will do to read it
    assert (collocations._words_of(pa.scalar(collocations._squeezed(words)), 2, known) == words).all()


@pytest.mark.parametrize("common", [1, 40])
def test_few_common_words_change_no_count(spark, monkeypatch, common):
    monkeypatch.setattr(collocations, "COMMON", common)
    monkeypatch.setattr(collocations, "BUCKET_WORDS", 1000)
    rows = corpus(9, 200)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert got(collocations.mine(df, threshold=12, top=60)) == brute(rows, 12, 60)
