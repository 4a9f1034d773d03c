import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskflow.llm import packing, tokens

PATH = public_tokenizers.path(packing.TOKENIZER)
ODD = ["Hello, world. don't we're It's 3,000.5 a.b. x—! ‘q’ naïve İstanbul. É,. <|endoftext|> a<|startoftext|>b ÿ. ÷. ×, ñ, é.",
       None, "", "  \n\t ", "UPPER. Straße, Σίσυφος ΟΔΟΣ. 中文, 。.", "x" * 3000, "é. Å, ́.", "a b. c,\x1cd.", "don't. 's, 't.", "ǅ. ŉ, ﬁ."]


def test_encoder_equals_the_tokenizer(monkeypatch):
    monkeypatch.setattr(tokens, "_PIECE", 200)
    monkeypatch.setattr(tokens, "_CACHE", 50)
    rng = random.Random(1)
    units = [u for t in ODD if t for u in t.split(" ")] + [".", ",", "\n", "ab", "cd"]
    texts = ODD + ["".join(rng.choice(units) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    encoder = tokens.Encoder(PATH)
    want = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for got, w in zip(encoder.encode(texts), want):
        assert got.tolist() == w.ids


def check_pieces(rows, texts):
    """Each document's pieces cover its ids once; sequences are gapless; returns the padding."""
    tokenizer = Tokenizer.from_file(PATH)
    ids = sorted(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for t in texts)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    padding = 0
    for parts in sequences.values():
        parts.sort(key=lambda r: r["offset"])
        at = 0
        for r in parts:
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= packing.WINDOW
        padding += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    return padding


def test_round_trip(spark, make_docs):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("thun", "ed", "or", "qui") for b in ("ing", "ble", "mente", "x")]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 400, 5000]))) for _ in range(60)]
    rows = packing.pack(make_docs(list(enumerate(texts))).withColumnRenamed("lang", "row").withColumnRenamed("source", "shard")).collect()
    assert check_pieces(rows, texts) == 0
    tokenizer = Tokenizer.from_file(PATH)
    for i, t in enumerate(texts):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        parts, at = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]), 0
        for r in parts:
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_repeats_null_ids_and_empty(make_docs):
    rows = packing.pack(make_docs([(2 ** 60 + 1, "a b")] * 3 + [(None, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in rows if r["start"] == 0) == [(0, 1)] + [(2 ** 60 + 1, 3)] * 3
    assert packing.pack(make_docs([])).count() == 0


def test_seeds_retrieve_related_documents():
    rng = np.random.default_rng(3)
    topics = [rng.choice(5000, 40, replace=False) + 10 for _ in range(6)]
    docs = [rng.choice(topics[i % 6], 300).astype(np.uint16) for i in range(60)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=6000)
    order = packing.order_documents(docs, np.log1p((60 - df + 0.5) / (df + 0.5)), 300.0)
    assert sorted(order) == list(range(60))
    same = sum(a % 6 == b % 6 for a, b in zip(order, order[1:]))
    assert same >= 45


def test_lexical_neighbours_meet_in_one_shard(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 8000)
    rng = random.Random(6)
    words = [f"{a}{b}{c}" for a in ("thun", "ed", "or", "qui", "mar") for b in ("ing", "ble", "ter", "x") for c in ("o", "us", "ty", "ez")]
    rng.shuffle(words)
    texts = [" ".join(rng.choice(words[i % 8 * 10:i % 8 * 10 + 10]) for _ in range(60)) for i in range(320)]
    rows = packing.pack(make_docs(list(enumerate(texts)))).collect()
    assert check_pieces(rows, texts) == 0
    shard = {r["doc_id"]: r["sequence_id"] >> 32 for r in rows}
    assert len(set(shard.values())) >= 4
    mates = [(i, j) for i in range(320) for j in range(i + 8, 320, 8)]
    # dealt by row number, about one pair in as many as there are shards
    assert sum(shard[i] == shard[j] for i, j in mates) >= 0.5 * len(mates)


def test_a_large_cell_is_dealt_over_several_shards(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 1000)
    texts = ["the very same words in every document"] * 400
    rows = packing.pack(make_docs(list(enumerate(texts)))).collect()
    assert check_pieces(rows, texts) == 0
    held = defaultdict(int)
    for r in rows:
        held[r["sequence_id"] >> 32] += r["length"]
    assert max(held.values()) <= 2000


@pytest.mark.parametrize("lengths", [[1], [2048], [2047, 2], [5000, 1, 1, 100], [3] * 10])
def test_cut_has_no_padding(lengths):
    docs = [np.zeros(n) for n in lengths]
    sums = defaultdict(int)
    for _, _, length, sequence, _ in packing.cut(list(range(len(docs))), docs):
        sums[sequence] += length
    assert sum(sums.values()) == sum(lengths)
    assert all(v & (v - 1) == 0 and v <= 2048 for v in sums.values())


def test_neighbours_equal_a_direct_ranking():
    rng = np.random.default_rng(12)
    docs = [rng.zipf(1.3, rng.integers(1, 200)).clip(2, 3999).astype(np.uint16) for _ in range(150)] + [np.array([1], np.uint16)] * 5
    docs = [np.append(d, np.uint16(1)) for d in docs]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=4000)
    idf, mean = np.log1p((len(docs) - df + 0.5) / (df + 0.5)), float(np.mean([len(d) for d in docs]))
    index, used = packing.Index(docs, idf, mean), np.zeros(len(docs), bool)
    used[::7] = True
    for seed in range(len(docs)):
        weights = {}
        for t, n in zip(*np.unique(docs[seed], return_counts=True)):
            if df[t] > 1:
                weights[t] = packing.term_weights(n, idf[t], len(docs[seed]), mean)
        query = sorted(weights, key=lambda t: (-weights[t], t))[:packing.QUERY_TERMS]
        score = {}
        for d, ids in enumerate(docs):
            if not used[d]:
                value = sum(packing.term_weights((ids == t).sum(), idf[t], len(ids), mean) for t in query if (ids == t).any())
                if value > 0:
                    score[d] = value
        best = sorted(score, key=lambda d: (-round(score[d], 9), d))[:packing.NEIGHBOURS]
        got = index.neighbours(seed, used)
        assert len(got) == len(best)
        assert np.allclose([score[d] for d in got], [score[d] for d in best])


def test_many_empty_documents_are_packed_in_linear_time():
    docs = [np.array([1], np.uint16)] * 60_000
    begin = time.perf_counter()
    assert sorted(packing.order_documents(docs, np.full(2, 0.1), 1.0)) == list(range(60_000))
    assert time.perf_counter() - begin < 20
