import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from riskflow.llm import prefix_trie

CONVERSATIONS = "conv_id long, turn long, role string, text string"


def brute(rows, group=20, most=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(role.encode()).hexdigest() + hashlib.md5(text.encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    full = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % most
        full[c] = tuple(own.get(c - c % group, [])[:h] + mine[h:])
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(members[p]) - 1) * words
    return sorted((min(m), len(p), str(min(members[p[:-1]])) if p else "None", len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(full[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def got(df):
    return sorted((r["conv_id"], r["depth"], str(r["parent_conv_id"]), r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"],
                   r["ends_sha256"]) for r in df.collect())


def random_rows(seed, convs=90):
    rng = random.Random(seed)
    texts = ["a b", "c", None, "", "d e f", "a  b\n"]
    rows = []
    for c in rng.sample(range(200), convs):
        for t in range(rng.choice([1, 1, 2, 5, 9, 14])):
            rows.append((c, rng.choice([t, t, None, 3]) if c % 7 == 0 else t, rng.choice(["user", None, "bot"][:1 + (t % 2)]), rng.choice(texts[:1 + c % 6])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block,cell", [(1, 4, 4096), (2, 1, 3), (3, 3, 2)])
def test_equals_the_definition(spark, monkeypatch, seed, block, cell):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "CELL", cell)
    monkeypatch.setattr(prefix_trie, "STRETCH", 16)
    rows = random_rows(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONVERSATIONS + ", pos string, n int")
    assert got(prefix_trie.shared_prefixes(df)) == brute(rows)


def test_nulls_repeats_copies_and_empty(spark):
    rows = [(None, 0, "user", "lost")] + [(40, 0, "user", "same")] * 3 + [(41, None, None, None)]
    rows += [(c, t, "user", "copy " * (t + 1)) for c in range(100, 160) for t in range(6)]
    rows += [(900, t, "user", f"w{t} " * 3) for t in range(120)]
    assert got(prefix_trie.shared_prefixes(spark.createDataFrame(rows, CONVERSATIONS))) == brute(rows)
    assert prefix_trie.shared_prefixes(spark.createDataFrame([], CONVERSATIONS)).count() == 0


def test_chains_that_hang_below_each_other(spark):
    # conversation k shares k - 1 turns with the one before and goes on alone
    rows, path = [], []
    for k in range(1, 14):
        path = path[:k - 1] + [f"{k}.{t}" for t in range(k - 1, k + 2)]
        rows += [(20 * k, t, "user", x) for t, x in enumerate(path)]
    assert got(prefix_trie.shared_prefixes(spark.createDataFrame(rows, CONVERSATIONS))) == brute(rows)
