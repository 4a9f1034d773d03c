import random
import re
from collections import Counter

from riskflow.llm import line_rules as lr


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    hit = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def test_base_counts_match_brute_force():
    rng = random.Random(6)
    parts = ["a", "b", "The", "é", "x#", "$$", "\n", " ", "\t", "\x0b", "\u00a0", "\u2028", "\x1c", "word,", "\r\n", "日本"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 120)))
        assert lr.judge(text)[:6] == by_hand(text)


def test_line_rules():
    good = "Plain words make a line of ordinary prose, with a comma and a stop."
    assert not lr.line_fails(good.encode(), 14)
    for bad in ("WHAT!! NOW!! BUY!! IT!!", "THIS LINE SHOUTS AT EVERY READER", "a$$$ b### c*** d",
                "home | news | sport | about | more", "Please read our Privacy Policy today"):
        assert lr.line_fails(bad.encode(), len(bad.split())), bad


def test_a_phrase_in_a_long_line_is_no_boilerplate():
    words = ["plain"] * 900
    text = " ".join(words[:400] + ["read", "more"] + words[400:])
    assert not lr.line_fails(text.encode(), 902)
    assert lr.judge(text)[7] == 902 and lr.clean_text(text) == text
    for n, fails in ((11, True), (12, False)):  # two words of 13, of 14
        line = " ".join([f"w{i}" for i in range(n)] + ["Read More"])
        assert lr.line_fails(line.encode(), n + 2) is fails


def test_documents_that_lose_too_much_go():
    rng = random.Random(7)
    prose = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12)) + "." for _ in range(10)]
    nav = ["home | news | sport | about | more"] * 1
    assert lr.judge("\n".join(prose + nav))[6]
    shout = [x.upper() for x in prose]
    assert not lr.judge("\n".join(prose[:4] + shout))[6]
    assert lr.clean_text("\n".join(prose[:2] + shout)) == "\n".join(prose[:2])
    assert lr.clean_text(None) is None


def test_table(make_docs):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "w " * 100_000), (4, "w " * 100_000)]
    docs = make_docs(rows).withColumnRenamed("lang", "n_words")
    got = lr.measure(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in got) == [
        (0, 2, False), (1, 0, False), (2, 0, False), (4, 100_000, False), (4, 100_000, False)]
    assert lr.measure(make_docs([])).count() == 0
