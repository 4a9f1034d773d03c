import hashlib
import random
import re
import string

from riskflow.llm import secret_scan as s


def base_by_hand(text):
    out = []
    for kind, pattern, group, least in (("assign", "(?ai)" + s.ASSIGN, 2, 6), ("access", s.ACCESS, 0, 20), ("hex", s.HEX, 0, 24)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(out, key=lambda x: (x[1], s.KINDS.index(x[0])))


def test_base_spans_match_the_patterns():
    rng = random.Random(2)
    parts = ["password", "Token", "api_key", "APIKEY", " = ", ": ", '"', "'", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "0" * 23,
             "short", "é", "\n", " ", "abcdef", "secret=abc", "xyz+/_.=-1", "ſecret=abcdefg", "toKen:longenough"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert s.base_spans(text) == base_by_hand(text)


def test_novel_strings_in_sensitive_context():
    rng = random.Random(4)
    key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(32))
    base, spans = s.scan_text(f"the authorization header bearer {key} was sent")
    assert base == [] and spans == [("novel", 32, 64)]
    assert s.scan_text(f"the header {key} was sent")[1] == []
    repeated = "config_database_connection1"
    assert s.scan_text(f"{repeated} and the bearer {repeated} again {repeated}")[1] == []


def test_base_spans_stay_and_long_keys_end_outside_the_context():
    rng = random.Random(5)
    key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(200))
    _, spans = s.scan_text(f"credential {key}.")
    assert spans == [("novel", 11, 211)]
    base, spans = s.scan_text("secret = 1f2e3d4c5b6a79880123456789abcdef")
    assert set(base) <= set(spans) and [k for k, *_ in base] == ["assign", "hex"]


def test_the_context_bounds_only_the_start_of_a_key():
    rng = random.Random(6)
    chars = string.ascii_letters + string.digits
    key = "".join(rng.choice(chars) for _ in range(40))
    head = "credential for the production billing account: "
    assert s.scan_text(head + key)[1] == [("novel", len(head), len(head) + 40)]
    far = "credential" + " " * (s.CONTEXT + 1)
    assert s.scan_text(far + key)[1] == []
    assert s.scan_text(far[:-1] + key)[1] == [("novel", 10 + s.CONTEXT, 50 + s.CONTEXT)]
    assert s.scan_text(f"x.{'y' * 60} bearer={key}")[1] == [("novel", 69, 110)]
    letters = "".join(rng.choice(string.ascii_letters) for _ in range(40))
    assert s.scan_text(f"the bearer {letters}")[1] == [("novel", 11, 51)]


def test_later_lines_of_a_key_block():
    rng = random.Random(7)
    lines = ["".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(64)) for _ in range(5)]
    head = "-----BEGIN PRIVATE KEY-----\n"
    want = [("novel", len(head) + 65 * i, len(head) + 65 * i + 64) for i in range(5)]
    assert s.scan_text(head + "\n".join(lines))[1] == want
    assert s.scan_text("\n".join(lines))[1] == []


def test_table(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "token=abcdef1"), (3, "é token=abcdef1"), (3, "é token=abcdef1"), (2 ** 60 + 1, "x" * 200_000)]
    got = s.scan(make_docs(rows).withColumnRenamed("lang", "spans")).collect()
    assert len(got) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["base_sha256"] == by[2]["base_sha256"] == by[2 ** 60 + 1]["base_sha256"] == empty
    assert by[3]["spans"] == "assign:2:15" and by[None]["spans"] == "assign:0:13"
    assert s.scan(make_docs([])).count() == 0


def test_candidates_beside_many_base_spans():
    key = "Qz7Xk2Lm9Vb4Tn8Rw3Yc6Hd1Jf5Gs0Pa"
    lines = [f'token = "{i:040x}"' for i in range(20_000)]
    text = "\n".join([*lines, f"the bearer is {key} here", *lines])
    base, spans = s.scan_text(text)
    assert len(base) == 2 * 2 * len(lines)
    assert [text[a:b] for k, a, b in spans if k == "novel"] == [key]
