"""Secret scan: fixed patterns plus strings that a dictionary-primed compressor cannot shrink.

Base patterns (assign, access, hex) are applied to the whole text. The method adds ``novel``
spans: candidate strings in a sensitive context are compressed with zstandard behind a
dictionary of code and identifier words and of the text around them; a candidate whose marginal
compressed bytes come near its length carries information that neither holds, like a key.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import ship

KINDS = ("assign", "access", "hex", "novel")
#: Characters of text on each side that prime the compressor, beside the dictionary.
AROUND = 256
#: Characters between a sensitive word's end and a candidate's start at most.
CONTEXT = 48
#: Marginal compressed bytes per character from which a candidate is reported, and its length.
MIN_NOVELTY, MIN_LENGTH = 0.77, 20
PART = 32

# The base patterns (keywords in either case; lengths are checked afterwards).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Words of code and identifiers that prime the compressor.
IDENTIFIERS = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "public static void private protected return import from class def self this new function "
    "const let var string int float double bool true false null none if else for while try "
    "except catch finally throw raise async await package module export default interface "
    "http:// https:// www. .com .org .net .html .json .yaml .xml .py .js example localhost "
    "config configuration settings environment variable database connection username user "
    "password passwd secret token api_key apikey access_key client_id client_secret session "
    "credential authorization bearer basic signature certificate private_key public_key "
    "get set put post delete update create read write open close start stop begin end index "
    "value name type size length count list array map object buffer stream file path url"
)
# Words that make a context sensitive.
SENSITIVE = ["api key", "apikey", "api_key", "auth", "bearer", "credential", "passphrase", "passwd",
             "password", "private key", "pwd", "secret", "signature", "token"]

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
# a maximal run of hex digits of the least length is the same as a long enough match of HEX
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
_KEYS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
_SENSITIVE = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE | re.ASCII)
_SENSITIVE_BYTES = [x.encode() for x in SENSITIVE]
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
# what stands between the lines of one block: a line break (or a written one) and quoting
_GAP = re.compile(r"""[\s"'`,\\>#*|]*[\n\r\\][\s"'`,\\>#*|]*""")
_DICT = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _packed(data: bytes) -> int:
    return len(zstandard.ZstdCompressor(level=9, dict_data=_DICT, write_content_size=False,
                                        write_checksum=False, write_dict_id=False).compress(data))


def novelty(before: str, candidate: str, after: str) -> float:
    """Marginal compressed bytes of a candidate between its neighbours, per character.

    Long candidates are measured in parts of about ``PART`` characters and averaged: beyond
    that the compressor's entropy stage shrinks random text too, down to its alphabet."""
    near = (before[-AROUND:] + " " + after[:AROUND] + " ").encode("utf-8", "surrogatepass")
    parts = max(1, len(candidate) // PART)
    cuts = [len(candidate) * i // parts for i in range(parts + 1)]
    alone = _packed(near)
    return sum(_packed(near + candidate[a:b].encode()) - alone for a, b in zip(cuts, cuts[1:])) / len(candidate)


def base_spans(text: str, data: bytes | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns in code points, by start, then kind as listed."""
    low = (data if data is not None else text.encode("utf-8", "surrogatepass")).lower()
    out = []
    if any(k in low for k in _KEYS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text)
                if len(m[2]) >= MIN_ASSIGN]
    if b"akia" in low:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)
                if len(m[0]) >= MIN_ACCESS]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _blocks(text: str) -> Iterator[tuple[list[tuple[int, int]], int, tuple[int, int]]]:
    """Every maximal candidate string with the lines of its block and its place among them."""
    blocks = []
    for m in _CANDIDATE.finditer(text):
        last = blocks[-1][-1][1] if blocks else None
        if last is not None and m.start() - last <= CONTEXT and _GAP.fullmatch(text, last, m.start()):
            blocks[-1].append(m.span())
        else:
            blocks.append([m.span()])
    for lines in blocks:
        for line, span in enumerate(lines):
            yield lines, line, span


def novel_spans(text: str, taken: list[tuple[str, int, int]], data: bytes | None = None) -> list[tuple[str, int, int]]:
    """Incompressible candidates in a sensitive context that touch no base span."""
    low = (data if data is not None else text.encode("utf-8", "surrogatepass")).lower()
    if not any(k in low for k in _SENSITIVE_BYTES):
        return []
    words = [m.span() for m in _SENSITIVE.finditer(text)]
    ends = [e for _, e in words]
    marks = sorted((s, e) for _, s, e in taken)
    starts, furthest = [s for s, _ in marks], list(accumulate((e for _, e in marks), max))
    out, block = [], None

    def touches(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return before > 0 and furthest[before - 1] > start

    def fits(start: int, end: int) -> bool:
        if end - start < MIN_LENGTH or touches(start, end):
            return False
        # a block's lines are held against the text around the block, not against each other
        before = lines[0][0] if line else start
        after = end if line == len(lines) - 1 else lines[-1][1]
        return novelty(text[max(0, before - AROUND):before], text[start:end], text[after:after + AROUND]) >= MIN_NOVELTY

    for lines, line, (start, end) in _blocks(text):
        at = bisect_right(ends, start)
        near = at > 0 and start - ends[at - 1] <= CONTEXT
        # the next line of an accepted block, as in a key file
        near = near or (line > 0 and block == lines[line - 1][1])
        inside = words[at:bisect_right(ends, end)]
        if not near and not inside:
            continue
        # the whole string, what follows the first sensitive word in it, or the strings between such words
        whole = [(start, end)] * near + [(e, end) for _, e in inside[:1]]
        found = next(([span] for span in whole if fits(*span)), None)
        if found is None:
            stops = [s for s, _ in inside[1:]] + [end]
            found = [(e, stop) for (_, e), stop in zip(inside, stops) if fits(e, stop)]
        out += [("novel", *span) for span in found]
        if found or touches(start, end):
            block = end
    return out


def scan_text(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and all spans of a text (null: empty), both by start, then kind as listed."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    base = base_spans(text, data)
    more = novel_spans(text, base, data)
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]))) if more else base


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


SCHEMA = ("n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts per kind, digest of the base spans, all spans.

    Null and empty texts have no spans; repeated rows are scanned alike; an empty table gives
    no rows. Offsets are code points, ends exclusive. Memory holds one Arrow batch."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                base, spans = scan_text(text)
                n = [sum(k == kind_ for k, _, _ in spans) for kind_ in KINDS]
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))],
                names=[id_col, *names])

    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64()] * len(KINDS) + [pa.string()] * 2
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")
