"""Line-first cleaning: rules judge single lines, then documents that lose too much go.

A line with a word fails when it shouts or is mostly symbols (punctuation rules), lists short
entries between bars or arrows (navigation rules), or consists of boilerplate phrases to the
share ``MIN_PHRASE`` of its words (a long line that mentions one does not fail). Failing lines
are removed; a document is rejected if fewer than ``MIN_LEFT`` of its words stay.
Base counts over the whole text (repeated lines and repeated three-word windows, symbols)
come with the verdict.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship
from .wordhash import shingle_hashes, word_hashes

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: A document fails if more than this percentage of its words lies in repeated windows.
MAX_REPEATED = 50
#: Share of words that must be left after line cleaning.
MIN_LEFT = 0.6
#: Punctuation rules: share of words of a line that carry a symbol, or a doubled mark; share of
#: capital letters among letters of lines of at least ``MIN_SHOUT`` letters.
MAX_SYMBOL_WORDS, MAX_MARK_WORDS, MAX_CAPITALS, MIN_SHOUT = 0.3, 0.3, 0.7, 8
#: Navigation rules: entries between separators, and the mean number of words in one.
MIN_ENTRIES, MAX_ENTRY_WORDS = 4, 3
#: Boilerplate rule: share of a line's words that lie in boilerplate phrases.
MIN_PHRASE = 0.15

# Phrases of boilerplate lines.
BOILERPLATE = [
    "all rights reserved", "click here", "cookie policy", "enable javascript", "log in to",
    "lorem ipsum", "privacy policy", "read more", "sign up for", "skip to content",
    "subscribe to our", "terms of service", "terms of use",
]

_SYMBOL_BYTES = SYMBOLS.encode()
_SYMBOL_WORD = re.compile(rb"[^\x20\x09-\x0D]*[" + re.escape(_SYMBOL_BYTES) + rb"][^\x20\x09-\x0D]*")
_MARKS = re.compile(rb"(?:!!|\?\?|\.\.\.\.)[^\x20\x09-\x0D]*(?![^\x20\x09-\x0D])")
_SEPARATOR = re.compile(b"[ \t](?:[|>]|" + "»|›|•|·".encode() + b")[ \t]")
_PHRASES = {x.encode(): len(x.split()) for x in BOILERPLATE}
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_SPACE = b" \t\n\x0b\x0c\r"


def line_fails(line: bytes, n: int, phrases: bool = True) -> bool:
    """Whether a UTF-8 line of ``n`` words (at least one) fails a rule. ``phrases`` is false
    where the text is known to hold no boilerplate phrase."""
    entries = len(_SEPARATOR.findall(line)) + 1
    if entries >= MIN_ENTRIES and n <= (MAX_ENTRY_WORDS + 1) * entries:
        return True
    if len(line.translate(None, _SYMBOL_BYTES)) < len(line):
        if len(_SYMBOL_WORD.findall(line)) > MAX_SYMBOL_WORDS * n:
            return True
    if (b"!!" in line or b"??" in line or b"...." in line) and len(_MARKS.findall(line)) > MAX_MARK_WORDS * n:
        return True
    upper = len(line) - len(line.translate(None, _UPPER))
    if upper >= MIN_SHOUT * MAX_CAPITALS:
        letters = upper + len(line) - len(line.translate(None, _LOWER))
        if letters >= MIN_SHOUT and upper > MAX_CAPITALS * letters:
            return True
    if phrases:
        low = line.lower()
        return any(x in low for x in _PHRASES) and sum(
            low.count(x) * words for x, words in _PHRASES.items()) >= MIN_PHRASE * n
    return False


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of three found at least twice, the first included."""
    if len(words) < 4:
        return 0
    windows = shingle_hashes(words, 3)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    hit = np.zeros(len(words) + 1, np.int64)
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + 3, -1)
    return int((np.cumsum(hit[:-1]) > 0).sum())


def judge(text: str | None) -> tuple[int, int, int, int, int, bool, bool, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, words_left)."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    low = data.lower()
    phrases = any(x in low for x in _PHRASES)
    total, left, lines, distinct = 0, 0, 0, set()
    for line in data.split(b"\n"):
        n = len(line.split())  # bytes split at exactly the blanks of a word's definition
        if n:
            total += n
            lines += 1
            distinct.add(line)
            if not line_fails(line, n, phrases):
                left += n
    repeated = repeated_words(word_hashes(data, lower=False))
    failed = total < MIN_WORDS or 100 * repeated > MAX_REPEATED * total
    chars = len(text) - (len(data) - len(data.translate(None, _SPACE)))
    symbols = len(data) - len(data.translate(None, _SYMBOL_BYTES))
    kept = not failed and left >= MIN_LEFT * total
    return total, chars, symbols, lines - len(distinct), repeated, failed, kept, left


def clean_text(text: str | None) -> str | None:
    """The text without failing lines; lines without a word stay. Null stays null."""
    if text is None:
        return None
    lines = [(x, len(x.split())) for x in text.encode("utf-8", "surrogatepass").split(b"\n")]
    return b"\n".join(x for x, n in lines if not n or not line_fails(x, n)).decode("utf-8", "surrogatepass")


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, words_left long")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and the counts and verdicts of ``judge``.

    Null and empty texts have no words, fail the base rule and are not kept. Repeated rows are
    judged alike. An empty table gives no rows. Memory holds one Arrow batch and the lines of
    one text."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [judge(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))],
                names=[id_col, *names])

    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.bool_() if " boolean" in x else pa.int64() for x in SCHEMA.split(", ")]
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")
