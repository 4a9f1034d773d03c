"""Vectorised word and shingle hashing over UTF-8 bytes (numpy, used inside Arrow tasks).

Words are runs of bytes outside ``\\x20 \\x09-\\x0D`` with A-Z lower-cased. Long texts are hashed
in pieces cut at white space, so memory stays bounded by the piece and the longest word.
"""

from __future__ import annotations

import numpy as np

_PIECE = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads 64-bit values so that every bit depends on all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BYTE[~_IS_WORD] = 0
_BASE = 0x2545F4914F6CDD1D
_POW = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POW
    while len(_POW) < n:
        step = _U(pow(_BASE, len(_POW), 1 << 64))
        _POW = np.concatenate([_POW, _POW * step])
    return _POW


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = _IS_WORD[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[0::2], edge[1::2]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per span; spans are in order, do not overlap, and hold no white space."""
    if not len(starts):
        return np.empty(0, np.uint64)
    body = buf[starts[0]:]
    ahead = np.diff(starts, append=len(buf))
    off = np.arange(len(body)) - np.repeat(starts - starts[0], ahead)
    table = _powers(int(ahead.max()) + 1)
    sums = np.add.reduceat(_BYTE[body] * table[off], starts - starts[0])
    return mix(sums + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


_PLACE = np.empty(0, np.uint64)


def spread_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``span_hashes``, but every byte is mixed with its place before they are added up: sums of powers
    modulo 2^64 are equal for some long regular words, such as Thue-Morse words of 1,024 letters."""
    global _PLACE
    if not len(starts):
        return np.empty(0, np.uint64)
    body = buf[starts[0]:]
    ahead = np.diff(starts, append=len(buf))
    off = np.arange(len(body)) - np.repeat(starts - starts[0], ahead)
    longest = int(ahead.max())
    if len(_PLACE) < longest:
        _PLACE = mix(np.arange(1, 2 * longest + 1, dtype=np.uint64) * _U(0xD1B54A32D192ED03))
    x = _BYTE[body] + _PLACE[off]
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _IS_WORD[body]
    sums = np.add.reduceat(x, starts - starts[0])
    return mix(sums + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def _piece_words(data: bytes) -> np.ndarray:
    buf = np.frombuffer(data, np.uint8)
    return span_hashes(buf, *word_bounds(buf))


def pieces(data: bytes):
    """A long byte text in pieces of about ``_PIECE`` bytes that end at a word's end."""
    at = 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        while end < len(data) and _IS_WORD[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(data: bytes, lower: bool = True) -> np.ndarray:
    """One 64-bit hash per word of a UTF-8 text, in order; ``lower`` ignores the case of A-Z."""
    if lower:
        data = data.lower()
    if len(data) <= _PIECE:
        return _piece_words(data)
    return np.concatenate([_piece_words(x) for x in pieces(data)])


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` words, in order; a shorter text is one run of all its words."""
    span = min(width, len(words))
    last = len(words) - span + 1
    acc = np.full(last, span, np.uint64)
    for k in range(span):
        acc = mix(acc * _U(0x9FB21C651E98DF25) + words[k:last + k])
    return acc


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; no words give an empty set."""
    if not len(words):
        return words
    out = np.sort(shingle_hashes(words, width))
    return out[np.append(True, out[1:] != out[:-1])]
