"""Token ids of many texts by a public tokenizer, with a bounded cache of words.

The tokenizer splits at white space and between letters and a closing full stop or comma, so a
text's ids are those of these parts in order. Parts are told apart by 64-bit hashes; each new
one is tokenized once per worker until the cache is full, which empties it. The cache is a few flat
arrays (about 25 bytes a word), so its size in bytes is bounded.
"""

from __future__ import annotations

import re

import numpy as np

from .wordhash import _PIECE, pieces, span_hashes, word_bounds

#: Words in the cache, and words that are looked up apart until they are merged into it.
_CACHE, _RECENT = 2_000_000, 1 << 16
#: Words of Latin-1 letters only: one unit for the tokenizer's pattern, lower-cased per letter.
_LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+")


def _byte_letters() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others for U+0100 onward in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


class Encoder:
    """Token ids without special tokens. ``path``: the tokenizer's JSON file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._empty()

    def _empty(self) -> None:
        # sorted hashes with the places of their words, twice: merged ones and recent ones
        self.known = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
        self.slot = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.words = 0
        self.start = np.zeros(1024, np.int32)
        self.size = np.zeros(1024, np.int32)
        self.flat = np.zeros(4096, self.kind)
        self.used = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of every word (sorted hashes), or -1."""
        out = np.full(len(hashes), -1, np.int32)
        for known, slot in zip(self.known, self.slot):
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                out[hit] = slot[at[hit]]
        return out

    def _keep(self, level: int, hashes: np.ndarray, slots: np.ndarray) -> None:
        known, slot = np.concatenate([self.known[level], hashes]), np.concatenate([self.slot[level], slots])
        order = np.argsort(known, kind="stable")
        self.known[level], self.slot[level] = known[order], slot[order]
        if level and len(known) > _RECENT:
            self._keep(0, self.known[1], self.slot[1])
            self.known[1], self.slot[1] = self.known[1][:0], self.slot[1][:0]

    def _add(self, hashes: np.ndarray, parts: list[bytes]) -> None:
        texts = [p.decode("utf-8", "replace") for p in parts]
        ids: list = [None] * len(texts)
        rest = []
        for i, t in enumerate(texts):
            if _LETTERS.fullmatch(t):
                word = t.lower()
                if not word.isascii():
                    word = "".join(self.letters[b] for b in word.encode())
                ids[i] = [x.id for x in self.model.tokenize(word)]
            else:
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            ids[i] = e.ids
        lens = np.array([len(x) for x in ids], np.int64)
        new = np.fromiter((t for x in ids for t in x), self.kind, int(lens.sum()))
        at, n = self.words, len(ids)
        while len(self.start) < at + n:
            self.start, self.size = np.append(self.start, np.zeros_like(self.start)), np.append(self.size, np.zeros_like(self.size))
        while len(self.flat) < self.used + len(new):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        self.start[at:at + n] = self.used + np.append(0, np.cumsum(lens)[:-1])
        self.size[at:at + n] = lens
        self.flat[self.used:self.used + len(new)] = new
        self.used += len(new)
        self.words += n
        self._keep(1, hashes, np.arange(at, at + n, dtype=np.int32))

    def _piece(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, number of ids per part, start of each part) of a piece."""
        data = data.lower()
        buf = np.frombuffer(data, np.uint8)
        starts, ends = word_bounds(buf)
        if not len(starts):
            return np.empty(0, self.kind), np.empty(0, np.int64), starts
        # a full stop or comma after a letter is a part of its own
        last, before, third = buf[ends - 1], buf[np.maximum(ends - 2, 0)], buf[np.maximum(ends - 3, 0)]
        latin = (third == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7) & (ends - starts > 2)
        cut = ((last == 0x2E) | (last == 0x2C)) & (ends - starts > 1) & (((before >= 97) & (before <= 122)) | latin)
        marks = ends[cut] - 1
        starts = np.concatenate([starts, marks])
        ends = np.concatenate([np.where(cut, ends - 1, ends), marks + 1])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
        unique, first, back = np.unique(span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        slots = self._find(unique)
        new = np.flatnonzero(slots < 0)
        if self.words + len(new) > _CACHE and self.words:
            self._empty()
            slots, new = np.full(len(unique), -1, np.int32), np.arange(len(unique))
        if len(new):
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._add(unique[new], [data[a:b] for a, b in spans])
            slots = self._find(unique)
        slots = slots[back]
        lens = self.size[slots].astype(np.int64)
        ends_at = np.cumsum(lens)
        at = np.repeat(self.start[slots] - (ends_at - lens), lens) + np.arange(int(ends_at[-1]))
        return self.flat[at], lens, starts

    def encode(self, texts: list[str | bytes | None]) -> list[np.ndarray]:
        """Ids of every text (UTF-8, if bytes), in order; null texts have none."""
        out: list = [None] * len(texts)
        group, size = [], 0

        def flush():
            data = b"\n".join(x for _, x in group)
            ids, lens, starts = self._piece(data)
            bounds = np.cumsum([len(x) + 1 for _, x in group])
            total = np.append(0, np.cumsum(lens))
            cuts = total[np.searchsorted(starts, bounds)]
            for (i, _), a, b in zip(group, np.append(0, cuts[:-1]), cuts):
                out[i] = ids[a:b]

        for i, t in enumerate(texts):
            data = t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass")
            if len(data) > _PIECE:
                out[i] = np.concatenate([self._piece(x)[0] for x in pieces(data)])
                continue
            group.append((i, data))
            size += len(data)
            if size > _PIECE:
                flush()
                group, size = [], 0
        if group:
            flush()
        return out
