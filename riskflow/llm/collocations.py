"""Phrase collocations by dynamic itemset counting.

Texts are cut into pieces and words once and written, as 64-bit word hashes, in ``SHARDS`` shards.
Scans go through the shards in a cycle. Single words are counted from the first step on; a longer
phrase becomes active as soon as both its subphrases (without the last and without the first
word) have reached the threshold in what was counted so far, and is counted for one full cycle from
there, wherever in the cycle that starts; so lengths are interleaved, and a count is exact once its
cycle is complete. The loop ends when every cycle that was started is complete.

Tasks learn the step at which a phrase reached the threshold from a Bloom filter of ``CELLS`` bytes
that hold steps (its size does not depend on the corpus). A cell keeps the first step it was set
in, so the step read for a phrase is the same in every scan. A false hit may name a step before the
phrase itself was active; it then stands for the step the phrase became active, as nothing was counted
before. So a false hit only makes phrases active that cannot reach the threshold, or others earlier, and
every count still covers one full cycle.

A task adds up the counts of its chunks, ``_PHRASES`` phrases at a time. They travel as arrays of word
hashes and numbers, one row per language, length and bucket of phrase hashes; a bucket's rows are added
up in one task. Up to ``COMMON`` words that were frequent in the first shard travel as numbers, all others as hashes. There is a bucket for every ``BUCKET_WORDS`` words of the corpus, and a phrase adds at
most one entry per such sum, so neither the corpus nor a hot phrase swells a bucket. Two words of one language with equal 64-bit hashes would be taken for one word.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, remove_path, scratch_path
from .common import materialize, salted_join, ship
from .wordhash import mix, spread_hashes, word_bounds

SHARDS, LONGEST, THRESHOLD, TOP = 2, 5, 100, 2000
#: Bytes of the filter (a power of two).
CELLS = 1 << 24
#: Words of one row of sequences, and of the rows that are counted together; bytes of text that are
#: gathered per language, and in all.
ROW_WORDS, _TOGETHER, _GATHER, _HELD = 1 << 16, 1 << 20, 1 << 23, 3 << 24
_SLICE = 1 << 20
#: Phrases whose counts a task holds and adds up before it sends them on.
_PHRASES = 1 << 20
#: Words that a task of a scan should read at least, where that leaves every core a task: the more words
#: a task adds up, the fewer counts are sent.
TASK_WORDS = 1 << 22
#: Frequent words that every task knows by number (8 bytes each); the others travel as hashes.
COMMON = 1 << 20
#: Words of the corpus per bucket of phrases.
BUCKET_WORDS = 1 << 20
SALTS = 8
#: Rows hold up to a few MB, so the writer looks at its buffers after each row, not after the first 100.
_FEW_LARGE_ROWS = {"parquet.block.size": str(1 << 25), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
                   "parquet.block.size.row.check.max": "8", "parquet.page.size.row.check.max": "8", "parquet.enable.dictionary": "false", "compression": "zstd"}
_NEVER = 255
_MULT = np.uint64(0x9FB21C651E98DF25)
#: Marks that end a piece become line feeds, tabs become spaces; the rest are letters of words.
_MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")


def _slices(data: bytes):
    """``data`` cut at blanks and line feeds into slices of about ``_SLICE`` bytes."""
    at = 0
    while at < len(data):
        end = min(at + _SLICE, len(data))
        while end < len(data) and data[end] not in b" \n":
            end += 1
        yield data[at:end]
        at = end


def sequence(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Word hashes of a text in order, with 0 between pieces; hashes, counts and texts of its
    distinct words."""
    out, words, broken = [], [], False
    for part in _slices(data.lower().translate(_MARKS)):
        buf = np.frombuffer(part, np.uint8)
        starts, ends = word_bounds(buf)
        if not len(starts):
            broken = broken or b"\n" in part
            continue
        hashes = spread_hashes(buf, starts, ends)
        hashes[hashes == 0] = 1
        line = np.cumsum(buf == 10)
        new = np.append(broken or line[starts[0]] > 0, line[starts[1:]] != line[starts[:-1]])
        seq = np.zeros(len(hashes) + int(new.sum()), np.uint64)
        seq[np.arange(len(hashes)) + np.cumsum(new)] = hashes
        broken = line[-1] > line[starts[-1]]
        out.append(seq)
        unique, first, count = np.unique(hashes, return_index=True, return_counts=True)
        words.append((unique, count, [part[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), []
    hashes, counts = np.concatenate([w[0] for w in words]), np.concatenate([w[1] for w in words])
    texts = [x for w in words for x in w[2]]
    unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    return np.concatenate(out), unique, np.bincount(back, counts).astype(np.int64), [texts[i] for i in first.tolist()]


def _seed(lang: str) -> np.uint64:
    return mix(np.array([zlib.crc32(lang.encode("utf-8", "surrogatepass")) + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]


def _keys(words: np.ndarray, lang: str) -> np.ndarray:
    """One key per row of ``words`` (phrases x words)."""
    key = mix(words[:, 0] ^ _seed(lang))
    for k in range(1, words.shape[1]):
        key = mix(key * _MULT + words[:, k])
    return key


def _places(key: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(cells - 1)
    return (key & mask).astype(np.int64), (key >> np.uint64(32) & mask).astype(np.int64)


def _step_of(key: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """First step for which the phrases were known to have reached the threshold, or _NEVER."""
    a, b = _places(key, len(cells))
    return np.maximum(cells[a], cells[b])


def count_active(w: np.ndarray, own: np.ndarray, lang: str, cells: np.ndarray, step: int, shards: int) -> list:
    """(words, active from, count) of the phrases of two words or more that are active in this step and
    start at an ``own`` place of the sequence: one entry per length, words as a matrix."""
    out = []
    n = len(w)
    key = mix(w ^ _seed(lang))
    known = np.where(w != 0, _step_of(key, cells), np.uint8(_NEVER))
    for k in range(2, LONGEST + 1):
        # places whose phrase of k - 1 words, and the one that starts a word later, are known
        both = np.maximum(known[:-1], known[1:])
        at = np.flatnonzero(both <= step)
        if not len(at):
            break
        since = both[at]
        longer = mix(key[at] * _MULT + w[at + k - 1])
        active = np.flatnonzero((since.astype(np.int64) + shards > step) & own[at])
        if len(active):
            _, first, count = np.unique(longer[active], return_index=True, return_counts=True)
            first = active[first]
            out.append((w[at[first][:, None] + np.arange(k)], since[first], count))
        if k == LONGEST:
            break
        key = np.zeros(n - k + 1, np.uint64)
        known = np.full(n - k + 1, _NEVER, np.uint8)
        # not before the phrase itself was active: what is counted from there on would miss a part of the cycle
        key[at], known[at] = longer, np.maximum(_step_of(longer, cells), since)
    return out


def _binary(words: np.ndarray) -> pa.Array:
    """Rows of a matrix of hashes as binary values."""
    return _cut(words, np.arange(len(words) + 1))


def _cut(rows: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """``rows`` between successive bounds as binary values."""
    width = rows.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    offsets = np.asarray(bounds * width, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _array(value, kind) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers compressed by the significance of their bytes, so that small ones cost little."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _numbers(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


_NONE = np.empty(0, np.uint64)


def _squeezed(words: np.ndarray, common: np.ndarray = _NONE) -> bytes:
    """Rows of words: their distinct hashes, as differences (of places in the sorted hashes ``common``, where
    they are among these), then every word's place among them."""
    unique, at = np.unique(words, return_inverse=True)
    found = np.searchsorted(common, unique)
    shared = np.zeros(len(unique), bool)
    inside = found < len(common)
    shared[inside] = common[found[inside]] == unique[inside]
    ranks = _packed(np.diff(found[shared], prepend=0).astype(np.uint32))
    hashes = _packed(np.diff(unique[~shared], prepend=np.uint64(0)))
    kind, mark = (np.uint16, b"s") if len(unique) <= 1 << 16 else (np.uint32, b"l")
    places = _packed(at.reshape(words.shape).T.astype(kind).ravel())
    return mark + len(ranks).to_bytes(4, "little") + len(hashes).to_bytes(4, "little") + ranks + hashes + places


def _words_of(value, k: int, common: np.ndarray = _NONE) -> np.ndarray:
    data = value.as_py()
    cut = 9 + int.from_bytes(data[1:5], "little")
    end = cut + int.from_bytes(data[5:9], "little")
    ranks, hashes = _numbers(data[9:cut], np.uint32), _numbers(data[cut:end], np.uint64)
    unique = np.sort(np.concatenate([common[np.cumsum(ranks, dtype=np.int64)], np.cumsum(hashes, dtype=np.uint64)]))
    return unique[_numbers(data[end:], np.uint16 if data[:1] == b"s" else np.uint32)].reshape(k, -1).T


_SHARD = "shard int, lang string, seq binary, own int, words binary, n binary, texts binary, total long"


def _write_shards(docs: DataFrame, lang_col: str, text_col: str, path: str) -> None:
    """``path``: parquet partitioned by shard with rows of word hashes (lang, seq, own) and rows of counted
    words (lang, words, n, texts, total), many words a row."""
    names = ["shard", "lang", "seq", "own", "words", "n", "texts", "total"]

    def run(batches):
        turn = TaskContext.get().partitionId()
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def row(lang, **values):
            kinds = (pa.int32(), pa.string(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
            values |= {"shard": turn % SHARDS, "lang": lang}
            return pa.RecordBatch.from_arrays([pa.array([values.get(c)], k) for c, k in zip(names, kinds)], names=names)

        def flush(lang):
            nonlocal turn
            seq, hashes, count, words = sequence(b"\n".join(held.pop(lang)))
            size.pop(lang)
            for at in range(0, len(seq), ROW_WORDS):
                yield row(lang, seq=seq[at:at + ROW_WORDS + LONGEST - 1].tobytes(), own=min(ROW_WORDS, len(seq) - at))
                turn += 1
            for at in range(0, len(hashes), ROW_WORDS):
                part = slice(at, at + ROW_WORDS)
                yield row(lang, words=hashes[part].tobytes(), n=count[part].tobytes(), texts=b"\n".join(words[part]), total=int(count[part].sum()))

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                if size[lang] > _GATHER:
                    yield from flush(lang)
                elif sum(size.values()) > _HELD:
                    for x in list(held):
                        yield from flush(x)
        for x in list(held):
            yield from flush(x)

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows.mapInArrow(run, _SHARD).write.options(**_FEW_LARGE_ROWS).partitionBy("shard").parquet(path)


_COUNTS = "bucket int, lang string, k int, words binary, since binary, n binary, known binary"


def _dealt(lang: str, words: np.ndarray, since: np.ndarray, n: np.ndarray, buckets: int, common: np.ndarray) -> pa.RecordBatch:
    """New counts of phrases of one length, one row per bucket of their hashes."""
    which = ((_keys(words, lang) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((words[:, 0], which))
    ids, starts = np.unique(which[order], return_index=True)
    bounds = np.append(starts, len(order))
    never = np.full(len(order), _NEVER, np.uint8)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array([lang] * len(ids)), pa.array(np.full(len(ids), words.shape[1], np.int32)), pa.array([_squeezed(words[order[a:b]], common) for a, b in zip(bounds, bounds[1:])], pa.binary()),
         _cut(since[order].astype(np.uint8), bounds), pa.array([_packed(n[order[a:b]].astype(np.int64)) for a, b in zip(bounds, bounds[1:])], pa.binary()), _cut(never, bounds)],
        names=["bucket", "lang", "k", "words", "since", "n", "known"])


def summed(lang: str, words: np.ndarray, since: np.ndarray, n: np.ndarray, known: np.ndarray) -> tuple:
    """(words, since, n, known, keys) of the distinct rows of ``words``: counts are added, steps are the first."""
    key = _keys(words, lang)
    order = np.argsort(key, kind="stable")
    new, rows = key[order][1:] != key[order][:-1], words[order]
    other = (rows[1:] != rows[:-1]).any(axis=1)
    if (other & ~new).any():  # two phrases of one key: sort by the words as well
        order = np.lexsort((*words.T, key))
        rows = words[order]
        other = (rows[1:] != rows[:-1]).any(axis=1)
    first = np.flatnonzero(np.append(True, other))
    at = order[first]
    return words[at], np.minimum.reduceat(since[order], first), np.add.reduceat(n[order], first), np.minimum.reduceat(known[order], first), key[at]


def _scan(shard: DataFrame, cells, common, step: int, buckets: int, tasks: int) -> DataFrame:
    """New counts of one step: the shard's words in the first cycle, and its active phrases."""
    shards, together, most = SHARDS, _TOGETHER, _PHRASES

    def count(lang, rows):
        # a 0 after every row keeps phrases inside it; words that only look ahead are not own
        w = np.concatenate([x for seq, _ in rows for x in (seq, np.zeros(1, np.uint64))])
        own = np.concatenate([np.arange(len(seq) + 1) < n for seq, n in rows])
        return count_active(w, own, lang, cells.value, step, shards)

    def count_words(lang, rows):
        words, n = np.concatenate([w for w, _ in rows]), np.concatenate([n for _, n in rows])
        return [(words[:, None], np.zeros(len(words), np.uint8), n)]

    def run(batches):
        held: dict[tuple[str, bool], list] = {}
        size: dict[tuple[str, bool], int] = {}
        sums: dict[tuple[str, int], list] = {}

        def add_up():
            for (lang, k), parts in sums.items():
                words, since, n = (np.concatenate(x) for x in zip(*parts))
                parts[:] = [summed(lang, words, since, n, np.zeros(len(n), np.uint8))[:3]]
            return sum(len(parts[0][0]) for parts in sums.values())

        def send():
            for lang, k in list(sums):
                yield _dealt(lang, *sums.pop((lang, k))[0], buckets, common.value)

        def flush(what):
            size.pop(what)
            for found in (count if what[1] else count_words)(what[0], held.pop(what)):
                sums.setdefault((what[0], found[0].shape[1]), []).append(found)
            if sum(len(x[0]) for parts in sums.values() for x in parts) > most and add_up() > most * 3 // 4:
                yield from send()

        for b in batches:
            for lang, seq, own, words, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3), b.column(4)):
                what = lang, own is not None
                row = (_array(seq, np.uint64).copy(), own) if what[1] else (_array(words, np.uint64).copy(), _array(n, np.int64).copy())
                held.setdefault(what, []).append(row)
                size[what] = size.get(what, 0) + len(row[0])
                if size[what] >= together:
                    yield from flush(what)
                elif sum(size.values()) >= 4 * together:
                    for x in list(held):
                        yield from flush(x)
        for x in list(held):
            yield from flush(x)
        add_up()
        yield from send()

    if step == 0:
        shard = shard.where("own IS NULL")
    elif step >= SHARDS:
        shard = shard.where("own IS NOT NULL")
    return shard.select("lang", "seq", "own", "words", "n").coalesce(tasks).mapInArrow(run, _COUNTS)


def _add_up(rows: DataFrame, common, step: int, threshold: int) -> DataFrame:
    """Sums of a step, per bucket: what is over (its cycle is complete) and frequent, and what goes on; ``fresh``
    holds the keys of the phrases that have just reached the threshold."""
    shards, longest, most = SHARDS, LONGEST, ROW_WORDS
    names = ["bucket", "lang", "k", "over", "words", "since", "n", "known", "fresh"]

    def merge(table):
        parts: dict[tuple[str, int], list] = {}
        for lang, k, *blobs in zip(table["lang"].to_pylist(), table["k"].to_pylist(), *(table[c] for c in ("words", "since", "n", "known"))):
            words, since, n, known = blobs
            parts.setdefault((lang, k), []).append([_words_of(words, k, common.value), _array(since, np.uint8), _numbers(n.as_py(), np.int64), _array(known, np.uint8)])
        bucket, out = table["bucket"][0].as_py(), []
        for (lang, k), found in parts.items():
            words, since, n, known, key = summed(lang, *(np.concatenate(x) for x in zip(*found)))
            # known: the first step whose scan may use it
            known = np.where((known == _NEVER) & (n >= threshold), np.uint8(step + 1), known)
            over = since.astype(np.int64) + shards <= step + 1
            for done, which in ((True, np.flatnonzero(over & (n >= threshold))), (False, np.flatnonzero(~over))):
                which = which[np.argsort(words[which, 0], kind="stable")]
                for at in (which[i:i + most] for i in range(0, len(which), most)):
                    fresh = key[at][(known[at] == step + 1) & (k < longest)]
                    out.append((bucket, lang, k, done, _squeezed(words[at], common.value), since[at].tobytes(), _packed(n[at]), known[at].tobytes(), fresh.tobytes()))
        kinds = (pa.int32(), pa.string(), pa.int32(), pa.bool_(), *[pa.binary()] * 5)
        return pa.table([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)

    return rows.groupBy("bucket").applyInArrow(merge, "bucket int, lang string, k int, over boolean, words binary, since binary, n binary, known binary, fresh binary")


def _cells_of(rows: DataFrame, size: int) -> list:
    """(block, bits) of the filter's cells of fresh phrases; at most ``CELLS / 32768`` rows of 4 KB."""

    def run(batches):
        for b in batches:
            for keys in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_places(_array(keys, np.uint64), size)))], names=["cell"])

    cells = rows.select("fresh").where("length(fresh) > 0").mapInArrow(run, "cell long").distinct()
    return (cells.groupBy(F.bitmap_bucket_number(F.col("cell") + 1).alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("cell") + 1)).alias("bits")).collect())


def _common(rows: DataFrame, buckets: int, threshold: int) -> np.ndarray:
    """Sorted hashes of single words that reached the threshold, up to about ``COMMON`` in all."""
    each = -(-COMMON // buckets)

    def run(batches):
        left: dict[int, int] = {}
        for b in batches:
            for bucket, words, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                words, n = _words_of(words, 1)[:, 0], _numbers(n.as_py(), np.int64)
                at = np.flatnonzero(n >= threshold)
                at = at[np.argsort(-n[at], kind="stable")][:left.get(bucket, each)]
                left[bucket] = left.get(bucket, each) - len(at)
                yield pa.RecordBatch.from_arrays([pa.array([words[at].tobytes()], pa.binary())], names=["words"])

    found = rows.where("k = 1").select("bucket", "words", "n").mapInArrow(run, "words binary").where("length(words) > 0").collect()
    return np.unique(np.concatenate([_NONE, *(np.frombuffer(r["words"], np.uint64) for r in found)]))


def _rows_of(counts: DataFrame, common) -> DataFrame:
    """One row per phrase: lang, words, n."""

    def run(batches):
        for b in batches:
            for lang, k, words, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                n = _numbers(n.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), _binary(_words_of(words, k, common.value)), pa.array(n)], names=["lang", "words", "n"])

    return counts.select("lang", "k", "words", "n").mapInArrow(run, "lang string, words binary, n long")


def _spelled(prepared: DataFrame, needed: DataFrame) -> DataFrame:
    """(lang, w, word) of the words ``needed`` (lang, w), and of few others: tasks learn the needed ones from a
    filter of ``CELLS`` bytes and spell each once."""
    size = CELLS

    def places(batches):
        for b in batches:
            for lang, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                key = _keys(np.frombuffer(w, np.uint64)[:, None], lang)
                yield pa.RecordBatch.from_arrays([pa.array([key.tobytes()], pa.binary())], names=["fresh"])

    held = np.full(size, _NEVER, np.uint8)
    for block, bits in _cells_of(needed.mapInArrow(places, "fresh binary"), size):
        held[(block - 1) * 32768 + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))] = 0
    cells = prepared.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        spelled: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, words, texts in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                words = _array(words, np.uint64)
                old = spelled.get(lang, words[:0])
                at = np.flatnonzero((_step_of(mix(words ^ _seed(lang)), cells.value) != _NEVER) & ~np.isin(words, old))
                spelled[lang] = np.concatenate([old, words[at]])
                texts = texts.split(b"\n")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), _binary(words[at][:, None]), pa.array([texts[i].decode("utf-8", "replace") for i in at.tolist()], pa.string())],
                    names=["lang", "w", "word"])

    found = prepared.where("own IS NULL").select("lang", "words", "texts").mapInArrow(run, "lang string, w binary, word string")
    words = materialize(found.groupBy("lang", "w").agg(F.max("word").alias("word")))
    cells.destroy()
    return words


def _part(spark, path: str) -> DataFrame:
    """Counts under ``path``; none where no row of the step went there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], _COUNTS)
    return spark.read.schema(_COUNTS).parquet(path)


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """(phrases, totals, prepared, root): (lang, words, n) of every phrase of up to ``LONGEST`` words that
    occurs ``threshold`` times, with its exact count, (lang, total) words of every language, the
    prepared shards, and the folder that holds them, which the caller removes."""
    spark = docs.sparkSession
    ship(spark)
    ensure_checkpoint_dir(spark)
    root = scratch_path(spark, "collocations")
    _write_shards(docs, lang_col, text_col, f"{root}/shards")
    prepared = spark.read.schema(_SHARD).parquet(f"{root}/shards")
    totals = materialize(prepared.where("own IS NULL").groupBy("lang").agg(F.sum("total").alias("total")))
    total = totals.agg(F.sum("total")).first()[0] or 0
    buckets = 1 + total // BUCKET_WORDS
    tasks = max(spark.sparkContext.defaultParallelism, total // (SHARDS * TASK_WORDS))
    cells = np.full(CELLS, _NEVER, np.uint8)
    state, done, step, last = None, None, 0, SHARDS - 1
    common = spark.sparkContext.broadcast(_NONE)
    while step <= last:
        shared = spark.sparkContext.broadcast(cells)
        rows = _scan(prepared.where(F.col("shard") == step % SHARDS), shared, common, step, buckets, tasks)
        if state is not None:
            rows = rows.unionByName(state)
        path = f"{root}/step={step}"
        _add_up(rows, common, step, threshold).write.options(**_FEW_LARGE_ROWS).partitionBy("over").parquet(path)
        shared.destroy()
        if step:
            remove_path(spark, f"{root}/step={step - 1}/over=false")
        now = spark.read.schema(_COUNTS + ", fresh binary, over boolean").parquet(path)
        found = _cells_of(now, len(cells))
        for block, bits in found:
            on = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
            at = (block - 1) * 32768 + on
            cells[at] = np.minimum(cells[at], step + 1)
        if found:
            last = max(last, step + SHARDS)
        complete = _part(spark, f"{path}/over=true")
        done = complete if done is None else done.unionByName(complete)
        state = _part(spark, f"{path}/over=false")
        if step == 0:  # what was written before holds no place in it, and can be read with any
            common = spark.sparkContext.broadcast(_common(now, buckets, threshold))
        step += 1
    return materialize(_rows_of(done, common)), totals, prepared, root


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP, threshold: int = THRESHOLD) -> DataFrame:
    """The ``top`` collocations of every language: lang, rank, phrase, a, l, r, n, score.

    Phrases of 2 to ``LONGEST`` words that occur at least ``threshold`` times within pieces are scored by
    their weakest cut, ``floor(1000 * a * n / (l * r))`` in exact decimal arithmetic; phrases inside a
    longer one that is as frequent are left out. Null languages are ``und``, null texts empty; texts of
    any length are taken whole; equal documents count each; further columns are ignored. Ties of score
    and count go by the phrase's bytes. An empty table gives no rows."""
    phrases, totals, prepared, root = frequent_phrases(docs, threshold, lang_col, text_col)
    long = phrases.where(F.length("words") > 8).select("lang", "words", F.col("n").alias("a"), (F.length("words") / 8).cast("int").alias("k"))
    # inside a longer phrase that is as frequent
    spans = F.expr("flatten(transform(sequence(2, k - 1), j -> transform(sequence(0, k - j), i -> substring(words, i * 8 + 1, j * 8))))")
    inner = (long.where("k > 2").select("lang", F.explode(spans).alias("words"), "a")
             .groupBy("lang", "words").agg(F.max("a").alias("outer_a")))
    kept = long.join(inner, ["lang", "words"], "left").where("outer_a IS NULL OR outer_a < a").drop("outer_a")
    kept = materialize(kept)
    cuts = kept.select("lang", "words", "a", F.explode(F.expr("sequence(1, k - 1)")).alias("j")).select(
        "lang", "words", "a", "j", F.expr("substring(words, 1, j * 8)").alias("first"), F.expr("substring(words, j * 8 + 1)").alias("rest"))
    left = phrases.select("lang", F.col("words").alias("first"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("words").alias("rest"), F.col("n").alias("r"))
    spread = F.xxhash64("words")
    cuts = salted_join(salted_join(cuts, left, ["lang", "first"], spread, SALTS), right, ["lang", "rest"], spread, SALTS)
    cuts = salted_join(cuts, totals, ["lang"], spread, SALTS).withColumn(
        "score", F.expr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(total AS DECIMAL(17,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"))
    best = (cuts.groupBy("lang", "words").agg(F.min(F.struct("score", "j", "a", "l", "r", "total")).alias("b"))
            .select("lang", "words", "b.*").withColumnRenamed("total", "n"))
    # counts travel as numbers only; words are spelled at the end, where score and count leave a phrase a chance
    chance = F.rank().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc()))
    best = materialize(best.withColumn("chance", chance).where(F.col("chance") <= top).drop("chance"))
    spelled = best.select("lang", "words", F.posexplode(F.expr("transform(sequence(0, length(words) div 8 - 1), i -> substring(words, i * 8 + 1, 8))")).alias("at", "w"))
    words = _spelled(prepared, spelled.select("lang", "w").distinct())
    remove_path(prepared.sparkSession, root)
    spelled = (salted_join(spelled, words, ["lang", "w"], F.xxhash64("words"), SALTS).groupBy("lang", "words")
               .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"))
               .select("lang", "words", F.array_join("parts.word", " ").alias("phrase")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    return (best.join(spelled, ["lang", "words"]).withColumn("rank", rank).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
