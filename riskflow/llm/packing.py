"""Packing documents into sequences by lexical retrieval.

Documents are tokenized once and dealt into shards of about ``SHARD_TOKENS`` tokens by content:
the terms a document would ask for are projected to ``WIDTH`` numbers, and documents go to the
nearest of centroids that are fitted on a bounded sample, so that lexical neighbours of the whole
corpus meet in one shard. Small cells beside each other share a shard; a cell beyond a shard's
size (such as a large group of copies) is dealt over several. Every shard holds a BM25 inverted
index over its documents' token ids, with document frequencies and mean length taken over the
whole corpus. A sequence starts with a seed document; its unused
neighbours by BM25 fill the window one after the other, and the document that crosses the end
is cut there and becomes the next seed. So all sequences of a shard are full but the last,
which is cut into parts whose lengths are powers of two and need no padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import fit
from .common import give_back, materialize, ship
from .tokens import Encoder

WINDOW = 2048
TOKENIZER = "word_bpe_49k.json"
#: The id that ends a document.
END = 1
SHARD_TOKENS = 2_000_000
#: Terms of a seed's query (those of highest weight) and neighbours taken from one query.
QUERY_TERMS, NEIGHBOURS = 24, 16
#: Terms of more documents than this are not asked for where most documents of the shard have them.
COMMON = 1000
K1, B = 1.2, 0.75
#: Numbers of a document's projection; documents that centroids are fitted on, per shard and at most.
WIDTH, SHARD_SAMPLE, SAMPLE = 128, 64, 100_000
SEED = 11
#: Documents whose terms are counted together.
_TOGETHER = 256

_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str | None) -> Encoder:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def term_weights(tf: np.ndarray, idf: np.ndarray, length, mean: float) -> np.ndarray:
    """BM25 weights of terms by their counts in documents of these lengths."""
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def _term_counts(docs: list[np.ndarray], length: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ``document * terms + term`` of some documents, and how often each occurs; held in 32 bits
    where they suffice."""
    kind = np.uint32 if len(docs) * terms < 1 << 32 else np.int64
    pair = np.repeat(np.arange(len(docs), dtype=kind) * kind(terms), length)
    pair += np.concatenate(docs).astype(kind)
    pair, tf = np.unique(pair, return_counts=True)
    return pair.astype(np.int64), tf


def _by_weight(doc: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Order of terms by document, then falling weight: both in one number."""
    return np.argsort(doc - weight / (weight.max(initial=0.0) + 1.0), kind="stable")


def projections(docs: list[np.ndarray], idf: np.ndarray, mean: float, axes: np.ndarray) -> np.ndarray:
    """One unit vector per document: its ``QUERY_TERMS`` terms of highest weight, among those that
    another document has (``idf`` above 0), on random axes."""
    out = np.zeros((len(docs), axes.shape[1]), np.float32)
    for at in range(0, len(docs), _TOGETHER):
        some = docs[at:at + _TOGETHER]
        length = np.array([len(d) for d in some], np.int64)
        # counts of all terms of some documents at once: (document, term) as one sorted number
        pair, tf = _term_counts(some, length, len(idf))
        doc, term = np.divmod(pair, len(idf))
        weight = term_weights(tf, idf[term], length[doc], mean)
        order = _by_weight(doc, weight)
        doc, term, weight = doc[order], term[order], weight[order]
        first = np.searchsorted(doc, np.arange(len(some)))
        best = np.arange(len(doc)) - first[doc] < QUERY_TERMS
        doc, term, weight = doc[best], term[best], weight[best].astype(np.float32)
        first = np.searchsorted(doc, np.arange(len(some)))
        out[at:at + len(some)] = np.add.reduceat(axes[term] * weight[:, None], first, axis=0)
    size = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(size > 0, size, 1)


def _axes(terms: int) -> np.ndarray:
    """The random axes; made anew in every task, so that workers do not keep them."""
    return np.random.default_rng(SEED).standard_normal((terms, WIDTH), np.float32)


class Cells:
    """Two levels of centroids; cells are numbered so that those of one upper centroid adjoin."""

    def __init__(self, sample: np.ndarray, cells: int):
        upper = max(1, min(round(cells ** 0.5), len(sample)))
        self.upper = fit(sample, upper).astype(np.float32)
        near = self._nearest(sample, self.upper)
        self.lower, self.first = [], [0]
        for i in range(upper):
            inside = sample[near == i]
            wanted = max(1, min(round(cells * len(inside) / len(sample)), len(inside)))
            self.lower.append((fit(inside, wanted) if len(inside) else self.upper[i:i + 1]).astype(np.float32))
            self.first.append(self.first[-1] + wanted)

    @staticmethod
    def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
        return np.argmax(x @ centers.T - 0.5 * (centers * centers).sum(axis=1), axis=1)

    def of(self, x: np.ndarray) -> np.ndarray:
        upper = self._nearest(x, self.upper)
        out = np.zeros(len(x), np.int64)
        for i in np.unique(upper):
            mine = upper == i
            out[mine] = self.first[i] + self._nearest(x[mine], self.lower[i])
        return out


def shards_of_cells(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first shard, number of shards) of every cell by its tokens. A cell beyond
    ``SHARD_TOKENS`` has shards of its own; smaller ones share one with their neighbours."""
    first, parts, shard, filled = [], [], 0, 0.0
    for n in tokens:
        if filled and filled + n > SHARD_TOKENS:
            shard, filled = shard + 1, 0.0
        first.append(shard)
        parts.append(max(1, int(np.ceil(n / SHARD_TOKENS))))
        if parts[-1] > 1:
            shard, filled = shard + parts[-1], 0.0
        else:
            filled += n
    return np.array(first, np.int64), np.array(parts, np.int64)


class Index:
    """BM25 inverted index over the documents of a shard; ``idf`` by token id."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        length = np.array([len(d) for d in docs], np.int64)
        pair, tf = _term_counts(docs, length, len(idf))
        owner, term = np.divmod(pair, len(idf))
        weight = term_weights(tf, idf[term], length[owner], mean)
        # a query asks for the terms that weigh most and that another document of the shard has,
        # but not for those that most of its documents have, which tell nothing apart
        local = np.bincount(term, minlength=len(idf))
        useful = (local > 1) & ((2 * local <= len(docs)) | (local <= COMMON))
        asked = np.flatnonzero(useful[term] & (weight > 0))
        best = asked[_by_weight(owner[asked], weight[asked])]
        place = np.arange(len(best)) - np.searchsorted(owner[asked], np.arange(len(docs)))[owner[best]]
        best = best[place < QUERY_TERMS]
        self.query = np.split(term[best], np.searchsorted(owner[best], np.arange(1, len(docs))))
        order = np.argsort(term, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.first = np.append(0, np.cumsum(local))

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents with a term of the seed's query, best first (ties to the smaller
        place), at most ``NEIGHBOURS``."""
        spans = [slice(self.first[t], self.first[t + 1]) for t in self.query[seed]]
        if not spans:
            return np.empty(0, np.int64)
        owner = np.concatenate([self.owner[s] for s in spans])
        weight = np.concatenate([self.weight[s] for s in spans])
        free = ~used[owner]
        if 8 * len(owner) < len(used):  # few postings in a shard of many short documents
            docs, back = np.unique(owner[free], return_inverse=True)
            score = np.bincount(back, weight[free], len(docs))
        else:
            score = np.bincount(owner[free], weight[free], len(used))
            docs = np.flatnonzero(score)
            score = score[docs]
        if len(score) > 4 * NEIGHBOURS:
            near = np.flatnonzero(score >= np.partition(score, -NEIGHBOURS)[-NEIGHBOURS])
            docs, score = docs[near], score[near]
        return docs[np.argsort(-score, kind="stable")[:NEIGHBOURS]]


def order_documents(docs: list[np.ndarray], idf: np.ndarray, mean: float) -> list[int]:
    """The order in which a shard's documents fill its windows, end to end."""
    index, used = Index(docs, idf, mean), np.zeros(len(docs), bool)
    order, at, waiting, fresh = [], 0, [], 0
    while len(order) < len(docs):
        # within a window the seed's neighbours follow; a new window has the cut document as seed
        while waiting and used[waiting[0]]:
            waiting.pop(0)
        if not waiting and order:
            waiting = index.neighbours(order[-1], used).tolist()
        if waiting:
            doc = waiting.pop(0)
        else:
            while used[fresh]:
                fresh += 1
            doc = fresh
        used[doc] = True
        order.append(doc)
        before, at = at, at + len(docs[doc])
        if before // WINDOW != at // WINDOW:
            waiting = []
    return order


def cut(order: list[int], docs: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
    """Documents end to end -> pieces (doc, start, length, sequence, offset)."""
    total = sum(len(docs[d]) for d in order)
    tail = total % WINDOW
    ends = list(range(WINDOW, total + 1, WINDOW))
    for bit in reversed(range(WINDOW.bit_length())):
        if tail >> bit & 1:
            ends.append((ends[-1] if ends else 0) + (1 << bit))
    out, at, sequence, begin = [], 0, 0, 0
    for doc in order:
        start = 0
        while start < len(docs[doc]):
            length = min(len(docs[doc]) - start, ends[sequence] - at)
            out.append((doc, start, length, sequence, at - begin))
            start += length
            at += length
            if at == ends[sequence]:
                sequence, begin = sequence + 1, at
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer: str | None = None) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Null and empty texts hold only the end id. Every row of ``docs`` is packed once, repeated
    rows and null ids included. An empty table gives no rows. ``tokenizer`` is the path of the
    tokenizer's file on the executors (default: the public one named above)."""
    spark = docs.sparkSession
    ship(spark)
    id_kind = docs.schema[id_col].dataType.simpleString()

    def tokenize(batches):
        encoder = _encoder(tokenizer)
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            ids = [np.append(x, np.array([END], x.dtype)) for x in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x.tobytes() for x in ids], pa.binary()),
                 pa.array([x.dtype.itemsize == 4 for x in ids], pa.bool_()),
                 pa.array([len(x) for x in ids], pa.int64())], names=["doc_id", "ids", "wide", "tokens"])
        give_back()

    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    rows = materialize(rows.mapInArrow(tokenize, f"doc_id {id_kind}, ids binary, wide boolean, tokens long"))

    def read(data: bytes, wide: bool) -> np.ndarray:
        return np.frombuffer(data, "<u4" if wide else "<u2")

    def frequencies(batches):
        count = np.zeros(0, np.int64)
        for b in batches:
            for data, wide in zip(*(c.to_pylist() for c in b.columns)):
                terms = np.unique(read(data, wide))
                if terms[-1] >= len(count):
                    count = np.append(count, np.zeros(int(terms[-1]) + 1 - len(count), np.int64))
                count[terms] += 1
        term = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(count[term])], names=["term", "docs"])

    # one number per word of the vocabulary, whatever the size of the corpus
    df = rows.select("ids", "wide").mapInArrow(frequencies, "term long, docs long")
    df = df.groupBy("term").agg(F.sum("docs").alias("docs")).toPandas()
    if not len(df):
        return spark.createDataFrame([], f"doc_id {id_kind}, {PIECE}")
    n, total = rows.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    count = np.zeros(int(df["term"].max()) + 1)
    count[df["term"].to_numpy()] = df["docs"].to_numpy()
    idf, mean = np.log1p((n - count + 0.5) / (count + 0.5)), total / n
    shards = -(-total // SHARD_TOKENS)

    def fill(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        try:
            return packed(key, part)
        finally:
            give_back()

    def packed(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        part = part.sort_by("row")
        docs_ = [read(d, w) for d, w in zip(part["ids"].to_pylist(), part["wide"].to_pylist())]
        pieces = cut(order_documents(docs_, idf, mean), docs_)
        doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
        crc = [zlib.crc32(docs_[d][s:s + k].astype("<u4").tobytes()) for d, s, k, _, _ in pieces]
        return pa.table({"doc_id": part["doc_id"].take(pa.array(doc)), "start": start, "length": length,
                         "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": part["tokens"].take(pa.array(doc)),
                         "sequence_id": (key[0].as_py() << 32) + sequence, "offset": offset})

    # the checkpointed rows have fixed places, so a row's number is the same in every attempt
    dealt = rows.withColumn("row", F.monotonically_increasing_id())
    if shards == 1:
        dealt = dealt.withColumn("shard", F.lit(0).cast("long"))
    else:
        dealt = _by_content(dealt, read, np.where(count > 1, idf, 0.0), n, total, shards)
    return dealt.groupBy("shard").applyInArrow(fill, f"doc_id {id_kind}, {PIECE}")


def _by_content(rows: DataFrame, read, idf: np.ndarray, n: int, total: int, shards: int) -> DataFrame:
    """``rows`` with ``shard``: that of the cell nearest to the row's projection. Tokens of a cell
    are taken from the sample; rows of a cell with several shards are dealt by row number."""
    mean, terms = total / n, len(idf)

    def project(batch, axes):
        docs = [read(d, w) for d, w in zip(batch.column("ids").to_pylist(), batch.column("wide").to_pylist())]
        return projections(docs, idf, mean, axes)

    def draw(batches):
        axes = _axes(terms)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in project(b, axes)], pa.binary()), b.column("tokens")],
                                             names=["at", "tokens"])

    wanted = min(SAMPLE, SHARD_SAMPLE * shards)
    share = F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(1 << 30)) < int(min(1.0, wanted / n) * (1 << 30)) + 1
    drawn = rows.where(share).select("ids", "wide", "tokens").mapInArrow(draw, "at binary, tokens long").toPandas()
    sample = np.frombuffer(b"".join(drawn["at"]), np.float32).reshape(-1, WIDTH)
    if not len(sample):
        return rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards).cast("long")))
    cells = Cells(sample, min(shards, max(1, len(sample) // 8)))
    held = np.bincount(cells.of(sample), drawn["tokens"], cells.first[-1])
    first, parts = shards_of_cells(held * (total / max(1.0, held.sum())))

    def deal(batches):
        axes = _axes(terms)
        for b in batches:
            cell, row = cells.of(project(b, axes)), b.column("dealt").to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(first[cell] + row % parts[cell])],
                                             names=[*b.schema.names[:-1], "shard"])
        give_back()

    out = rows.withColumn("dealt", F.pmod(F.xxhash64("row"), F.lit(1 << 40)))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return out.mapInArrow(deal, f"{kinds}, shard long")


PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
