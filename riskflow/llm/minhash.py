"""Document fingerprints by MinHash over five-word shingles.

A fingerprint is the signature of a text's set of distinct shingles (one hash per run of five
words, A-Z lower-cased; a shorter text is one shingle of all its words): ``PERMUTATIONS``
universal hash functions ``a * x + b mod 2^64`` with odd ``a`` permute the shingle hashes, the
smallest value of each is taken, and its upper 16 bits are kept. Signatures of many texts are
computed at once in numpy: one multiply, one add and one segmented minimum per permutation.
The share of equal positions of two signatures estimates the Jaccard similarity of their sets.

``near_duplicates`` joins signature bands in Spark and verifies Jaccard exactly. ``fingerprints``
also compares every text with an edited form that takes its second half from the next document:
documents are range-partitioned by id, and the last row of every range is sent to the next range
too, so texts are shuffled once and no window spans the corpus.

Null texts count as empty. Texts without a word have the signature of the empty set (all ones);
two of them are alike, but link with nothing in ``near_duplicates``.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, salted_join, ship
from .graph import SALTS, components
from .ngram_join import _class, _sets, _verify, classes, dealt
from .wordhash import mix, pieces, span_hashes, word_bounds

#: Shingle width in words; least Jaccard similarity of near duplicates, in per cent.
WIDTH, PERCENT = 5, 80
#: Bands and rows a band: a pair at 0.8 shares a band with probability 0.99995.
BANDS, ROWS = 25, 5
PERMUTATIONS = BANDS * ROWS
#: Shingles that one round of numpy calls holds; texts are gathered up to so many bytes.
_SHINGLES, _BYTES = 1 << 16, 1 << 19
#: Characters of text in one range, rows that bounds are drawn from per range, ranges at most.
RANGE_CHARS, DRAWN, MAX_RANGES = 4_000_000, 10, 1 << 15
SEED = 23

_RNG = np.random.default_rng(SEED)
_A = _RNG.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
_EMPTY = np.full(PERMUTATIONS, 0xFFFF, np.uint16)


def _minima(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Smallest permuted value of every segment of ``shingles``: segments x permutations."""
    out = np.empty((len(starts), PERMUTATIONS), np.uint64)
    with np.errstate(over="ignore"):
        for p in range(PERMUTATIONS):
            out[:, p] = np.minimum.reduceat(shingles * _A[p] + _B[p], starts)
    return out


def _shingles(words: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of consecutive documents (with ``counts`` words each) and their owners."""
    acc = np.zeros(len(words), np.uint64)
    length = np.zeros(len(words), np.uint64)
    ends = np.repeat(np.cumsum(counts), counts)
    left = ends - np.arange(len(words))
    with np.errstate(over="ignore"):
        for k in range(WIDTH):
            inside = left > k
            step = mix(acc * np.uint64(0x9FB21C651E98DF25) + words[np.minimum(np.arange(len(words)) + k, len(words) - 1)])
            acc = np.where(inside, step, acc)
            length += inside
        acc = mix(acc + length)
    # a run of fewer words counts only where it starts the document
    first = np.repeat(np.cumsum(counts) - counts, counts) == np.arange(len(words))
    keep = (left >= WIDTH) | first
    return acc[keep], owner[keep]


def _signatures_of(data: list[bytes]) -> np.ndarray:
    """Signatures of short texts, together."""
    joined = b"\n".join(data).lower()
    buf = np.frombuffer(joined, np.uint8)
    out = np.tile(_EMPTY, (len(data), 1))
    starts, ends = word_bounds(buf)
    if not len(starts):
        return out
    bounds = np.cumsum([len(x) + 1 for x in data])
    owner = np.searchsorted(bounds, starts, side="right")
    counts = np.bincount(owner, minlength=len(data))
    values, holder = _shingles(span_hashes(buf, starts, ends), owner, counts)
    least = np.full((len(data), PERMUTATIONS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), _SHINGLES):
        part, who = values[at:at + _SHINGLES], holder[at:at + _SHINGLES]
        first = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        least[who[first]] = np.minimum(least[who[first]], _minima(part, first))
    some = counts > 0
    out[some] = (least[some] >> np.uint64(48)).astype(np.uint16)
    return out


def _signature_of_long(data: bytes) -> np.ndarray:
    """Signature of one long text, read in pieces that overlap by the words of a shingle."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    tail, seen = np.empty(0, np.uint64), 0
    for piece in pieces(data.lower()):
        buf = np.frombuffer(piece, np.uint8)
        words = span_hashes(buf, *word_bounds(buf))
        seen += len(words)
        words = np.concatenate([tail, words])
        tail = words[-(WIDTH - 1):]
        if len(words) < WIDTH:
            continue
        values, _ = _shingles(words, np.zeros(len(words), np.int64), np.array([len(words)]))
        for at in range(0, len(values), _SHINGLES):
            part = values[at:at + _SHINGLES]
            least = np.minimum(least, _minima(part, np.zeros(1, np.int64))[0])
    if not seen:
        return _EMPTY
    if seen < WIDTH:
        values, _ = _shingles(tail, np.zeros(len(tail), np.int64), np.array([len(tail)]))
        least = _minima(values, np.zeros(1, np.int64))[0]
    return (least >> np.uint64(48)).astype(np.uint16)


def signatures(texts: list[str | None]) -> np.ndarray:
    """One row of ``PERMUTATIONS`` 16-bit values per text."""
    out = np.empty((len(texts), PERMUTATIONS), np.uint16)
    group, at, size = [], [], 0
    for i, t in enumerate(texts):
        data = (t or "").encode("utf-8", "surrogatepass")
        if len(data) > 1 << 20:
            out[i] = _signature_of_long(data)
            continue
        group.append(data)
        at.append(i)
        size += len(data)
        if size > _BYTES:
            out[at] = _signatures_of(group)
            group, at, size = [], [], 0
    if group:
        out[at] = _signatures_of(group)
    return out


def _hex(row: np.ndarray) -> str:
    return row.astype(">u2").tobytes().hex()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, row, text): rows in order of id (null first), text hash and place in the input."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.xxhash64(text_col), F.lit(0).cast("long")).alias("h"),
                       F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _in_order(keyed: DataFrame) -> DataFrame | None:
    """``keyed`` with ``part`` and ``own``, sorted within Spark partitions by both and the key.

    A part is a range of keys whose last key is one of a bounded number of drawn ones, so the
    row before a part's first is known: it is repeated at the head of the part, with ``own``
    false. The part of the smallest keys is headed by the row of the greatest one."""
    key = F.struct(F.col("id").isNotNull().alias("some"), "id", "h", "row")
    n, chars, top = keyed.agg(F.count(F.lit(1)), F.sum(F.length("text")), F.max(key)).first()
    if not n:
        return None
    ranges = int(min(MAX_RANGES, max(1, chars // RANGE_CHARS)))
    share = F.pmod(F.xxhash64("id", "h", "row", F.lit(SEED)), F.lit(1 << 30)) <= int(min(1.0, DRAWN * ranges / n) * (1 << 30))
    drawn = sorted({tuple(r[0]) for r in keyed.where(share).select(key.alias("key")).limit(8 * DRAWN * ranges).collect()},
                   key=lambda k: (k[0], k[1] if k[0] else 0, k[2], k[3]))
    cuts = [drawn[i] for i in sorted({len(drawn) * j // ranges for j in range(1, ranges)})] if drawn else []
    last = tuple(top)
    order = [(k[0], k[1] if k[0] else 0, k[2], k[3]) for k in [*cuts, last]]
    order = sorted(set(order))

    @F.pandas_udf("long")
    def place(id: pd.Series, h: pd.Series, row: pd.Series) -> pd.Series:
        none = id.isna().tolist()
        out = []
        for no, i, a, b in zip(none, id.tolist(), h.tolist(), row.tolist()):
            k = (not no, 0 if no else i, a, b)
            part = bisect_left(order, k)
            out.append(2 * part + (order[part] == k))
        return pd.Series(out, dtype="int64")

    at = keyed.withColumn("place", place("id", "h", "row"))
    part = F.shiftright("place", 1)
    mine = F.struct(part.alias("part"), F.lit(True).alias("own"))
    after = F.struct(F.pmod(part + 1, F.lit(len(order))).alias("part"), F.lit(False).alias("own"))
    to = F.when(F.col("place") % 2 == 1, F.array(mine, after)).otherwise(F.array(mine))
    return (at.withColumn("to", F.explode(to)).select("to.part", "to.own", "id", "h", "row", "text")
            .repartition("part").sortWithinPartitions("part", "own", F.col("id").asc_nulls_first(), "h", "row"))


FINGERPRINT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars (code points), the SHA-256 of the edited text,
    both fingerprints as hex, and the likeness of the text's fingerprint to the edited text's and
    to the next document's.

    The edited text keeps all but the last ``floor(n_chars / 2)`` code points and goes on with as
    many first ones (or all) of the next document, by descending id; after the last one comes the
    first. Null ids are last, rows of one id are in descending order of a text hash; identical
    rows follow each other in any order, which gives the same set of rows. A single row is its own
    next document. An empty table gives no rows. Texts are taken whole, very long ones piece by piece."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    ordered = _in_order(_keyed(docs, id_col, text_col))
    if ordered is None:
        return spark.createDataFrame([], f"doc_id {kind}, {FINGERPRINT}")

    def rows_of(ids, texts, before, id_type):
        nexts = [before, *texts[:-1]]
        edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for t, n in zip(texts, nexts)]
        made = signatures([*texts, *edited, before])
        n = len(texts)
        own, edits, next_ = made[:n], made[n:2 * n], np.concatenate([made[2 * n:], made[:n - 1]])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_type), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
             pa.array([_hex(x) for x in own]), pa.array([_hex(x) for x in edits]),
             pa.array((own == edits).mean(axis=1)), pa.array((own == next_).mean(axis=1))],
            names=["doc_id", *(c.split()[0] for c in FINGERPRINT.split(", "))])

    def run(batches):
        # rows come in ascending order, so the next document by descending id is the row before
        before = None
        for b in batches:
            ids, texts, size = [], [], 0
            first = before
            for own, i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if own:
                    ids.append(i)
                    texts.append(text)
                    size += len(text)
                if not own or size > 4 * _BYTES:
                    if texts:
                        yield rows_of(ids, texts, first, b.schema.field(1).type)
                    ids, texts, size, first = [], [], 0, text
                before = text
            if texts:
                yield rows_of(ids, texts, first, b.schema.field(1).type)

    return ordered.select("own", "id", "text").mapInArrow(run, f"doc_id {kind}, {FINGERPRINT}")


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct set and batch: cls, n, and the bands of its signature as hashes."""

    def run(batches):
        for b in batches:
            texts, cls, n, seen, keep = b.column(0).to_pylist(), [], [], set(), []
            for t, s in zip(texts, _sets(texts)):
                c = _class(s)
                if len(s) and c not in seen:
                    seen.add(c)
                    cls.append(c)
                    n.append(len(s))
                    keep.append(t)
            if not keep:
                continue
            made = signatures(keep).reshape(len(keep), BANDS, ROWS).astype(np.uint64)
            acc = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(keep), 1))
            for k in range(ROWS):
                acc = mix(acc * np.uint64(0x9FB21C651E98DF25) + made[:, :, k])
            flat = pa.array(acc.astype(np.int64).ravel())
            at = pa.array(np.arange(0, len(keep) * BANDS + 1, BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, flat)],
                                             names=["cls", "n", "bands"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "cls long, n long, bands array<long>")


def _sets_of(docs: DataFrame, wanted: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``wanted`` (doc_id, cls, part) -> (part, cls, n, tokens): the set of each wanted class."""

    def run(batches):
        for b in batches:
            part, cls, sets = [], [], []
            for p, want, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _sets(b.column(2).to_pylist())):
                if _class(s) == want:
                    part.append(p)
                    cls.append(want)
                    sets.append(s)
            if cls:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int64()), pa.array(cls, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["part", "cls", "n", "tokens"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (texts.join(wanted, F.col("id").eqNullSafe(F.col("doc_id"))).select("part", "cls", "text")
            .mapInArrow(run, "part long, cls long, n long, tokens binary").dropDuplicates(["part", "cls"]))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id (smallest id reachable over pairs
    whose shingle sets have a Jaccard similarity of at least 0.8), class_size (rows of the class).

    Equal sets are one class from the start, so copies are never paired. Classes that share a
    signature band are tied to the band's smallest class; the sets of every group tied so are
    compared by inverted indexes, block against block, and only exact Jaccard decides. A pair at
    the threshold shares no band with probability 5e-5. Null texts and texts without a word link
    with nothing; null ids count only in a class that has no other id. Repeated rows share a class.
    An empty table gives no rows."""
    ship(docs.sparkSession)
    known = materialize(classes(docs, id_col, text_col))
    reps = known.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    bands = materialize(_signed(docs, id_col, text_col).dropDuplicates(["cls"])
                        .select("cls", F.explode("bands").alias("band")))
    hub = bands.groupBy("band").agg(F.min("cls").alias("hub"), F.max("cls").alias("other")).where("hub < other")
    ties = (salted_join(bands, hub.select("band", "hub"), ["band"], F.xxhash64("cls"), SALTS).where("cls <> hub")
            .select(F.col("cls").alias("u"), F.col("hub").alias("v")))
    parts = components(ties)
    member = parts.unionByName(parts.select(F.col("root").alias("node"), "root")).distinct()
    wanted = reps.join(member, F.col("cls") == F.col("node")).select("doc_id", "cls", F.col("root").alias("part"))
    sets = materialize(_sets_of(docs, wanted, text_col, id_col))
    ready = dealt(sets).repartition("part", "low", "high").sortWithinPartitions("part", "low", "high")
    linked = components(_verify(ready))
    root = known.join(linked, F.col("cls") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("root"))
    groups = root.where("root IS NOT NULL").groupBy(F.col("root").alias("g")).agg(
        F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("size"))
    return root.join(groups, F.col("root") == F.col("g"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("g").isNotNull(), F.col("low")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("size", F.lit(1)).alias("class_size"))
