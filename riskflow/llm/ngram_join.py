"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles; two link when the Jaccard similarity
of their sets is at least 0.8. In a fixed order of all shingles (by hash), similar sets share
at least ``l`` shingles within their first ``size - ceil(0.8 size) + l`` (the l-prefix). Longer
prefixes cost more postings but demand more matches, so ``l`` follows the estimated cost:

* Every set starts with ``l = 1 + size / 16``. Sets with too few prefix shingles that any other
  set has are out.
* Shingles of few sets make candidate pairs, which are counted per pair.
* A set whose matches are mostly shingles of many sets would make too many pairs. Its prefix is
  lengthened to the whole set, which demands 80 % of its shingles; what is left is tied
  together over common shingles without listing pairs.

Equal sets are one class from the start, and only classes go through the join. Candidate
classes are grouped into connected groups, each class's set is sent once to its group, and
there an inverted index verifies every pair exactly; groups beyond ``BLOCK`` shingles are dealt
into blocks, and every two blocks meet in a task of their own, which holds no more than these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, materialize, ship
from .graph import components
from .wordhash import mix, shingle_set, word_hashes

WIDTH = 5
#: Similarity threshold in per cent.
PERCENT = 80
#: l of the first round is 1 + size // STEP.
STEP = 16
#: A shingle of more sets than this makes no candidate pairs in the first round.
COMMON = 24
#: Shingles of one inverted index, and of the sets of another block that are held against it.
BLOCK = 4_000_000
_ROWS = 200_000


def _sets(texts: list) -> Iterator[np.ndarray]:
    for t in texts:
        yield shingle_set(word_hashes((t or "").encode("utf-8", "surrogatepass")), WIDTH)


def _class(s: np.ndarray) -> int:
    """64-bit identity of a set."""
    if not len(s):
        return 0
    two = np.array([np.add.reduce(s), np.bitwise_xor.reduce(s)], np.uint64)
    m = mix(two + np.array([len(s), 1], np.uint64))
    return int(mix(m[:1] * np.uint64(0x9E3779B97F4A7C15) + m[1:])[0].astype(np.int64))


def _least(n):
    """Least overlap of a set of n shingles with a similar one, as ceil(0.8 n)."""
    return -(-n * PERCENT // 100)


def _matches(n):
    return 1 + n // STEP


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, n (set size), cls (0 for the empty set)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            got = [(len(s), _class(s)) for s in _sets(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.int64())],
                names=["doc_id", "n", "cls"])

    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"doc_id {kind}, n long, cls long")


def _postings(docs: DataFrame, text_col: str) -> DataFrame:
    """(token, cls, n) of the first round's prefixes; copies within a batch count once."""

    def run(batches):
        for b in batches:
            token, cls, n, seen, size = [], [], [], set(), 0
            for s in _sets(b.column(0).to_pylist()):
                c = _class(s)
                if not len(s) or c in seen:
                    continue
                seen.add(c)
                k = len(s) - _least(len(s)) + _matches(len(s))
                token.append(s[:k])
                cls.append(c)
                n.append(len(s))
                size += len(token[-1])
                if size >= _ROWS:
                    yield pack(token, cls, n)
                    token, cls, n, size = [], [], [], 0
            if token:
                yield pack(token, cls, n)

    def pack(token, cls, n):
        lens = [len(t) for t in token]
        return pa.RecordBatch.from_arrays(
            [_signed(np.concatenate(token)), pa.array(np.repeat(np.array(cls, np.int64), lens)),
             pa.array(np.repeat(np.array(n, np.int32), lens))], names=["token", "cls", "n"])

    return docs.selectExpr(f"`{text_col}` AS text").mapInArrow(run, "token long, cls long, n int")


def _shared(rows: DataFrame, least) -> DataFrame:
    """Rows (token, cls, n, ...) whose token is in several classes, of classes with at least
    ``least`` such rows, with ``df``: the classes of the token that are left (at least 2)."""
    by_token, by_cls = Window.partitionBy("token"), Window.partitionBy("cls")
    several = (rows.withColumn("lo", F.min("cls").over(by_token)).withColumn("hi", F.max("cls").over(by_token))
               .where("lo < hi").drop("lo", "hi").dropDuplicates(["token", "cls"]))
    enough = several.withColumn("hits", F.count(F.lit(1)).over(by_cls)).where(F.col("hits") >= least).drop("hits")
    return enough.withColumn("df", F.count(F.lit(1)).over(by_token)).where("df > 1")


def _ceil80(n):
    return F.floor((F.col(n) * PERCENT + 99) / 100).cast("long")


def _fetch(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``wanted`` (doc_id, cls) -> (cls, n, tokens) with the sorted set as packed 64-bit values.
    Rows of the same id with another text are passed over."""

    def run(batches):
        for b in batches:
            cls, sets, seen = [], [], set()
            for want, s in zip(b.column(1).to_pylist(), _sets(b.column(0).to_pylist())):
                if want not in seen and _class(s) == want:
                    seen.add(want)
                    cls.append(want)
                    sets.append(s)
            if cls:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "n", "tokens"])

    texts = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return (texts.join(wanted, F.col("id").eqNullSafe(F.col("doc_id"))).select("text", "cls")
            .mapInArrow(run, "cls long, n long, tokens binary"))


def _explode(sets: DataFrame) -> DataFrame:
    """(cls, n, tokens) -> (token, cls, n, base); base marks the 1-prefix."""

    def run(batches):
        for b in batches:
            for cls, n, data in zip(*(c.to_pylist() for c in b.columns)):
                s = np.frombuffer(data, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [_signed(s), pa.array(np.full(n, cls, np.int64)), pa.array(np.full(n, n, np.int64)),
                     pa.array(np.arange(n) <= n - _least(n))], names=["token", "cls", "n", "base"])

    return sets.select("cls", "n", "tokens").mapInArrow(run, "token long, cls long, n long, base boolean")


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def link_sets(cls: list[int], sets: list[np.ndarray], indexed: list[bool]) -> list[tuple[int, int]]:
    """Links that connect the same classes as all links between a set and an indexed set.

    Shingles of one set are dropped. Sets are held against the index from the most connected
    on; a set that is connected to every indexed one already is passed over, as its remaining
    links change nothing. Links between two sets that are not indexed are found elsewhere."""
    order = np.argsort(np.array(cls, np.int64), kind="stable")
    cls, sets, indexed = [cls[i] for i in order], [sets[i] for i in order], [indexed[i] for i in order]
    keep = [i for i in range(len(cls)) if i == 0 or cls[i] != cls[i - 1]]
    cls, sets, indexed = [cls[i] for i in keep], [sets[i] for i in keep], [indexed[i] for i in keep]
    inside = np.flatnonzero(indexed)
    if not len(inside) or len(cls) < 2:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate([sets[i] for i in inside])
    owner = np.repeat(inside, sizes[inside])
    by = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[by], owner[by]
    firsts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    unique, ends = tokens[firsts], np.append(firsts[1:], len(tokens))

    def places(s):
        at = np.searchsorted(unique, s)
        at[at == len(unique)] = 0
        return at[unique[at] == s]

    found = [places(s) for s in sets]
    weight = [int((ends[p] - firsts[p]).sum()) / max(1, len(s)) for p, s in zip(found, sets)]
    union = _Union(len(cls))
    for x in sorted(range(len(cls)), key=lambda i: (-weight[i], cls[i])):
        mine = union.root(x)
        if all(union.root(int(i)) == mine for i in inside):
            continue
        p = found[x]
        lens = ends[p] - firsts[p]
        if not lens.sum():
            continue
        at = np.repeat(firsts[p] - np.append(0, np.cumsum(lens)[:-1]), lens) + np.arange(lens.sum())
        both = np.bincount(owner[at], minlength=len(cls))
        near = np.flatnonzero(100 * both >= PERCENT * (sizes + sizes[x] - both))
        for y in near:
            if y != x and both[y]:
                union.join(x, int(y))
    return [(cls[x], cls[r]) for x in range(len(cls)) if (r := union.root(x)) != x]


def dealt(placed: DataFrame) -> DataFrame:
    """(part, cls, n, tokens) -> (part, low, high, cls, n, tokens, indexed).

    The sets of a part are dealt into blocks of about ``BLOCK`` shingles. Every pair of blocks
    is one key, whose lower block is indexed and whose higher one is held against it (a block is
    also paired with itself), so any two sets of a part meet and no key holds more than two."""
    size = placed.groupBy(F.col("part").alias("p")).agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    # few parts have several blocks: as many as the corpus has blocks at most
    rows = (placed.join(F.broadcast(size.where("blocks > 1")), F.col("part") == F.col("p"), "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("own", F.pmod(F.hash("cls"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return rows.select("part", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                       "cls", "n", "tokens", (F.col("own") <= F.col("other")).alias("indexed"))


def _verify(rows: DataFrame) -> DataFrame:
    """Rows of ``dealt`` sorted by (part, low, high) in each partition -> links."""

    def run(batches):
        key, cls, sets, flag = None, [], [], []
        for b in batches:
            for p, k, h, c, t, i in zip(*(c.to_pylist() for c in b.columns)):
                if (p, k, h) != key:
                    if len(cls) > 1:
                        yield from pack(link_sets(cls, sets, flag))
                    key, cls, sets, flag = (p, k, h), [], [], []
                cls.append(c)
                sets.append(np.frombuffer(t, np.uint64))
                flag.append(i)
        if len(cls) > 1:
            yield from pack(link_sets(cls, sets, flag))
        key, cls, sets, flag = None, [], [], []
        give_back()

    def pack(links):
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()),
                                              pa.array([x[1] for x in links], pa.int64())], names=["u", "v"])

    return rows.select("part", "low", "high", "cls", "tokens", "indexed").mapInArrow(run, "u long, v long")


def candidate_links(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(links, sets): candidate links between classes, and the sets of the classes in them."""
    rows = _shared(_postings(docs, text_col), 1 + F.floor(_ceil80("n") / STEP))
    common = F.col("df") > COMMON
    rows = materialize(rows.withColumn("commons", F.sum(common.cast("int")).over(Window.partitionBy("cls"))))
    need = 1 + F.floor(F.col("n") / STEP)
    a = rows.where(~common).select("token", F.col("cls").alias("u"), F.col("n").alias("un"), F.col("commons").alias("uc"))
    b = rows.where(~common).select("token", F.col("cls").alias("v"), F.col("n").alias("vn"), F.col("commons").alias("vc"))
    near = (F.col("u") < F.col("v")) & (F.col("un") * 100 >= F.col("vn") * PERCENT) & (F.col("vn") * 100 >= F.col("un") * PERCENT)
    pairs = (a.join(b, "token").where(near).groupBy("u", "v", "un", "vn", "uc", "vc")
             .agg(F.count(F.lit(1)).alias("hits"))
             .withColumn("n", F.least("un", "vn"))
             .where(F.col("hits") + F.least("uc", "vc") >= need).select("u", "v"))
    pairs = materialize(pairs)
    # sets whose matches can all be common shingles: the whole set becomes the prefix
    heavy = (rows.where(F.col("commons") >= 1 + F.floor(_ceil80("n") / STEP)).select("cls").distinct()
             .withColumn("heavy", F.lit(True)))
    wanted = (pairs.select(F.col("u").alias("cls")).union(pairs.select("v")).distinct()
              .join(heavy, "cls", "full_outer"))
    wanted = wanted.join(reps, "cls").select("doc_id", "cls", F.coalesce("heavy", F.lit(False)).alias("heavy"))
    sets = materialize(_fetch(docs, wanted.select("doc_id", "cls"), id_col, text_col))
    whole = _shared(_explode(sets.join(heavy.select("cls"), "cls", "left_semi")), _ceil80("n"))
    hub = F.min("cls").over(Window.partitionBy("token"))
    stars = whole.where("base").select(F.col("cls").alias("u"), hub.alias("v")).where("u <> v").distinct()
    return pairs.unionByName(stars), sets


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, cls, root (one class of the component), component
    (its smallest id, null where it has none; null for empty sets)."""
    ship(docs.sparkSession)
    known = materialize(classes(docs, id_col, text_col))
    reps = known.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    links, sets = candidate_links(docs, reps, id_col, text_col)
    parts = components(links)
    member = parts.unionByName(parts.select(F.col("root").alias("node"), "root")).distinct()
    placed = sets.join(member, F.col("cls") == F.col("node")).select(F.col("root").alias("part"), "cls", "n", "tokens")
    ready = dealt(placed).repartition("part", "low", "high").sortWithinPartitions("part", "low", "high")
    linked = components(_verify(ready))
    group = (linked.join(reps, F.col("node") == F.col("cls")).select("root", "doc_id")
             .groupBy("root").agg(F.min("doc_id").alias("low")))
    top = group.join(reps.select(F.col("cls").alias("root"), F.col("doc_id").alias("own")), "root")
    top = top.select("root", F.least("low", "own").alias("low"))
    moved = (linked.join(top, "root").select("node", "low", "root")
             .unionByName(top.select("root", F.col("root").alias("node"), "low").select("node", "low", "root")))
    final = (reps.join(moved, F.col("cls") == F.col("node"), "left")
             .select(F.col("cls").alias("c"), F.coalesce("root", "cls").alias("root"),
                     F.coalesce("low", "doc_id").alias("component")))
    return known.join(final, F.col("cls") == F.col("c"), "left").drop("c")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable).

    Null texts and texts without a word have the empty set and are linked with nothing, not
    even with each other: their component is their own id. Equal sets always link. Repeated
    rows share a component; null ids count only where a component has no other id. An empty
    table gives no rows."""
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return _grouped(docs, id_col, text_col).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one of smallest id (null last), then of
    smallest text hash. Every row with an empty set stays. The columns stay the same."""
    cols = docs.columns
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    doc, text = f"c{cols.index(id_col)}", f"c{cols.index(text_col)}"
    rows = rows.withColumn("h1", F.xxhash64(doc, text)).withColumn("h2", F.hash(text, doc))
    # the key travels as the id, so that a row's group is found again whatever its id
    key = F.struct(F.col(doc).isNull().alias("none"), F.col(doc).alias("id"), "h1", "h2")
    grouped = materialize(_grouped(rows.select(key.alias("key"), F.col(text).alias("text")), "key", "text"))
    first = grouped.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("key"), F.lit(False).alias("empty"))
    empty = grouped.where("n = 0").select(F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("key"),
                                          F.lit(True).alias("empty")).distinct()
    stays = first.unionByName(empty).select(F.col("key.h1").alias("k1"), F.col("key.h2").alias("k2"), "empty")
    copy = F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.lit(1)))
    return (rows.join(stays, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
            .withColumn("copy", copy).where("empty OR copy = 1")
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)]))
