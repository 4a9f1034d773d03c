"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Unit vectors are rotated by a random orthogonal matrix, so that any leading dimensions are a
fair sample of a distance, and put into the list of their nearest centroid. A query scans the
lists nearest to it in blocks of columns: after each block a hypothesis test on the partial
distance drops candidates that are unlikely to beat the current neighbours. Survivors are
scored by the cosine of the original vectors in double precision.

Centroids are fitted on a bounded sample; every row is indexed. The number of lists scanned is
the least that reaches ``TARGET`` of the true neighbours of a bounded sample of queries, found
by holding those against all rows; a query whose lists hold too few other ids scans further ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship

#: Rows and numbers that centroids are fitted on at most.
SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 4_000_000
MAX_LISTS = 1024
#: Queries that the number of scanned lists is measured on, and the share to reach.
PROBE_SAMPLE, TARGET = 128, 0.985
#: Rows and queries of one task's scan.
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 20_000
#: Columns between two tests, and the tests' confidence factor.
COLUMNS, EPSILON = 16, 2.1
SEED = 7


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of every row of x with q, each row by the same arithmetic."""
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to smaller ids."""
    if len(score) > 4 * k:
        bound = np.partition(score, -k)[-k]
        near = np.flatnonzero(score >= bound)
        return near[np.lexsort((ids[near], -score[near]))][:k]
    return np.lexsort((ids, -score))[:k]


def fit(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of unit vectors by Lloyd's iterations."""
    rng = np.random.default_rng(SEED)
    centers = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(10):
        near = np.argmax(sample @ centers.T - 0.5 * (centers * centers).sum(axis=1), axis=1)
        count = np.bincount(near, minlength=lists)
        total = np.zeros_like(centers)
        np.add.at(total, near, sample)
        centers = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centers)
    return centers


def rotation(width: int) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng(SEED + 1).standard_normal((width, width)))
    return q


def scan_list(ids: np.ndarray, x: np.ndarray, unit: np.ndarray, query_id: int, q: np.ndarray,
              unit_q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Adaptive scan of one block: (ids, scores) of the query's k best rows found.

    ``unit`` and ``unit_q`` are rotated unit vectors. The first rows set the bound; then
    candidates go when their partial distance, scaled to all columns, exceeds the bound by more
    than the test allows. Rows as far as the bound stay, so ties are decided by exact scores."""
    others = alive = np.flatnonzero(ids != query_id)
    if not len(alive):
        return ids[:0], np.empty(0)
    width = unit.shape[1]
    first = alive[:max(32, 4 * k)]
    apart = ((unit[first] - unit_q) ** 2).sum(axis=1)
    bound = np.partition(apart, min(k, len(apart)) - 1)[min(k, len(apart)) - 1] if len(apart) >= k else np.inf
    part = np.zeros(len(alive))
    for at in range(0, width, COLUMNS):
        step = unit[alive, at:at + COLUMNS] - unit_q[at:at + COLUMNS]
        part = part + np.einsum("ij,ij->i", step, step)
        seen = min(at + COLUMNS, width)
        if seen < width:
            slack = (1 + EPSILON / np.sqrt(seen)) ** 2
            ok = part * (width / seen) <= bound * slack + 1e-9
            # the nearest by what has been seen tighten the bound
            if ok.sum() > 8 * k:
                near = alive[np.argpartition(part, k)[:k]]
                bound = min(bound, ((unit[near] - unit_q) ** 2).sum(axis=1).max())
                ok = part * (width / seen) <= bound * slack + 1e-9
        else:
            ok = part <= bound * (1 + 1e-6) + 1e-9
        alive, part = alive[ok], part[ok]
    got, score = best_ids(x[alive], ids[alive], q, k)
    if len(got) < k and len(alive) < len(others):
        # the tests have dropped too many, or the bound was set by rows of one id
        got, score = best_ids(x[others], ids[others], q, k)
    return got, score


def best_ids(x: np.ndarray, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best distinct ids by cosine with q, with their scores."""
    score = cosine(x, q)
    best = top(score, ids, k)
    if len(np.unique(ids[best])) < len(best):
        order = np.lexsort((ids, -score))
        best = order[np.sort(np.unique(ids[order], return_index=True)[1])][:k]
    return ids[best], score[best]


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): rows with an id whose vector is neither null, empty nor zero and holds no
    null or non-finite component."""
    v = F.col(vec_col).cast("array<double>")
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
            .where(F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                   & F.exists("vec", lambda c: c != 0)))


def search(rows: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """Nearest neighbours of the rows whose id is divisible by ``every``, among all rows:
    query_id, rank (from 1), vec_id, score; ties go to the smaller id.

    Rows without a usable vector or id take no part. Vectors of another length than most
    (ties: the longer) take no part, as no cosine with the others exists. Rows with the
    query's id are not its neighbours; a repeated id appears once, with its best score. Fewer
    candidates than ``k`` give fewer rows; an empty table gives none."""
    spark = rows.sparkSession
    ship(spark)
    rows = usable(rows, id_col, vec_col)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    most = rows.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    if most is None:
        return empty
    width, total = most["w"], most["count"]
    rows = rows.where(F.size("vec") == width)
    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // width))
    share = min(1.0, 1.2 * wanted / total)
    drawn = (rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
             .select("vec").limit(wanted).toPandas()["vec"])
    sample = _unit(np.array(drawn.tolist(), np.float64).reshape(-1, width))
    lists = max(1, min(MAX_LISTS, round(total ** 0.5), len(sample) // 16))
    centers = fit(sample, lists) if len(sample) else np.zeros((1, width))
    half = 0.5 * (centers * centers).sum(axis=1)

    def index(batches):
        for pdf in batches:
            x = np.array(pdf["vec"].tolist(), np.float64).reshape(-1, width)
            near = np.argmax(_unit(x) @ centers.T - half, axis=1)
            yield pd.DataFrame({"list": near.astype(np.int32), "vec_id": pdf["vec_id"],
                                "vec": [r.tobytes() for r in x]})

    indexed = materialize(rows.mapInPandas(index, "list int, vec_id long, vec binary"))
    queries = indexed.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    probes = _probes(indexed, queries, centers, half, width, k)
    if not probes:
        return empty

    # ids by list, each counted in one of its lists: so many the list is sure to add
    held = np.zeros(len(centers), np.int64)
    for r in indexed.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().collect():
        held[r["list"]] = r["count"]

    def choose(batches):
        for pdf in batches:
            u = _unit(_matrix(pdf["vec"], width))
            order = np.argsort(half - u @ centers.T, axis=1, kind="stable")
            # the query's own id is no neighbour; all lists are few enough if they hold fewer than k
            covered = np.cumsum(held[order], axis=1) > k
            need = np.where(covered.any(axis=1), covered.argmax(axis=1) + 1, len(held))
            take = np.maximum(need, probes)
            yield pd.DataFrame({"list": order[np.arange(len(held)) < take[:, None]].astype(np.int32),
                                "query_id": np.repeat(pdf["vec_id"].to_numpy(), take),
                                "q": np.repeat(pdf["vec"].to_numpy(), take)})

    asked = queries.mapInPandas(choose, "list int, query_id long, q binary")
    # one row per list: how many blocks its rows and its queries are dealt into
    load = (indexed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).join(
        asked.groupBy("list").agg(F.count(F.lit(1)).alias("m")), "list"))
    load = materialize(load.select("list", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("rows"),
                                   F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("chunks")))
    one = F.sequence(F.lit(0), F.col("chunks") - 1)
    left = (indexed.join(F.broadcast(load), "list")
            .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("rows").cast("long")))
            .withColumn("chunk", F.explode(one)).select("list", "block", "chunk", "vec_id", "vec"))
    right = (asked.join(F.broadcast(load), "list")
             .withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks").cast("long")).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows").cast("long") - 1)))
             .select("list", "block", "chunk", "query_id", "q"))
    turn = rotation(width)

    def scan(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mine) and len(theirs):
            mine = mine.sort_values("vec_id", kind="stable")
            ids, x = mine["vec_id"].to_numpy(), _matrix(mine["vec"], width)
            unit, q = _unit(x) @ turn, _matrix(theirs["q"], width)
            for query, row, u in zip(theirs["query_id"], q, _unit(q) @ turn):
                got, score = scan_list(ids, x, unit, query, row, u, k)
                out.append(pd.DataFrame({"query_id": query, "vec_id": got, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    keys = ["list", "block", "chunk"]
    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
             .applyInPandas(scan, "query_id long, vec_id long, score double"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (best.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _probes(indexed: DataFrame, queries: DataFrame, centers, half, width: int, k: int) -> int:
    """Lists to scan so that ``TARGET`` of the true neighbours of sampled queries are in them."""
    few = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBE_SAMPLE).toPandas()
    if not len(few):
        return 0
    q, qid = _matrix(few["vec"], width), few["vec_id"].to_numpy()

    def nearest(batches):
        for pdf in batches:
            ids, x, where = pdf["vec_id"].to_numpy(), _matrix(pdf["vec"], width), pdf["list"].to_numpy()
            for i in range(len(q)):
                other = np.flatnonzero(ids != qid[i])
                if len(other):
                    score = cosine(x[other], q[i])
                    best = top(score, ids[other], k)
                    yield pd.DataFrame({"i": i, "list": where[other[best]], "vec_id": ids[other[best]],
                                        "score": score[best]})

    near = indexed.mapInPandas(nearest, "i int, list int, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score"), "vec_id"))
    truth = near.withColumn("r", rank).where(F.col("r") <= k).select("i", "list").toPandas()
    if not len(truth):
        return 1
    order = np.argsort(half - _unit(q) @ centers.T, axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    at = np.sort(place[truth["i"].to_numpy(), truth["list"].to_numpy()])
    return int(at[min(len(at) - 1, int(np.ceil(TARGET * len(at))) - 1)]) + 1
