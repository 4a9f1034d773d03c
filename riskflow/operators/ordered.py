"""Exact order-dependent operators without a global sort or a single-partition window.

``positional_cut`` answers "which rows are the first k in (time, id) order" — the drift
report's 70/30 split of the prediction log. It is a distributed selection: each pass is a
filtered, map-side-combined count by range bucket (the driver only sees at most ``fanout``
bucket counts), narrowing to the bucket holding the k-th row until at most ``exact_limit``
rows remain, which are then ranked exactly. Rows never move across the network, a hot
timestamp (one micro-batch holding a third of the log) is split by the id, then by a row hash.

``running_sum`` gives exclusive prefix sums over a table with a unique order key (e.g. the
distinct scores of an ROC curve) using quantile buckets: bucket totals (at most
``num_buckets`` rows, a proven bound) are prefixed and broadcast, then each bucket is prefixed
in its own window partition. Balanced by construction, so no task holds the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

DEFAULT_FANOUT = 8192
DEFAULT_EXACT_LIMIT = 20_000


def order_number(df: DataFrame, col: str) -> Column:
    """Monotone BIGINT image of an order column (timestamps in microseconds)."""
    t = df.schema[col].dataType
    c = F.col(col)
    if isinstance(t, TimestampType):
        return F.unix_micros(c)
    if isinstance(t, TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(t, DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(t, IntegralType):
        return c.cast("bigint")
    raise TypeError(f"order column {col} must be a timestamp, date or integer, not {t}")


def raw_range(df: DataFrame, col: str, lo: int, hi: int, date_col: str | None = None) -> Column:
    """``lo <= order_number(col) <= hi`` written on the raw column with literal bounds, so the
    scan can push it down (parquet row-group min/max skipping on a time-clustered log). With
    ``date_col`` (a date partition column equal to ``to_date(col)``) the same range also
    prunes partition folders."""
    t = df.schema[col].dataType
    c = F.col(col)
    if isinstance(t, TimestampType):
        rng = c.between(F.timestamp_micros(F.lit(lo)), F.timestamp_micros(F.lit(hi)))
        if date_col:
            rng = rng & F.col(date_col).between(F.to_date(F.timestamp_micros(F.lit(lo))),
                                                F.to_date(F.timestamp_micros(F.lit(hi))))
        return rng
    if isinstance(t, TimestampNTZType):
        return c.between(F.timestamp_micros(F.lit(lo)).cast("timestamp_ntz"),
                         F.timestamp_micros(F.lit(hi)).cast("timestamp_ntz"))
    if isinstance(t, DateType):
        return c.between(F.date_from_unix_date(F.lit(lo)), F.date_from_unix_date(F.lit(hi)))
    return c.between(F.lit(lo), F.lit(hi))


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


@dataclass
class Cut:
    """The first ``k`` rows = rows ``before`` the final range, plus the first ``r`` of the
    ``count`` rows ``inside`` it (ranked by ``inside_order``). ``identical`` marks a final
    range whose rows cannot be told apart by any key (exact duplicates)."""
    k: int
    before: Column
    inside: Column
    r: int
    count: int
    inside_order: list
    identical: bool = False


def _quotient(offset: Column, width: int) -> Column:
    """offset div width in integers (a double quotient is inexact beyond 2^53)."""
    return ((offset - F.pmod(offset, F.lit(width).cast("bigint"))).cast("decimal(20,0)")
            / F.lit(width).cast("decimal(20,0)")).cast("bigint")


def _refine_numeric(df, key: Column, scope: Column, lo: int, hi: int, r: int, cnt: int,
                    fanout: int, exact_limit: int, wide: bool, pushable=None):
    """Narrow [lo, hi] of ``key`` (within ``scope``) to the bucket holding rank r.
    ``pushable(lo, hi)`` gives the same range as a predicate the scan can push down."""
    before = F.lit(False)
    while cnt > exact_limit and lo < hi:
        width = -(-(hi - lo + 1) // fanout)
        if wide:   # 64-bit hash values: subtract in decimal to avoid overflow
            off = key.cast("decimal(21,0)") - F.lit(lo).cast("decimal(21,0)")
            bucket = F.floor(off / F.lit(width).cast("decimal(21,0)")).cast("bigint")
        else:
            bucket = _quotient(key - F.lit(lo), width)
        rng = key.between(lo, hi)
        if pushable is not None:
            rng = pushable(lo, hi) & rng
        rows = df.filter(scope & rng).groupBy(bucket.alias("b")).count().collect()
        acc = 0
        for row in sorted(rows, key=lambda x: x["b"]):
            if acc + row["count"] >= r:
                b_lo = lo + row["b"] * width
                before = before | (scope & (key < F.lit(b_lo)))
                r -= acc
                cnt = row["count"]
                lo, hi = b_lo, min(hi, b_lo + width - 1)
                break
            acc += row["count"]
        else:  # pragma: no cover - counts changed under us (input mutated between passes)
            raise RuntimeError("input changed while locating the cut")
    return before, lo, hi, r, cnt


def positional_cut(df: DataFrame, k: int, time_col: str, id_col: str | None = None,
                   n: int | None = None, bounds: tuple | None = None,
                   fanout: int = DEFAULT_FANOUT,
                   exact_limit: int = DEFAULT_EXACT_LIMIT, date_col: str | None = None) -> Cut:
    """Locate the first ``k`` rows of ``df`` in (time_col, id_col) order (1 <= k <= n).
    ``date_col``: a partition column holding ``to_date(time_col)``, used for pruning."""
    t = order_number(df, time_col)
    if n is None or bounds is None:
        st = df.agg(F.count(F.lit(1)).alias("n"), F.count(t).alias("nn"),
                    F.min(t).alias("lo"), F.max(t).alias("hi")).first()
        if st["nn"] != st["n"]:
            raise ValueError(f"{st['n'] - st['nn']} rows have a NULL {time_col}; the order "
                             "must be total")
        n, bounds = st["n"], (st["lo"], st["hi"])
    if not 1 <= k <= n:
        raise ValueError(f"k={k} outside 1..{n}")
    lo, hi = bounds
    scope = t.isNotNull()
    pushable = lambda a, b: raw_range(df, time_col, a, b, date_col)
    before, lo, hi, r, cnt = _refine_numeric(df, t, scope, lo, hi, k, n, fanout,
                                             exact_limit, wide=False, pushable=pushable)
    inside = scope & pushable(lo, hi) & t.between(lo, hi)
    order = [t] + ([F.col(id_col)] if id_col else [])
    if cnt <= exact_limit:
        return Cut(k, before, inside, r, cnt, order + [row_hash(df)])

    # Every remaining row has the same time: refine by id prefix, one character per pass
    scope = pushable(lo, lo) & (t == F.lit(lo))
    if id_col:
        s = F.col(id_col)
        plen = 0
        while cnt > exact_limit:
            plen += 1
            p = F.substring(s, 1, plen)
            rows = df.filter(scope).groupBy(p.alias("p")).count().collect()
            # ascending, NULL first, strings by code point (= Spark's UTF-8 byte order)
            rows.sort(key=lambda x: (x["p"] is not None, x["p"] or ""))
            acc = 0
            for row in rows:
                if acc + row["count"] >= r:
                    chosen = row
                    break
                acc += row["count"]
            cp = chosen["p"]
            lt = F.lit(False) if cp is None else (p.isNull() | (p < F.lit(cp)))
            before = before | (scope & lt)
            r -= acc
            cnt = chosen["count"]
            scope = scope & (p.isNull() if cp is None else p == F.lit(cp))
            if cp is None or len(cp) < plen:
                break    # all ids left are NULL or one and the same string
        if cnt <= exact_limit:
            return Cut(k, before, scope, r, cnt, order + [row_hash(df)])

    # Same time and same id: refine by a hash of the whole row
    h = row_hash(df)
    st = df.filter(scope).agg(F.min(h).alias("lo"), F.max(h).alias("hi")).first()
    before2, hlo, hhi, r, cnt = _refine_numeric(df, h, scope, st["lo"], st["hi"], r, cnt,
                                                fanout, exact_limit, wide=True)
    before = before | before2
    inside = scope & h.between(hlo, hhi)
    return Cut(k, before, inside, r, cnt, order + [h], identical=cnt > exact_limit)


def label_first_k(df: DataFrame, cut: Cut, flag_col: str = "in_first_k",
                  weight_col: str = "_w") -> DataFrame:
    """``df`` with ``flag_col`` (row is among the first k) and ``weight_col`` (row multiplicity,
    1 except for a collapsed group of exact duplicates). Aggregate with weights."""
    inside = F.coalesce(cut.inside, F.lit(False))
    before = F.coalesce(cut.before, F.lit(False))
    outside = df.filter(~inside).select(
        "*", before.alias(flag_col), F.lit(1).cast("bigint").alias(weight_col))
    if not cut.identical:
        # at most exact_limit rows: one bounded window task ranks them exactly
        w = Window.orderBy(*cut.inside_order)
        ranked = df.filter(inside).withColumn("_rn", F.row_number().over(w))
        inner = ranked.select(*[F.col(c) for c in df.columns],
                              (F.col("_rn") <= F.lit(cut.r)).alias(flag_col),
                              F.lit(1).cast("bigint").alias(weight_col))
    else:
        # indistinguishable rows: one representative carries both multiplicities
        rep = df.filter(inside).limit(1)
        inner = rep.select("*", F.lit(True).alias(flag_col),
                           F.lit(cut.r).cast("bigint").alias(weight_col)) \
            .unionByName(rep.select("*", F.lit(False).alias(flag_col),
                                    F.lit(cut.count - cut.r).cast("bigint").alias(weight_col))) \
            .filter(F.col(weight_col) > 0)
    return outside.unionByName(inner)


def running_sum(df: DataFrame, order_col: str, value_cols: list,
                num_buckets: int = 1024, rel_err: float | None = None, by: tuple = ()) -> DataFrame:
    """``df`` plus ``<v>_before`` = sum of ``v`` over rows of the same ``by`` columns with a smaller
    ``order_col`` (numeric, and unique within ``by``). NaN sorts last, as in Spark. Buckets are
    quantiles over all rows, so a ``by`` value that holds most rows is split over them too."""
    probs = [i / num_buckets for i in range(1, num_buckets)]
    err = rel_err if rel_err is not None else 1.0 / (4 * num_buckets)
    qs = df.approxQuantile(order_col, probs, err) if num_buckets > 1 else []
    splits = [float("-inf")] + sorted({q for q in qs if q == q and abs(q) != float("inf")}) \
        + [float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=order_col, outputCol="_bucket",
                          handleInvalid="keep").transform(df)
    totals = bucketed.groupBy(*by, "_bucket").agg(*[F.sum(v).alias(f"_bt_{v}") for v in value_cols])
    # at most num_buckets + 1 rows of totals per value of by
    prior = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_bucket", *[F.coalesce(F.sum(f"_bt_{v}").over(prior), F.lit(0))
                                              .alias(f"_off_{v}") for v in value_cols])
    within = Window.partitionBy(*by, "_bucket").orderBy(order_col) \
        .rowsBetween(Window.unboundedPreceding, -1)
    if by:
        keys = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*by, "_bucket")]
        cond = keys[0]
        for k in keys[1:]:
            cond = cond & k
        joined = bucketed.alias("l").join(offsets.alias("r"), cond).select(
            "l.*", *[F.col(f"r._off_{v}") for v in value_cols])
    else:
        # offsets has at most num_buckets rows (+1 for NaN): broadcast is bounded by a parameter
        joined = bucketed.join(F.broadcast(offsets), "_bucket")
    return joined.select(*[F.col(c) for c in df.columns],
                         *[(F.col(f"_off_{v}") + F.coalesce(F.sum(v).over(within), F.lit(0)))
                           .alias(f"{v}_before") for v in value_cols])
