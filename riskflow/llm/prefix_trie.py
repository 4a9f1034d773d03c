"""Prefix trie of conversations by fixed-length block hashing.

A node of depth d is a distinct sequence of d first turns. Every turn has a digest of its role
and text; the digest of a sequence is the exclusive or of its turns' digests, each hashed with its
position (two 64-bit hashes), so prefixes are running values and no conversation has to be
read as a whole.

Conversations are first grouped by the digests of successive blocks of ``BLOCK`` turns: all that
agree up to a block's start are one group. Where all of a group's conversations hold the same
block, its turns are nodes with the group's counts, read off one conversation. Only in blocks
where siblings diverge are the turns of all conversations grouped, turn by turn.

Sums over subtrees follow chains: a node carries the smallest conversation through it, and the
nodes of one conversation form a vertical chain. Chains are summed into their ancestors by pointer
doubling (about log2 of the number of chains on a path), then each chain is summed from its end
up. Running values are taken in two steps, within cells of ``CELL`` positions and over cells, so a
conversation that holds a third of all turns is spread over tasks.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, n_words, salted_join, ship

#: Turns of a block; positions of a cell; ids of one stretch of a node's list of ends.
BLOCK, CELL, STRETCH = 4, 4096, 1 << 16
#: Tasks that the rows of one parent, group or chain are dealt over.
SALTS = 8


def _zero() -> Column:
    return F.lit(0).cast("long")


class Trie(NamedTuple):
    """``nodes``: node1, node2 (digest), depth, conv_id (smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens. ``ends``: conv, node1, node2, depth of every conversation's last node."""
    nodes: DataFrame
    ends: DataFrame


def _floor_div(c: str, by: int) -> Column:
    return F.floor(F.col(c) / F.lit(by)).cast("long")


def _running(df: DataFrame, key: str, cell: str, order: list, values: dict, also: DataFrame | None = None) -> DataFrame:
    """``df`` with running values along ``order`` within ``key``: name -> (aggregate, column).
    ``cell`` is a non-null column that does not fall along the order. ``also`` holds more columns
    by ``key``."""
    inside = Window.partitionBy(key, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("k").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    cells = df.groupBy(F.col(key).alias("k"), F.col(cell).alias("c")).agg(*[f(v).alias(n) for n, (f, v) in values.items()])
    offsets = cells.select("k", "c", *[F.coalesce(f(n).over(before), _zero()).alias(f"{n}_0") for n, (f, _) in values.items()])
    if also is not None:
        offsets = offsets.join(also, F.col("k") == F.col(key)).drop(key)
    rows = df.select("*", *[f(v).over(inside).alias(n) for n, (f, v) in values.items()])
    return rows.join(offsets, (F.col(key) == F.col("k")) & (F.col(cell) == F.col("c"))).drop("k", "c")


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv, pos, digest, words, n) of the turns of (conv_id, turn, role, text): ``pos`` from 1 by
    turn (null first), equal turns by digest; ``n`` is not known yet. Null role or text is empty;
    rows without conv_id belong to no conversation and are left out."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        F.concat(F.md5(role), F.md5(text)).alias("digest"), n_words(text).alias("words"))
    rows = rows.withColumn("cell", F.coalesce(_floor_div("turn", CELL), F.lit(-(1 << 62))))
    out = _running(rows, "conv", "cell", [F.col("turn").asc_nulls_first(), F.col("digest")], {"at": (F.sum, F.lit(1))})
    return out.select("conv", (F.col("at") + F.col("at_0")).cast("long").alias("pos"), "digest", "words")


def borrow_heads(turns: DataFrame, convs: DataFrame, group: int, most: int) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation ``c - c % group``
    (all it has, if fewer; none if it is absent); h is crc32(c as text) modulo ``most``."""
    head = F.crc32(F.col("conv").cast("string")) % most
    counts = convs.withColumn("base", F.col("conv") - F.col("conv") % group).withColumn("h", head)
    bases = convs.where(F.col("conv") % group == 0).select(F.col("conv").alias("b"), F.col("n").alias("bn"))
    plan = counts.join(bases, F.col("base") == F.col("b"), "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("bn", _zero())).alias("m"))
    first = turns.where((F.col("conv") % group == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "b")
    taken = (plan.where("m > 0").join(first, F.col("base") == F.col("b")).where("pos <= m")
             .select("conv", "pos", "digest", "words"))
    # own turns meet the shift of their conversation cell by cell
    cells = turns.withColumn("cell", _floor_div("pos", CELL))
    shift = plan.select("conv", "h", (F.col("m") - F.col("h")).alias("shift"))
    spread = cells.groupBy("conv", "cell").agg(F.count(F.lit(1)).alias("rows")).join(shift, "conv").drop("rows")
    own = cells.join(spread, ["conv", "cell"]).where("pos > h").select("conv", (F.col("pos") + F.col("shift")).alias("pos"), "digest", "words")
    return taken.unionByName(own)


def _totals(chains: DataFrame) -> DataFrame:
    """(conv, up, leaves, saved) of chains -> (conv, leaves, saved) summed with all chains below."""
    totals = materialize(chains.select("conv", "leaves", "saved"))
    up = materialize(chains.where("up IS NOT NULL").select("conv", "up"))
    while not up.isEmpty():
        below = (totals.join(up, "conv").groupBy(F.col("up").alias("conv"))
                 .agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")))
        totals = materialize(totals.join(below, "conv", "left").select(
            "conv", (F.col("leaves") + F.coalesce("l", _zero())).alias("leaves"), (F.col("saved") + F.coalesce("s", _zero())).alias("saved")))
        higher = up.select(F.col("conv").alias("up"), F.col("up").alias("top"))
        up = materialize(salted_join(up, higher, ["up"], F.xxhash64("conv"), SALTS).select("conv", F.col("top").alias("up")))
    return totals


def build(turns: DataFrame, convs: DataFrame) -> Trie:
    """The trie of (conv, pos, digest, words) with ``pos`` from 1 without gaps; ``convs`` holds every
    conversation's ``conv`` once, those without a turn included (they end at the root)."""
    turns = turns.withColumn("block", F.floor((F.col("pos") - 1) / F.lit(BLOCK)).cast("long"))
    turns = materialize(turns.select("conv", "pos", "block", "words", F.xxhash64("pos", "digest").alias("x1"),
                                     F.xxhash64("digest", F.lit(BLOCK), "pos").alias("x2")))
    blocks = turns.groupBy("conv", "block").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"),
                                                F.max("pos").alias("end"))
    blocks = blocks.withColumn("cell", _floor_div("block", CELL))
    blocks = _running(blocks, "conv", "cell", [F.col("block")], {"r1": (F.bit_xor, F.col("b1")), "r2": (F.bit_xor, F.col("b2"))})
    for i in "12":
        blocks = blocks.withColumn(f"e{i}", F.col(f"r{i}").bitwiseXOR(F.col(f"r{i}_0"))).withColumn(f"s{i}", F.col(f"e{i}").bitwiseXOR(F.col(f"b{i}")))
    blocks = materialize(blocks.select("conv", "block", "end", "s1", "s2", "e1", "e2"))

    # groups that agree up to a block's start; their blocks are all the same, or siblings diverge
    stop = F.struct("e1", "e2")
    groups = materialize(blocks.groupBy("block", "s1", "s2").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), (F.min(stop) == F.max(stop)).alias("same")))
    single = groups.where("same").select("conv", "block", "s1", "s2", "n")
    split = groups.where("NOT same").select("block", "s1", "s2")
    members = (salted_join(blocks.select("conv", "block", "s1", "s2"), split, ["block", "s1", "s2"], F.xxhash64("conv"), SALTS)
               .withColumn("n", F.lit(None).cast("long")))
    inside = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = turns.select("*", F.bit_xor("x1").over(inside).alias("r1"), F.bit_xor("x2").over(inside).alias("r2"))
    rows = rows.join(single.unionByName(members), ["conv", "block"])
    at = {f"node{i}": F.col(f"s{i}").bitwiseXOR(F.col(f"r{i}")) for i in "12"}
    rows = rows.select("conv", "n", "words", F.col("pos").alias("depth"), *[v.alias(k) for k, v in at.items()],
                       *[v.bitwiseXOR(F.col(f"x{i}")).alias(f"up{i}") for i, v in zip("12", at.values())])
    refined = (rows.where("n IS NULL").groupBy("depth", "node1", "node2")
               .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.min("words").alias("words"),
                    F.min("up1").alias("up1"), F.min("up2").alias("up2")))
    zero = [_zero().alias(c) for c in ("depth", "node1", "node2", "words")]
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).where("n > 0").select(
        "conv", "n", *zero, *[F.lit(None).cast("long").alias(c) for c in ("up1", "up2")])
    nodes = materialize(rows.where("n IS NOT NULL").unionByName(refined).unionByName(root))

    # children and the parent's smallest conversation
    kids = nodes.where("depth > 0").groupBy(F.col("up1").alias("node1"), F.col("up2").alias("node2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(kids, ["node1", "node2"], "left").withColumn("n_children", F.coalesce("n_children", _zero())))
    parents = nodes.where("n_children > 0").select(F.col("node1").alias("up1"), F.col("node2").alias("up2"), F.col("conv").alias("up"))
    below = salted_join(nodes.where("depth > 0"), parents, ["up1", "up2"], F.xxhash64("node1"), SALTS)
    nodes = below.unionByName(nodes.where("depth = 0").withColumn("up", F.lit(None).cast("long")))
    nodes = materialize(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
                        .withColumn("saved", (F.col("n") - 1) * F.col("words")).drop("up1", "up2", "words"))

    # every chain's top hangs below a node of another chain
    top = F.min(F.struct("depth", "up"))
    chains = nodes.groupBy("conv").agg(top.alias("top"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    chains = materialize(chains.select("conv", F.col("top.up").alias("up"), F.col("top.depth").alias("depth"), "leaves", "saved"))
    hung = (chains.where("up IS NOT NULL").select("conv", "up", "depth").join(_totals(chains), "conv")
            .groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth"))
            .agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")))
    nodes = nodes.join(hung, ["conv", "depth"], "left").withColumn("cell", -_floor_div("depth", CELL))
    both = {"n_leaves": (F.sum, F.col("leaves") + F.coalesce("l", _zero())), "saved_tokens": (F.sum, F.col("saved") + F.coalesce("s", _zero()))}
    nodes = _running(nodes, "conv", "cell", [F.col("depth").desc()], both)
    nodes = nodes.select("node1", "node2", "depth", F.col("conv").alias("conv_id"), F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                         "n_children", *[(F.col(c) + F.col(f"{c}_0")).alias(c) for c in both])
    last = blocks.groupBy("conv").agg(F.max(F.struct("block", "end", "e1", "e2")).alias("z"))
    ends = convs.select("conv").join(last, "conv", "left").select(
        "conv", *[F.coalesce(f"z.{a}", _zero()).alias(b) for a, b in (("e1", "node1"), ("e2", "node2"), ("end", "depth"))])
    return Trie(nodes, ends)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node1, node2, depth, ends_sha256): SHA-256 of the ids that end at a node, ascending, as
    decimals joined by commas. Stretches of ids are joined first; a node's stretches then pass
    through one running hash in order, never held together."""
    ship(ends.sparkSession)
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    parts = (ends.withColumn("stretch", _floor_div("conv", STRETCH)).groupBy("node1", "node2", "depth", "stretch")
             .agg(F.array_join(ids, ",").alias("ids")))
    keys = ["node1", "node2", "depth"]

    def run(batches):
        key, state = None, None
        for b in batches:
            done = []
            for n1, n2, d, ids in zip(*(c.to_pylist() for c in b.columns)):
                if key != (n1, n2, d):
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (n1, n2, d), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pack(done)
        if key:
            yield pack([(*key, state.hexdigest())])

    def pack(rows):
        n1, n2, d, sha = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(n1, pa.int64()), pa.array(n2, pa.int64()), pa.array(d, pa.int64()), pa.array(sha)],
                                          names=[*keys, "ends_sha256"])

    return (parts.repartition(*keys).sortWithinPartitions(*keys, "stretch").select(*keys, "ids")
            .mapInArrow(run, "node1 long, node2 long, depth long, ends_sha256 string"))


def shared_prefixes(conversations: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """One row per node of the trie of the conversations as rebuilt by ``borrow_heads``.

    Turns are ordered by turn number (null first), equal ones by digest of role and text. Null role
    or text is empty, rows without conv_id are left out; further columns are ignored. Repeated
    rows are turns of their own. Texts of any length count by their digest. A conversation that
    loses all its turns ends at the root. An empty table gives no rows."""
    turns = materialize(turns_of(conversations))
    convs = materialize(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")))
    trie = build(borrow_heads(turns, convs, group, most), convs)
    none = hashlib.sha256(b"").hexdigest()
    return (trie.nodes.join(ends_digest(trie.ends), ["node1", "node2", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
