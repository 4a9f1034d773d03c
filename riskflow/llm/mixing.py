"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source has the same expected number of copies (target words over the
source's words). Expected copies are prefix-summed over the documents of a source, one random
offset per source is added, and a document is emitted once per integer boundary its interval
crosses. Documents stand in order of size class, so the words taken stay within a few
documents' size of the target.

The prefix sums need no window over a whole source: documents are counted per (source, size
class, salt) cell, the classes of a source and the salts of a class (``SALTS`` at most) are
prefix-summed, and documents are ranked inside their cell only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, n_words

#: Weights of the sources in code-point order, repeating; null stands last.
WEIGHTS = (1, 2, 3)
#: A target is at most so many times its source's words.
MAX_COPIES = 3
SALTS = 256
SEED = "mix-1"
_UNIT = 16 ** 5


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, size) rows -> one row per source: source, source_size, target.

    Sources share the sum of all sizes by weight. A target stops at ``MAX_COPIES`` times the
    source's size; the excess is reshared by weight until no target is above. The sources that
    end up capped are those with the smallest size over weight, so running sums in that order
    find the common level. The windows run over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]),
                          ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("w", weight.cast("long")).withColumn("cap", F.col("source_size") * MAX_COPIES)
    every = Window.partitionBy()
    before = (Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    per = (per.withColumn("words", F.sum("source_size").over(every)
                          - F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("weights", F.sum("w").over(every)
                       - F.coalesce(F.sum("w").over(before), F.lit(0)))
           .withColumn("capped", F.col("cap") * F.col("weights") <= F.col("w") * F.col("words")))
    # the first source that is not capped sets the level of all that are not
    level = F.max(F.when(~F.col("capped"), F.struct("weights", "words"))).over(every)
    per = per.withColumn("level", level)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("w") * F.col("level.words")).cast("double") / F.col("level.weights"))
    return per.select("source", "source_size", target.alias("target"))


def plan(docs: DataFrame, size: Column, id_col: str = "doc_id",
         source_col: str = "source", text_col: str | None = None) -> DataFrame:
    """Every column of ``docs`` plus ``size``, ``source_size``, ``target`` and ``copies``.

    Null sources form one source that stands last. Null and repeated ids are separate rows,
    each with its own copies. Rows of equal size and id stand in order of a digest of their
    text if ``text_col`` is given; otherwise (and if the text is the same, too) they are
    interchangeable, so their order does not matter. Size 0 gives target 0 and no copies. An empty table gives no rows.
    Columns of ``docs`` with one of the new names are not allowed (rename them first).
    ``docs`` is read twice: once for the counts, once for the ranks."""
    src = F.col(source_col)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    if text_col:  # also deals the rows of a repeated id over the salts
        key = F.concat(key, F.lit("\x00"), F.coalesce(F.col(text_col), F.lit("")))
    bits = F.greatest(F.length(F.bin("size")) - 7, F.lit(0))
    rows = (docs.withColumn("size", size.cast("long"))
            .withColumn("_cls", (bits * 64 + F.floor(F.col("size") / F.pow(F.lit(2.0), bits))).cast("long"))
            .withColumn("_digest", F.md5(key))
            .withColumn("_salt", F.substring("_digest", 1, 2)))
    cells = rows.groupBy(src.alias("_src"), F.col("_cls").alias("_c"), F.col("_salt").alias("_s"))
    # read three times below; without this the words would be counted as often
    cells = materialize(cells.agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_words")))
    targets = source_targets(cells.select(F.col("_src").alias("source"), F.col("_words").alias("size")))
    # two steps, so that no window holds more than a source's classes or a class's salts
    classes = cells.groupBy(F.col("_src").alias("_k"), F.col("_c").alias("_kc")).agg(F.sum("_n").alias("_all"))
    ahead = Window.partitionBy("_k").orderBy("_kc").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("_start", F.coalesce(F.sum("_all").over(ahead), F.lit(0))).drop("_all")
    before = (Window.partitionBy("_src", "_c").orderBy("_s")
              .rowsBetween(Window.unboundedPreceding, -1))
    seed = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("_src"), F.lit("\x00")))
    offset = F.conv(F.substring(F.md5(seed), 1, 5), 16, 10).cast("double") / _UNIT
    cells = (cells.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .join(classes, F.col("_src").eqNullSafe(F.col("_k")) & (F.col("_c") == F.col("_kc")))
             .withColumn("_ahead", F.col("_ahead") + F.col("_start"))
             .join(targets.withColumnRenamed("source", "_t"), F.col("_src").eqNullSafe(F.col("_t")))
             .select("_src", "_c", "_s", "_ahead", offset.alias("_offset"), "source_size", "target"))
    rank = F.row_number().over(Window.partitionBy(src, "_cls", "_salt").orderBy("size", "_digest"))
    joined = (rows.withColumn("_rank", rank)
              .join(cells, src.eqNullSafe(F.col("_src")) & (F.col("_cls") == F.col("_c"))
                    & (F.col("_salt") == F.col("_s"))))
    place = F.col("_ahead") + F.col("_rank")
    each = F.try_divide("target", "source_size")
    crossed = (F.floor(place * each + F.col("_offset"))
               - F.floor((place - 1) * each + F.col("_offset")))
    return (joined.withColumn("copies", F.when(F.col("size") > 0, F.least(crossed, F.lit(MAX_COPIES)))
                              .otherwise(0).cast("long"))
            .drop("_cls", "_digest", "_salt", "_rank", *[c for c in cells.columns if c[0] == "_"]))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> DataFrame:
    """``docs`` with every row repeated by its copies (0 to 3); the columns stay the same.

    Repeated rows keep their own copies; rows without a word are never taken. Rows that share
    id and size are told apart by their texts, so reruns agree however rows are dealt."""
    inner = docs.select([F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    name = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    planned = plan(inner, n_words(F.col(name[text_col])), name[id_col], name[source_col],
                   name[text_col])
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return (planned.where("copies > 0").withColumn("_copy", copies)
            .select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]))
