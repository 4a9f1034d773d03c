"""Removal of boilerplate lines by their spread over sites (DataFrame functions only).

Occurrences of a line are merged by aggregation into one HyperLogLog sketch of the sites it
occurs on, per line hash. Lines whose estimate is clearly below the threshold stay; for lines
near it the distinct sites are counted exactly; lines on at least ``MIN_SITES`` sites are
boilerplate. Its first occurrence in the corpus stays and every other one is removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, salted_join

#: A line on so many distinct sites is boilerplate.
MIN_SITES = 5
#: Lines are judged from so many characters on (without outer blanks).
MIN_CHARS = 10
#: log2 of the sketch's registers. Below 3/4 of 2^(LG_K - 3) sites the sketch is a plain list.
LG_K = 9
#: Estimates within this share of the threshold are counted exactly (several times the sketch's
#: standard error of 1.04 / sqrt(2^LG_K), under 5 %).
BAND = 0.5
#: Tasks that the occurrences of one line are dealt over where they meet the line's verdict.
SALTS = 16
_BLANK = " \t\r\x0b\x0c"


def is_judged(line: Column) -> Column:
    """Whether a line is long enough to be judged (compared without outer blanks)."""
    return F.length(F.btrim(line, F.lit(_BLANK))) >= MIN_CHARS


def _lines(docs: DataFrame) -> DataFrame:
    """One row per judged line of a document: key of the row, site, line number, line hash."""
    parts = F.posexplode(F.split(F.col("text"), "\n", -1)).alias("pos", "line")
    line = F.btrim(F.col("line"), F.lit(_BLANK))
    return (docs.select("doc", "body", "site", parts)
            .withColumn("line", line).where(F.length("line") >= MIN_CHARS)
            .select("doc", "body", "site", "pos", F.xxhash64("line").alias("h1"),
                    F.hash("line").alias("h2")))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Rows of ``_lines`` -> every occurrence (doc, body, h1, h2, pos) of a boilerplate line
    with ``first``, true for the first occurrence of the line in the corpus."""
    site = F.coalesce(F.concat(F.lit("s"), F.col("site")), F.lit(""))
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg(site, F.lit(LG_K)).alias("sketch"))
    suspects = (spread.withColumn("sites", F.hll_sketch_estimate("sketch"))
                .where(F.col("sites") >= min_sites * (1 - BAND)).select("h1", "h2", "sites"))
    deal = F.xxhash64("doc", "pos")
    seen = materialize(salted_join(lines, suspects, ["h1", "h2"], deal, SALTS))
    near = F.col("sites") <= min_sites * (1 + BAND)
    exact = (seen.where(near).select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites"))
             .where(F.col("sites") >= min_sites).select("h1", "h2"))
    sure = seen.where(~near).select("h1", "h2").distinct()
    place = F.struct("doc", "body", "pos")
    first = seen.groupBy("h1", "h2").agg(F.min(place).alias("at"))
    found = exact.unionByName(sure).join(first, ["h1", "h2"])
    return (salted_join(seen, found, ["h1", "h2"], deal, SALTS)
            .select("doc", "body", "pos", place.eqNullSafe(F.col("at")).alias("first")))


def remove_spread_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines cut out of the text, plus ``lines`` (lines of the text)
    and ``lines_removed``. Columns of ``docs`` with these two names are replaced.

    A line is compared without outer blanks; lines under ``MIN_CHARS`` characters always stay.
    Null sites count as one site. Null text has no lines and stays null. Identical rows are
    treated alike: all hold the line's first occurrence or none does. Order of occurrences is
    by id (null first), then by a hash of site and text, then by line."""
    cols = docs.columns
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    name = {c: f"c{i}" for i, c in enumerate(cols)}
    text = F.col(name[text_col])
    rows = (rows.withColumn("doc", F.col(name[id_col]))
            .withColumn("body", F.xxhash64(F.col(name[site_col]), text))
            .withColumn("site", F.col(name[site_col])).withColumn("text", text))
    cut = (boilerplate(_lines(rows), min_sites).where(~F.col("first"))
           .groupBy(F.col("doc").alias("d"), F.col("body").alias("b"))
           .agg(F.collect_set("pos").alias("gone")))
    parts = F.split(F.col("text"), "\n", -1)
    left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    out = (rows.join(cut, F.col("doc").eqNullSafe(F.col("d")) & (F.col("body") == F.col("b")), "left")
           .withColumn("cleaned", F.when(F.col("gone").isNull(), F.col("text")).otherwise(left))
           .withColumn("lines", F.coalesce(F.size(parts), F.lit(0)).cast("long"))
           .withColumn("lines", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(F.col("lines")))
           .withColumn("lines_removed", F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")))
    keep = [F.col("cleaned").alias(c) if c == text_col else F.col(f"c{i}").alias(c)
            for i, c in enumerate(cols) if c.lower() not in ("lines", "lines_removed")]
    return out.select(*keep, "lines", "lines_removed")
