"""URL filters by hashed host-suffix and path-prefix expressions.

Every URL expands into (host suffix, path prefix) expressions, whose short hash prefixes are
equi-joined with those of the rules; a hit is confirmed by the full digest, and the longest
rule wins. Rules may be any number of rows: Spark broadcasts them only while they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verdict of a URL that no rule fits.
DEFAULT = "allow"
#: Hex digits of the short hash that the join uses.
SHORT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the registered query as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.translate(path, "/", ""))


def _digest(host: Column, stem: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), stem), 256)


def _stem(path: Column) -> Column:
    """A path up to and including its last slash (empty without one)."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 1)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """(host, path, verdict) -> rules with their digest and depth. A rule's path is hashed up
    to its last slash; what follows is compared when a hit is confirmed. A rule given twice
    with both verdicts blocks. Rules without host or path are left out."""
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    one = (rules.where("host IS NOT NULL AND path IS NOT NULL")
           .groupBy(host.alias("r_host"), F.col("path").alias("r_path"))
           .agg(F.max("verdict").alias("r_verdict")))
    full = _digest(F.col("r_host"), _stem(F.col("r_path")))
    return (one.withColumn("r_digest", full).withColumn("r_short", F.substring(full, 1, SHORT))
            .withColumn("labels", F.size(F.split("r_host", r"\.")))
            .withColumn("slashes", _slashes(F.col("r_path"))))


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` with string columns ``host`` and ``path`` -> distinct (host, path) with
    ``rule`` (host and path of the longest fitting rule, else null) and ``verdict``.

    Only depths (labels of the host, slashes of the path) that occur among the rules are
    expanded, so a URL with thousands of slashes makes no more expressions than the rules have
    depths; that list holds one row per depth, not per rule."""
    ruled = prepare_rules(rules)
    depths = sorted(tuple(r) for r in ruled.select("labels", "slashes").distinct().collect())
    pairs = urls.select("host", "path").distinct()
    parts = F.split(F.col("host"), r"\.")

    def expression(labels: int, slashes: int) -> Column:
        suffix = F.substring_index(F.col("host"), ".", -labels)
        stem = (F.concat(F.substring_index(F.col("path"), "/", slashes), F.lit("/"))
                if slashes else F.lit(""))
        fits = (F.size(parts) >= labels) & (_slashes(F.col("path")) >= slashes)
        return F.when(fits, _digest(suffix, stem))

    if not depths:
        return pairs.select("host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit(DEFAULT).alias("verdict"))
    found = F.array_compact(F.array(*[expression(*d) for d in depths]))
    hits = (pairs.withColumn("digest", F.explode_outer(found))
            .join(ruled, F.substring("digest", 1, SHORT) == F.col("r_short"), "left"))
    confirmed = (F.col("digest") == F.col("r_digest")) & F.startswith(F.col("path"), F.col("r_path"))
    best = F.max(F.when(confirmed, F.struct(
        (F.length("r_host") + F.length("r_path")).alias("long"), F.length("r_host").alias("host_long"),
        F.col("r_verdict").alias("verdict"), F.concat("r_host", "r_path").alias("rule"))))
    return (hits.groupBy("host", "path").agg(best.alias("best"))
            .select("host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict")))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    Null urls and urls without ``://`` have empty host and path, which no rule fits. Repeated
    rows and null ids are kept. Each distinct (id, host, path) is judged once, in the
    partition where its copies were counted."""
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    verdicts = judge(rows, rules).select(F.col("host").alias("h"), F.col("path").alias("p"), "rule", "verdict")
    return (rows.join(verdicts, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
            .select(id_col, "host", "path", "rule", "verdict"))


def default_rules(spark) -> DataFrame:
    """``RULES`` as an inline table, whose exact size Spark knows when it picks the join."""
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)")
