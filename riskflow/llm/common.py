"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word: a run of characters outside space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder of ``spark.checkpoint.dir``: the rows survive lost
    executors, and Spark removes the files once the frame is no longer referenced."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def rematerialize(df: DataFrame) -> DataFrame:
    """``materialize`` for the rounds of a loop, without Spark's estimate of the rows' size.

    A checkpointed frame keeps the estimate of the plan it came from, and a join's estimate is the
    product of its sides'. Where each round joins the one before with itself, the number's digits
    multiply with every round, until the driver's memory is full of them."""
    done, session = materialize(df)._jdf, df.sparkSession
    rows = done.queryExecution().analyzed().rdd()
    return DataFrame(session._jsparkSession.internalCreateDataFrame(rows, done.schema(), False), session)


def n_words(text) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def learnable(doc_id) -> Column:
    """Rows that models may learn from: crc32 of the id as text, modulo 5, is not 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 != 0, F.lit(False))


def held_out(doc_id) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that do not occur in ``df`` (case ignored), one for each stem."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def salted_join(rows: DataFrame, keyed: DataFrame, keys: list[str], salt: Column, salts: int) -> DataFrame:
    """Inner join of ``rows`` with ``keyed`` (one row per key) on ``keys``, where the rows of
    one key are dealt over ``salts`` tasks by the integer column ``salt`` of ``rows``. ``keyed``
    is repeated once per salt, so it should be the far smaller side."""
    r, k = fresh(rows.join(keyed.limit(0), keys), "salt", "salt_of_key")
    dealt = rows.withColumn(r, F.pmod(salt, F.lit(salts)).cast("int")).alias("dealt")
    every = keyed.withColumn(k, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).alias("every")
    cond = F.col(f"dealt.{r}") == F.col(f"every.{k}")
    for key in keys:
        cond = cond & (F.col(f"dealt.{key}") == F.col(f"every.{key}"))
    rest = [F.col(f"every.{c}") for c in keyed.columns if c not in keys]
    return dealt.join(every, cond).select(*[F.col(f"dealt.{c}") for c in rows.columns], *rest)


def give_back() -> None:
    """Return a Python worker's freed memory to the system: workers live on after their task, and what
    their allocator keeps would count against the executor in every later stage."""
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to do
        pass


_SHIPPED: set[str] = set()


def ship(spark) -> None:
    """Give the package to the Python workers of the session's executors, once per application,
    so that tasks can import it whatever the executors' search path is."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
