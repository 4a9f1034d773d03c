"""The 70/30 cut of the prediction log in order of arrival, found from a manifest.

Records arrive in batches; within a batch, stored rows have a fixed place: the number of their
file and their index in it. For every committed batch the scoring stream adds to
``<log>_manifest`` the number of rows of each of its files. The file and row index of row k then
follow from sums over the manifest (cells of batches, then batches, then files), without ranking
or reading a row of the log. The report takes all other batches' sums from the stored summary, and
reads only the batch that holds the cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..streaming.sinks import batch_folder

MANIFEST = "file string, rows bigint, query_id string, batch_id bigint"
#: Batches summed up together; a cell or a batch's files are looked through on one row each.
CELL = 1024


def manifest_path(predictions_path: str) -> str:
    return f"{predictions_path.rstrip('/')}_manifest"


def _file_number(name):
    return F.regexp_extract(name, r"part-(\d+)", 1).cast("bigint")


def manifest_of(stored: DataFrame) -> DataFrame:
    """(file, rows) of a committed batch as read back; only the files' row counts are read."""
    return stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


@dataclass
class ArrivalCut:
    """Row ``row`` (from 0) of ``file`` in the batch is the first that is not among the first k."""
    query_id: str
    batch_id: int
    file: str
    row: int
    batch_rows: int


def _holding(df: DataFrame, order: list, k: int):
    """(row whose rows hold row k, rows before it): ``df`` has one line per stretch of rows."""
    before = F.coalesce(F.sum("rows").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    r = df.withColumn("before", before).where((F.col("before") < k) & (F.col("before") + F.col("rows") >= k)).first()
    return r, r["before"]


def arrival_cut(manifest: DataFrame, k: int) -> ArrivalCut:
    """Where the first ``k`` rows end (1 <= k <= rows) in order of (query, batch, file, row)."""
    cell = F.floor(F.col("batch_id") / CELL).alias("cell")
    cells = manifest.groupBy("query_id", cell).agg(F.sum("rows").alias("rows"))
    c, before = _holding(cells, ["query_id", "cell"], k)
    k -= before
    inside = manifest.where((F.col("query_id") == c["query_id"]) & F.col("batch_id").between(c["cell"] * CELL, c["cell"] * CELL + CELL - 1))
    b, before = _holding(inside.groupBy("batch_id").agg(F.sum("rows").alias("rows")), ["batch_id"], k)
    k -= before
    files = inside.where(F.col("batch_id") == b["batch_id"]).select("file", "rows")
    f, before = _holding(files, [_file_number("file"), "file"], k)
    return ArrivalCut(c["query_id"], b["batch_id"], f["file"], k - before, b["rows"])


def read_manifest(spark: SparkSession, predictions_path: str) -> DataFrame:
    """The manifest table; empty where nothing was committed yet."""
    from ..sources.tables import _exists
    path = manifest_path(predictions_path)
    if not _exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path).dropDuplicates(["query_id", "batch_id", "file"])


def cut_batch(spark: SparkSession, predictions_path: str, schema, cut: ArrivalCut) -> DataFrame:
    """The rows of the batch that holds the cut, with ``is_baseline``."""
    folder = batch_folder(predictions_path, cut.query_id, cut.batch_id)
    rows = spark.read.schema(schema).parquet(folder).select("*", F.col("_metadata.file_name").alias("_file"),
                                                            F.col("_metadata.row_index").alias("_row"))
    found = rows.count()
    if found != cut.batch_rows:
        raise RuntimeError(f"batch {cut.query_id}/{cut.batch_id} holds {found} rows, its manifest says {cut.batch_rows}")
    at, mine = F.struct(F.lit(cut.file)), _file_number(F.col("_file"))
    number = _file_number(F.lit(cut.file))
    before = (mine < number) | ((mine == number) & (F.struct("_file") < at)) | ((F.col("_file") == cut.file) & (F.col("_row") < cut.row))
    return rows.withColumn("is_baseline", before).drop("_file", "_row")
