"""Bronze -> silver -> gold as Structured Streaming queries chained through folders.

All three are stateless appends (no exchange, no state store): they scale with source
partitions and files. Each query has its own checkpoint folder, which must be on shared
storage on a cluster.

Silver hands over committed batches only: once both outputs of a batch are committed, one row
(query_id, batch_id) is added to ``<silver>_commits``. Gold follows that table, not silver's
files, and files its output under silver's ids. So a silver batch that was written but not
committed and is replayed reaches gold once, and so does one whose row was announced twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.features import gold_features
from ..operators import silver
from ..schemas import BRONZE, TRANSACTION
from .sinks import apply_trigger, batch_folder, query_id, write_batch

COMMITS = "query_id string, batch_id bigint"


def commits_path(valid_path: str) -> str:
    return f"{valid_path.rstrip('/')}_commits"


def bronze_query(raw: DataFrame, bronze_path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Raw text, verbatim, appended as JSON lines ``{"json_str": ...}``."""
    w = (raw.select("json_str").writeStream.format("json").outputMode("append")
         .option("path", bronze_path).option("checkpointLocation", checkpoint))
    return apply_trigger(w, trigger).start()


def silver_writer(valid_path: str, quarantine_path: str, fmt: str = "parquet"):
    """foreachBatch function: parse the batch once, write valid rows and quarantined rows
    (text + reasons), then announce the batch. Both outputs come from one persisted parse."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark)
        parsed = silver.parse_raw(batch).persist()
        try:
            write_batch(silver.flatten_valid(parsed), valid_path, batch_id, fmt, query=query)
            write_batch(silver.quarantine(parsed), quarantine_path, batch_id, fmt,
                        rebalance=True, query=query)
        finally:
            parsed.unpersist()
        done = spark.createDataFrame([(query, batch_id)], COMMITS).coalesce(1)
        write_batch(done, commits_path(valid_path), batch_id, "json", query=query)
    return write


def silver_query(spark: SparkSession, bronze_path: str, valid_path: str, quarantine_path: str,
                 checkpoint: str, trigger: dict | None = None,
                 max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> StreamingQuery:
    """A micro-batch is bounded by files, or by bytes when they vary in size."""
    reader = _bounded(spark.readStream.schema(BRONZE), max_files_per_trigger, max_bytes_per_trigger)
    w = (reader.json(bronze_path).writeStream
         .foreachBatch(silver_writer(valid_path, quarantine_path))
         .option("checkpointLocation", checkpoint))
    return apply_trigger(w, trigger).start()


def _bounded(reader, files: int | None, size: int | None):
    if files:
        return reader.option("maxFilesPerTrigger", files)
    return reader.option("maxBytesPerTrigger", size) if size else reader


def gold_writer(silver_path: str, gold_path: str, fmt: str = "parquet",
                partition_by_date: bool = False):
    """foreachBatch function over announced silver batches: their rows -> gold features, filed
    under the silver batch's own ids by one write job, whatever their number. It replaces just
    the folders of these batches (dynamic partition overwrite), so a replay leaves each row once.
    The announcements of a micro-batch (a row per silver batch, bounded by the trigger's file
    limit) are listed on the driver; data rows are not."""
    ids = [StructField("query_id", StringType()), StructField("batch_id", LongType())]

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        folders = [batch_folder(silver_path, r["query_id"], r["batch_id"]) for r in batch.distinct().collect()]
        if not folders:
            return
        src = spark.read.schema(StructType(TRANSACTION.fields + ids)).option("basePath", silver_path).parquet(*folders)
        gold = gold_features(src)
        by = ["query_id", "batch_id"]
        if partition_by_date:
            gold = gold.withColumn("event_date", F.to_date("timestamp"))
            by.append("event_date")
        (gold.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).format(fmt).save(gold_path))
    return write


def gold_query(spark: SparkSession, silver_path: str, gold_path: str, checkpoint: str,
               trigger: dict | None = None, max_batches_per_trigger: int = 16,
               fmt: str = "parquet", partition_by_date: bool = False) -> StreamingQuery:
    """Committed silver batches -> gold features, optionally partitioned by ``event_date`` for
    readers that filter by date. Parquet by default: JSON would cut timestamps to milliseconds
    and drop NULL fields."""
    announced = (spark.readStream.schema(COMMITS).option("recursiveFileLookup", "true")
                 .option("maxFilesPerTrigger", max_batches_per_trigger)
                 .json(_made(spark, commits_path(silver_path))))
    w = (announced.writeStream
         .foreachBatch(gold_writer(silver_path, gold_path, fmt, partition_by_date))
         .option("checkpointLocation", checkpoint))
    return apply_trigger(w, trigger).start()


def _made(spark: SparkSession, path: str) -> str:
    """``path``, created if silver has not announced anything yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path
