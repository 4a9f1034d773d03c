"""Per-micro-batch writers used inside ``foreachBatch``.

Each batch is written to ``<path>/query_id=<q>/batch_id=<n>``, where q is the streaming query's
own id (kept in its checkpoint). A batch replayed after a failure (``foreachBatch`` is
at-least-once) carries the same input, since the offset log fixes it, so: a folder whose write
committed (``_SUCCESS`` present) is left alone, and one that did not commit is overwritten.
Another query, or the same one on a new checkpoint, has another id and so other folders:
nothing it writes is taken for a replay. Readers see one table with two partition columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The local property under which Spark keeps the id of the query that runs a micro-batch.
QUERY_ID = "sql.streaming.queryId"


def query_id(spark: SparkSession) -> str:
    """Id of the streaming query whose micro-batch is being written; "batch" outside of one."""
    return spark.sparkContext.getLocalProperty(QUERY_ID) or "batch"


def batch_folder(path: str, query: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/query_id={query}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                compression: str | None = None, partition_by: list | None = None,
                rebalance: bool = False, query: str | None = None) -> None:
    """``compression`` e.g. "uncompressed" (the reference's parquet setting); default is the
    session's codec. ``partition_by`` adds folders below the batch (e.g. a date), which
    readers use for partition pruning. ``rebalance`` lets adaptive execution size the output
    partitions (one shuffle of this output): for small side outputs such as quarantine and
    rejects, which would otherwise leave one tiny file per task. ``query``: the id to file the
    batch under (default: the running query's)."""
    target = batch_folder(path, query or query_id(df.sparkSession), batch_id)
    if committed(df.sparkSession, target):
        return
    if rebalance:
        df = df.hint("rebalance")
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    w.save(target)


def committed(spark, folder: str) -> bool:
    from ..sources.tables import _exists
    return _exists(spark, f"{folder}/_SUCCESS")


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """``value`` column to a topic (needs the Kafka connector on the classpath)."""
    (df.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def apply_trigger(writer, trigger: dict | None):
    """``trigger`` as keyword arguments of ``DataStreamWriter.trigger``, e.g.
    ``{"availableNow": True}`` or ``{"processingTime": "30 seconds"}``."""
    return writer.trigger(**trigger) if trigger else writer
