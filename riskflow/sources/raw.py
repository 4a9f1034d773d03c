"""Raw event sources: Kafka topic or a directory of JSON lines, as batch or stream.

Only the source is chosen by name; everything downstream sees one column ``json_str``.
The Kafka connector jar must be on the classpath for ``fmt="kafka"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def bronze_projection(df: DataFrame) -> DataFrame:
    """Kafka ``value`` bytes -> ``json_str`` text, verbatim (bronze)."""
    return df.select(F.col("value").cast("string").alias("json_str"))


KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13"


def _kafka_reader(reader, servers: str, topic: str, starting_offsets: str, options: dict):
    if not servers or not topic:
        raise ValueError("the kafka source needs servers and topic")
    r = (reader.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        r = r.option(k, v)
    try:
        return r.load()
    except Exception as e:  # connector missing: say what to add instead of a class lookup error
        if "kafka" in str(e).lower() and ("find data source" in str(e).lower()
                                          or "data_source_not_found" in str(e).lower()):
            raise RuntimeError(f"Kafka connector not on the classpath: add {KAFKA_PACKAGE} "
                               "(spark.jars.packages) matching the Spark version") from e
        raise


def read_raw_stream(spark: SparkSession, fmt: str = "json", path: str | None = None, *,
                    servers: str | None = None, topic: str | None = None,
                    starting_offsets: str = "latest", max_files_per_trigger: int | None = None,
                    **options) -> DataFrame:
    """Streaming raw source.

    * ``fmt="kafka"``: ``value`` cast to text. ``starting_offsets`` "latest" (bronze, scorer) or
      "earliest" (feature consumer). Offsets live in the query checkpoint, so a restart resumes
      rather than replays.
    * ``fmt="json"``: a bronze directory of ``{"json_str": ...}`` lines (the bronze sink's own
      format), read with the fixed one-column schema.
    * ``fmt="text"``: a directory of raw JSON objects, one per line.
    """
    if fmt == "kafka":
        return bronze_projection(_kafka_reader(spark.readStream, servers, topic,
                                               starting_offsets, options))
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    if fmt == "json":
        return reader.schema(schemas.BRONZE).json(path)
    if fmt == "text":
        return reader.text(path).select(F.col("value").alias("json_str"))
    raise ValueError(f"unknown raw source format {fmt!r}")


def read_raw(spark: SparkSession, fmt: str = "json", path: str | None = None, *,
             servers: str | None = None, topic: str | None = None,
             starting_offsets: str = "earliest", **options) -> DataFrame:
    """Batch twin of :func:`read_raw_stream` (replays, backfills, tests)."""
    if fmt == "kafka":
        return bronze_projection(_kafka_reader(spark.read, servers, topic,
                                               starting_offsets, options))
    if fmt == "json":
        return spark.read.schema(schemas.BRONZE).json(path)
    if fmt == "text":
        return spark.read.text(path).select(F.col("value").alias("json_str"))
    raise ValueError(f"unknown raw source format {fmt!r}")
