"""Batch table readers. Explicit schemas everywhere: no inference scan, no surprise types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schemas


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def read_json_lines(spark: SparkSession, path: str, schema: StructType,
                    fail_fast: bool = True) -> DataFrame:
    """JSON-lines table with a fixed schema. Blank lines are skipped by the reader; a malformed
    line fails the job (FAILFAST) as the reference's loader does; a missing path is an empty
    table rather than an error."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    mode = "FAILFAST" if fail_fast else "PERMISSIVE"
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The prediction log (rich records). Missing path -> empty log."""
    if fmt == "json":
        return read_json_lines(spark, path, schemas.PREDICTION)
    if not _exists(spark, path):
        return spark.createDataFrame([], schemas.PREDICTION)
    return spark.read.schema(schemas.PREDICTION).parquet(path)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The feature store with its contract schema (training input)."""
    if fmt == "json":
        return read_json_lines(spark, path, schemas.FEATURES)
    if not _exists(spark, path):
        return spark.createDataFrame([], schemas.FEATURES)
    return spark.read.schema(schemas.FEATURES).parquet(path)
