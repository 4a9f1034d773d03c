"""Session helpers: one place that knows the settings riskflow relies on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"
_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Universal", "Zulu"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "riskflow") -> SparkSession:
    """Session for tests, benches and scripts. On a cluster, pass master=None and let
    spark-submit decide; the settings below are the ones the library depends on."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", UTC)
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Gold features take the hour in the session time zone; riskflow pins it to UTC so that
    results do not depend on the machine the driver runs on."""
    if spark.conf.get("spark.sql.session.timeZone") not in _UTC_NAMES:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; call ensure_checkpoint_dir() "
                           "in tests or configure a shared folder on the cluster")
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set one only where it is unset (tests)."""
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if default is None and not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver "
                               f"and all executors of {master} share")
        d = default or os.path.join(os.environ.get("TMPDIR", "/tmp"), "riskflow-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller made (scratch of a finished step)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint root, for stream sinks and lineage cuts."""
    return "/".join([checkpoint_root(spark), "riskflow", *parts, uuid.uuid4().hex])
