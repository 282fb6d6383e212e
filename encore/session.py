"""Session helpers.

Library functions never create or configure a session: the caller's session
(and its cluster settings) is used as-is. ``local_session`` exists for tests,
the benchmark and the tools; ``shared_dir`` makes folders under the one that the
cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "encore") -> SparkSession:
    """A local session with the settings the metric plans are tuned for."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ENCORE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``, which is only read. Where it is
    unset (tests, local runs) the folder lies under the session's own warehouse
    location, which the executors share by Spark's contract; never a temporary folder
    of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    return base.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the session's shared folder."""
    name = "-".join(parts) if parts else "work"
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` written as Parquet to a fresh shared folder and read from there."""
    folder = shared_dir(df.sparkSession, *parts)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_dir``, by the session's own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
