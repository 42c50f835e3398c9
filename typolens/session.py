"""Session helpers: shared checkpoint folder and table access."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) a local folder is made.
    """
    named = spark.sparkContext.getConf().get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "typolens-checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage (a reliable checkpoint)."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """``df`` with a task for each core if its input has fewer splits than that (then it is small), else as it is.

    For maps that compute much per row. The rows stay the same; only where they run changes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
