"""Session helpers: a tuned local session for tests and benches, table loading, the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 50_000  # rows of a few numbers each, some 2 MB


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A UTC session on one machine; on a cluster the submitted configuration is used instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skyloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; Catalyst prunes its columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in spark.checkpoint.dir; only where it is unset, and on one machine, make one of our own."""
    if spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir() is not None:
        return
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skyloom-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame to the reliable checkpoint folder and go on from there, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def maybe_broadcast(few: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A frame that is expected to be short, written and counted; broadcast if it is no longer than ``rows``, else a plain side of a join."""
    kept = cut_lineage(few)
    return F.broadcast(kept) if kept.count() <= rows else kept


def data_dir(default: str = "/root/testdata/sf0.001") -> str:
    return os.environ.get("SKYLOOM_DATA", default)
