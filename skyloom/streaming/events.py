"""Event streams: running counts without late repeats, windows over event time, latest state per key by micro-batch upsert."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators.upsert import last_per_key
from skyloom.session import ensure_checkpoint_dir


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """New files of a folder, or of a single file's folder, as a stream of events with a UTC event time."""
    folder, name = os.path.split(path.rstrip("/"))
    single = not os.path.isdir(path) if path.startswith("/") else False
    reader = spark.readStream.schema(schema)
    stream = reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    return f"{base}/stream-{uuid.uuid4().hex}"


def without_repeats(stream: DataFrame, key: str, delay: str = "1 hour") -> DataFrame:
    """Each key's first event; repeats within the delay are dropped with bounded state."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, width: str, delay: str = "1 day") -> DataFrame:
    """Events and their summed values per type and window of event time."""
    return stream.withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))


def completed(stream: DataFrame, key: str, n: int) -> DataFrame:
    """Keys with at least n events, and how many."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("n_events")).filter(F.col("n_events") >= n)


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the micro-batches that were written whole to a folder; a handful of names, read on the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath() for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return sorted(int(p.getName().split("=", 1)[1]) for p in done)


def run_to_table(stream: DataFrame, mode: str, folder: str | None = None) -> DataFrame:
    """Run a stream over all that is there now into a table in the shared folder and read that.

    Every micro-batch has a folder of its own under its number, so a batch that is tried again takes its own place. In
    complete mode the last batch is the table. A stream started again in the same folder goes on where it stopped.
    """
    spark, folder = stream.sparkSession, folder or _folder(stream.sparkSession)
    schema = stream.schema

    def sink(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={n}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
    numbers = _batches(spark, f"{folder}/rows")
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{folder}/rows/batch={n}" for n in (numbers if mode == "append" else numbers[-1:])))


def upsert_stream(stream: DataFrame, keys: list[str], order: list[str], folder: str | None = None, merge_every: int = 16) -> DataFrame:
    """The latest row per key of a stream.

    Every micro-batch is reduced to a row per key and written under its number; after every ``merge_every`` batches
    those written since are merged with the table so far into a new one. So a batch costs what it holds, a batch that
    is tried again takes its own place, and a stream started again in the same folder goes on with its table.
    """
    spark, folder = stream.sparkSession, folder or _folder(stream.sparkSession)
    schema = stream.schema

    def table(before: int) -> DataFrame:
        bases = [n for n in _batches(spark, f"{folder}/merged") if n < before]
        base = bases[-1] if bases else -1
        paths = [f"{folder}/rows/batch={n}" for n in _batches(spark, f"{folder}/rows") if base < n < before] + ([f"{folder}/merged/batch={base}"] if bases else [])
        rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        return last_per_key(rows, keys, order)

    def sink(batch: DataFrame, n: int) -> None:
        last_per_key(batch, keys, order).write.mode("overwrite").parquet(f"{folder}/rows/batch={n}")
        if (n + 1) % merge_every == 0:
            table(n + 1).write.mode("overwrite").parquet(f"{folder}/merged/batch={n}")

    stream.writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
    return table(2**62)
