"""Changes between full snapshots of a table, by gaps and islands.

Every key's rows become islands: consecutive delivered snapshots with one unchanged content. An island is a validity
interval; its start, its end and whether it touches the island before it say what changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _one_per_snapshot(df: DataFrame, key: Column, snapshot: str, state: dict[str, Column], order: Sequence[Column]) -> DataFrame:
    """The row that counts per key and snapshot. The maximum is combined before the shuffle, so a key listed again and again sends one row per map task."""
    last = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), *(c.alias(f"s_{k}") for k, c in state.items()))
    rows = df.select(key.alias("key"), F.col(snapshot).alias("snap"), last.alias("last")).filter(F.col("key").isNotNull() & F.col("snap").isNotNull())
    return rows.groupBy("key", "snap").agg(F.max("last").alias("last")).select("key", "snap", *(F.col(f"last.s_{k}").alias(f"s_{k}") for k in state))


def validity_intervals(df: DataFrame, key: Column, snapshot: str, state: dict[str, Column], order: Sequence[Column]) -> DataFrame:
    """Islands: ``key, s_<state>..., first_ord, last_ord, delivered`` (delivered: the sorted snapshot numbers).

    Ordinals count delivered snapshots from 1, so a number that was never delivered makes no gap. Rows with a null key
    or snapshot belong to no interval. Of rows of one key and snapshot the last by ``order`` counts (null orders come
    first; ties go to the larger state). An empty table has no intervals.
    """
    # one number per delivery, sent as a scalar; deliveries are periodic, so the list stays short
    delivered = df.agg(F.array_sort(F.collect_set(snapshot)).alias("numbers")).select("numbers").scalar()
    # rows carry the ordinal alone through the shuffle by key
    rows = _one_per_snapshot(df, key, snapshot, state, order).withColumn("ord", F.array_position(delivered, F.col("snap")).cast("int")).drop("snap")
    w = Window.partitionBy("key").orderBy("ord")
    same = F.lag("ord").over(w) == F.col("ord") - 1
    for k in state:
        same = same & F.lag(f"s_{k}").over(w).eqNullSafe(F.col(f"s_{k}"))
    islands = rows.withColumn("starts", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("island", F.sum("starts").over(w))
    out = islands.groupBy("key", "island").agg(F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"), *(F.first(f"s_{k}").alias(f"s_{k}") for k in state))
    return out.withColumn("delivered", delivered)


def change_events(intervals: DataFrame) -> DataFrame:
    """``snapshot_no, key, change_type`` of each difference between consecutive delivered snapshots; none for the first."""
    w = Window.partitionBy("key").orderBy("island")
    touched = F.coalesce(F.lag("last_ord").over(w) == F.col("first_ord") - 1, F.lit(False))
    goes_on = F.coalesce(F.lead("first_ord").over(w) == F.col("last_ord") + 1, F.lit(False))
    ends = intervals.select("key", "delivered", "first_ord", "last_ord", touched.alias("touched"), goes_on.alias("goes_on"))
    start = F.when(F.col("first_ord") > 1, F.struct(F.col("first_ord").alias("ord"), F.when(F.col("touched"), "changed").otherwise("added").alias("change_type")))
    end = F.when(~F.col("goes_on") & (F.col("last_ord") < F.size("delivered")), F.struct((F.col("last_ord") + 1).alias("ord"), F.lit("removed").alias("change_type")))
    events = ends.select("key", "delivered", F.explode(F.array_compact(F.array(start, end))).alias("e"))
    return events.select(F.element_at("delivered", F.col("e.ord")).alias("snapshot_no"), "key", F.col("e.change_type").alias("change_type"))
