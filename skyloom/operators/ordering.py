"""Places of rows in the order of their group, for groups that may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def places(df: DataFrame, key: str, slice_of: Column, order: Sequence[Column]) -> DataFrame:
    """``place`` from 0 of each row in its key's order.

    ``slice_of`` cuts a key's order into consecutive slices: it never falls along the order. Rows are numbered within
    their slice, and the sizes of the slices before give where a slice begins, so no task sorts a whole large group.
    Rows that the order doesn't tell apart are numbered in any order.
    """
    sliced = df.withColumn("__slice", slice_of)
    sizes = sliced.groupBy(key, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col(key).alias("__key"), F.col("__slice").alias("__s"), F.coalesce(before, F.lit(0)).alias("__before"))
    numbered = sliced.withColumn("__in", F.row_number().over(Window.partitionBy(key, "__slice").orderBy(*order)))
    met = numbered.join(starts, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__slice") == F.col("__s")))
    return met.select(*df.columns, (F.col("__before") + F.col("__in") - 1).cast("bigint").alias("place"))
