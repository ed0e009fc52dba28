"""Keyed upserts as a full outer join of a table with its incoming rows, and what they changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in the order; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    out = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__last"))
    return out.select(*(c if c in keys else F.col(f"__last.{c}").alias(c) for c in df.columns))


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], preserve: Sequence[str] = (), coalesce: Sequence[str] = ()) -> DataFrame:
    """The table after the upsert, in the existing columns.

    Incoming rows replace those with their keys, but ``preserve`` columns keep what they held, and ``coalesce``
    columns change only to what is not null. Both sides hold a key once (last_per_key() makes it so); keys that are
    null match each other. Doing it again changes nothing.
    """
    a, b = existing.withColumn("__old", F.lit(True)), incoming.withColumn("__new", F.lit(True))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = a.alias("a").join(b.alias("b"), on, "full")
    new = F.col("b.__new").isNotNull()

    def value(c: str):
        old = F.col(f"a.{c}")
        if c not in incoming.columns:
            return old
        fresh = F.col(f"b.{c}")
        if c in keys:
            return F.when(new, fresh).otherwise(old)
        if c in preserve:
            return F.when(F.col("a.__old").isNotNull(), old).otherwise(fresh)
        return F.coalesce(fresh, old) if c in coalesce else F.when(new, fresh).otherwise(old)

    return both.select(*(value(c).alias(c) for c in existing.columns))


def retire(table: DataFrame, present: DataFrame, keys: Sequence[str], active: str, retired_at: str, now) -> DataFrame:
    """Rows that are active but not among the present keys become inactive, retired now."""
    here = present.select(*keys).distinct().withColumn("__here", F.lit(True))
    gone = F.col("__here").isNull() & F.col(active)
    out = table.join(here, list(keys), "left").withColumn(retired_at, F.when(gone, now).otherwise(F.col(retired_at))).withColumn(active, F.col(active) & ~gone)
    return out.select(*table.columns)


def upsert_counts(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], content: str) -> DataFrame:
    """One row ``n_new, n_updated, n_unchanged, n_missing``."""
    a = existing.select(*keys, F.col(content).alias("__a"), F.lit(True).alias("__old"))
    b = incoming.select(*keys, F.col(content).alias("__b"), F.lit(True).alias("__new"))
    both = a.join(b, list(keys), "full")
    old, new, same = F.col("__old").isNotNull(), F.col("__new").isNotNull(), F.col("__a").eqNullSafe(F.col("__b"))
    return both.agg(F.count_if(~old).alias("n_new"), F.count_if(old & new & ~same).alias("n_updated"), F.count_if(old & new & same).alias("n_unchanged"), F.count_if(~new).alias("n_missing"))


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def missing_parents(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Key values of the child that the parent lacks, with their row counts."""
    keys = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    return keys.join(parent.select(F.col(parent_key).alias("key")).distinct(), "key", "left_anti")
