"""History of changing entity attributes from snapshots and updates, by Merkle comparison of consecutive deliveries.

The log is cut into periods. What a period delivers is hashed into key buckets, and the buckets into a tree; a bucket's
digest covers the set of keys delivered and the state of each, so a snapshot that repeats the one before has the
digests of the one before, whatever its number of rows. Only branches whose digest differs from the delivery before
are descended. Rows are read by entity only in the leaves so found: their states are compared and the new versions are
appended. Everything up to there is sums of hashes that are combined before each shuffle; no entity's state is
compared with the one before outside of a differing leaf.

An entity's rows of one period form one group, and what goes on beyond a period passes through one summary row per
entity and period, so an entity that holds a third of the log never makes one large group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.session import BROADCAST_ROWS, cut_lineage, maybe_broadcast

CLOSED = "closed"
DAY = 86_400_000_000


def _state() -> Column:
    return F.when(F.col("closed_at").isNotNull(), CLOSED).when(F.col("value").isNull(), "null").otherwise(F.concat(F.lit("="), "value"))


def delivered_rows(log: DataFrame, period_us: int) -> DataFrame:
    """Usable rows of the log with the period (``cut``) they were delivered in and their key's number (``k``)."""
    rows = log.select("key", "t", "tie", "value", "closed_at").filter("key is not null and t is not null")
    return rows.withColumns({"cut": ((F.col("t") - F.pmod(F.col("t"), F.lit(period_us))) / F.lit(period_us)).cast("bigint"), "k": F.xxhash64("key")})


def entity_digests(rows: DataFrame) -> DataFrame:
    """Per key number and period the smallest and largest digest of the states delivered; combined before the shuffle."""
    digest = F.xxhash64(F.lit(1), _state(), "key")
    return rows.groupBy("cut", "k").agg(F.min(digest).alias("low"), F.max(digest).alias("high"))


def _digest(*fields: Column | str) -> Column:
    """128 bits over a set of rows, whatever their order: a struct of two sums of hashes, combined before the shuffle."""
    return F.struct(F.bit_xor(F.xxhash64(*fields)).alias("a"), F.bit_xor(F.xxhash64(*reversed(fields), F.lit(1))).alias("b"))


def merkle_leaves(digests: DataFrame, buckets: int) -> DataFrame:
    """``cut, node, was, became``: a bucket's digest in a period, and in the last period that delivered to it.

    A bucket in which a key was delivered with several states gets a digest that no other period has.
    """
    mixed = F.when(F.max(F.col("low") != F.col("high")), F.col("cut"))
    leaves = digests.groupBy("cut", F.pmod("k", F.lit(buckets)).cast("bigint").alias("node")).agg(_digest("k", "low").alias("set"), mixed.alias("mixed"))
    leaves = leaves.select("cut", "node", F.struct("set.a", "set.b", "mixed").alias("became"))
    was = F.lag("became").over(Window.partitionBy("node").orderBy("cut"))
    return leaves.select("cut", "node", "became", was.alias("was")).select(
        "cut", "node", *(F.when(F.col(c).isNotNull(), F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"))).alias(c) for c in ("was", "became"))
    )


def merkle_parents(children: DataFrame, fanout: int) -> DataFrame:
    """The level above: a node's digests cover its children's numbers and digests."""
    both = {c: _digest("node", F.col(f"{c}.a"), F.col(f"{c}.b")).alias(c) for c in ("was", "became")}
    return children.groupBy("cut", F.floor(F.col("node") / fanout).cast("bigint").alias("parent")).agg(*both.values()).withColumnRenamed("parent", "node")


def _differs() -> Column:
    return ~F.col("was").eqNullSafe(F.col("became"))


def differing_leaves(leaves: DataFrame, depth: int, fanout: int) -> DataFrame:
    """``cut, node`` of the leaf buckets that differ, found from the roots down through differing branches only."""
    levels = [leaves]
    for _ in range(depth):
        levels.append(cut_lineage(merkle_parents(levels[-1], fanout)))
    found = levels[-1].filter(_differs()).select("cut", "node")
    for level in reversed(levels[:-1]):
        parents = found.select("cut", F.col("node").alias("parent"))
        found = level.withColumn("parent", F.floor(F.col("node") / fanout).cast("bigint")).join(parents, ["cut", "parent"], "left_semi").filter(_differs()).select("cut", "node")
    return found


def changed_rows(log: DataFrame, period_us: int = DAY, leaf_keys: int = 1, fanout: int = 16) -> DataFrame:
    """The rows of the log that lie in differing leaves; all others repeat a state already held.

    There is a leaf bucket for every ``leaf_keys`` keys or so, and as many levels as those need: both grow with the data.
    """
    rows = delivered_rows(log, period_us)
    # some 20 bytes a key and period stand for the log up to the leaves, which every level of the trees reads again
    digests = cut_lineage(entity_digests(rows))
    keys = digests.agg(F.approx_count_distinct("k").alias("n")).first().n
    buckets = max(1, -(-keys // leaf_keys))
    leaves = cut_lineage(merkle_leaves(digests, buckets))
    found = differing_leaves(leaves, max(1, math.ceil(math.log(buckets, fanout))), fanout)
    return rows.withColumn("node", F.pmod("k", F.lit(buckets)).cast("bigint")).join(maybe_broadcast(found, 4 * BROADCAST_ROWS), ["cut", "node"], "left_semi").select("key", "cut", "t", "tie", "value", "closed_at")


def append_versions(changed: DataFrame) -> DataFrame:
    """``key, value, valid_from, valid_to`` of the versions that begin in the given rows.

    Runs of one state are found within an entity's period. One summary row per entity and period tells the next period
    what was held before it, and the earlier ones when what they left open ends.
    """
    one = changed.groupBy("key", "cut", "t").agg(F.max(F.struct("tie", "value", "closed_at")).alias("r")).select("key", "cut", "t", "r.value", "r.closed_at")
    w = Window.partitionBy("key", "cut").orderBy("t")
    runs = one.withColumn("state", _state()).withColumn("last", F.lag("state").over(w)).filter(~F.col("last").eqNullSafe(F.col("state")))
    # read again by the summary below
    runs = cut_lineage(runs.withColumn("run", F.row_number().over(w)).withColumn("ends", F.coalesce("closed_at", "t")).withColumn("next_end", F.lead("ends").over(w)))
    held = runs.groupBy("key", "cut").agg(F.min_by("state", "run").alias("first"), F.max_by("state", "run").alias("last"), F.min_by("ends", "run").alias("end1"), F.min_by("next_end", "run").alias("end2"))
    by_cut = Window.partitionBy("key").orderBy("cut")
    before = F.lag("last").over(by_cut)
    # a first run that only goes on from the period before is no version; then the second is the first to end what was open
    held = held.withColumn("before", before).withColumn("ends_open", F.when(F.col("before").eqNullSafe(F.col("first")), F.col("end2")).otherwise(F.col("end1")))
    later = Window.partitionBy("key").orderBy(F.desc("cut")).rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("key", "cut", "before", F.last("ends_open", ignorenulls=True).over(later).alias("later_end"))
    new = runs.filter(F.col("state") != CLOSED).join(held, ["key", "cut"]).filter(~((F.col("run") == 1) & F.col("before").eqNullSafe(F.col("state"))))
    return new.select("key", "value", F.col("t").alias("valid_from"), F.coalesce("next_end", "later_end").alias("valid_to"))


def entity_history(log: DataFrame, period_us: int = DAY, leaf_keys: int = 1, fanout: int = 16) -> DataFrame:
    """``key, value, valid_from, valid_to`` (microseconds; valid_to null while open) of every version of every entity.

    ``log`` has ``key, t, tie, value, closed_at``; other columns are ignored. Rows of a key are taken by t, of equal t
    the one with the highest tie. A row with closed_at ends the open version at closed_at and opens none; any other
    opens a version at its t if none is open or the open one has another value, and ends that one at the same time. A
    null value is a value of its own. Rows without key or t belong to no history; late rows and repeated ones change
    nothing, since the log is taken by time. A value that returns opens a new version. An empty log has no versions.
    """
    return append_versions(changed_rows(log, period_us, leaf_keys, fanout))


def whole_seconds(us: Column) -> Column:
    return ((us - F.pmod(us, F.lit(1_000_000))) / F.lit(1_000_000)).cast("bigint")
