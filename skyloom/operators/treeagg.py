"""Per-key results when a few keys hold most rows: aggregation in a tree of bounded fan-in.

A plain ``groupBy(key)`` sends the partial states of a key from every map task to one reducer. Here the input is cut
into chunks of a fixed number of rows, the leaves of a tree. Each chunk is combined locally to one state per key, and
each round then merges the states of ``fan_in`` neighbouring nodes, so no task receives more than ``fan_in`` states of
one key in a round, and there are as many rounds as the number of chunks asks for. A state is one small row per key and
node, whatever the number of rows behind it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.session import cut_lineage

CHUNK_ROWS = 100_000


@dataclass(frozen=True)
class Merge:
    """An aggregate with a mergeable state: how rows make a state, how states merge."""

    start: Column
    merge: Callable[[Column], Column]


def rows() -> Merge:
    return Merge(F.count(F.lit(1)), F.sum)


def count_of(c: Column) -> Merge:
    """Rows where c is not null."""
    return Merge(F.count(c), F.sum)


def smallest(c: Column) -> Merge:
    return Merge(F.min(c), F.min)


def largest(c: Column) -> Merge:
    return Merge(F.max(c), F.max)


def total(c: Column) -> Merge:
    return Merge(F.sum(c), F.sum)


def latest(order: Sequence[Column], values: dict[str, Column]) -> Merge:
    """The values of the row that is last in the order; null orders come first, ties go to the largest values."""
    state = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), *(v.alias(k) for k, v in values.items()))
    return Merge(F.max(state), F.max)


def _free_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def tree_rounds(df: DataFrame, keys: Sequence[str], merges: dict[str, Merge], fan_in: int = 16, chunk_rows: int = CHUNK_ROWS) -> tuple[list[DataFrame], str]:
    """The states after the leaves and after every round, and the name of the column that numbers the nodes; the last has one node."""
    part, chunk, node = (_free_name(df, f"__tree_{x}") for x in ("part", "chunk", "node"))
    # rows are numbered within each input split: the split in the upper bits, the place in the lower 33
    row = F.monotonically_increasing_id()
    leaves = df.withColumns({part: F.shiftright(row, 33), chunk: F.floor(row.bitwiseAND(F.lit(2**33 - 1)) / chunk_rows).cast("bigint")})
    leaves = cut_lineage(leaves.groupBy(*keys, part, chunk).agg(*(m.start.alias(k) for k, m in merges.items())))
    last = leaves.agg(F.max(part).alias("p"), F.max(chunk).alias("c")).first()
    chunks_a_split = (last.c or 0) + 1
    nodes = ((last.p or 0) + 1) * chunks_a_split
    rounds = [leaves.withColumn(node, F.col(part) * chunks_a_split + F.col(chunk)).drop(part, chunk)]
    for _ in range(max(1, math.ceil(round(math.log(nodes, fan_in), 9)))):
        up = rounds[-1].withColumn(node, F.floor(F.col(node) / fan_in).cast("bigint"))
        rounds.append(up.groupBy(*keys, node).agg(*(m.merge(F.col(k)).alias(k) for k, m in merges.items())))
    return rounds, node


def tree_aggregate(df: DataFrame, keys: Sequence[str], merges: dict[str, Merge], fan_in: int = 16, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per key with the merged states.

    Null keys form a group of their own, as in SQL; an empty ``keys`` gives totals (no row for an empty input).
    Repeated rows count each time. Columns that neither keys nor merges name are never read.
    """
    rounds, node = tree_rounds(df, keys, merges, fan_in, chunk_rows)
    return rounds[-1].drop(node)


def heavy_keys(df: DataFrame, key: str, share: float, **tree) -> DataFrame:
    """Keys that hold more than ``share`` of all rows, with their row counts; a null key counts in the total only."""
    counts = cut_lineage(tree_aggregate(df.select(key), [key], {"n_rows": rows()}, **tree))
    everything = counts.agg(F.sum("n_rows").alias("n")).select("n").scalar()
    return counts.filter(F.col(key).isNotNull() & (F.col("n_rows") > F.lit(share) * everything))
