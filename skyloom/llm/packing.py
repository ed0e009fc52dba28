"""Filling containers of fixed capacity by a grouping genetic algorithm on islands.

Items are dealt into blocks by hash, each block small enough for one task. Every block is evolved by several islands,
each a population of its own in its own task; after each epoch an island's best solution migrates to the next island.
Crossover injects whole well-filled bins of one parent into another, drops the bins that hold an injected item, and
puts displaced items back where they fit best. A population starts from plain best fit, in orders by chance, and an
island ends when its bins are as few as the items' sum allows or when no child has been better for some generations.
Bins that a block leaves poorly filled are opened, and their items go to the next round's blocks, until one block is
left; so only that last block leaves room.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import cut_lineage

STATE = "block int, island int, sizes array<int>, population array<array<int>>, fit double"


def pieces(sizes: DataFrame, capacity: int) -> DataFrame:
    """``doc_id, part, start, size``: an item above the capacity is cut into full parts and a rest, every other is one part."""
    n = F.col("n_tokens")
    parts = F.greatest(F.ceil(n / capacity), F.lit(1)).cast("int")
    one = sizes.select("doc_id", n.alias("n"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return one.select("doc_id", "part", (F.col("part") * capacity).cast("bigint").alias("start"), F.least(F.lit(capacity), F.col("n") - F.col("part") * capacity).cast("int").alias("size"))


# ---- one island's evolution; a solution is the bin number of each item


def _fill(items: list[int], sizes: list[int], bins: list[int], room: list[int], capacity: int) -> None:
    """Put items, largest first, where they fit best; open bins where they fit nowhere."""
    order = sorted((r, b) for b, r in enumerate(room))
    for i in items:
        at = bisect_left(order, (sizes[i], -1))
        if at == len(order):
            room.append(capacity)
            b, left = len(room) - 1, capacity
        else:
            left, b = order.pop(at)
        bins[i], room[b] = b, left - sizes[i]
        insort(order, (room[b], b))


def _solve(order: list[int], sizes: list[int], capacity: int) -> list[int]:
    bins, room = [0] * len(sizes), []
    _fill(order, sizes, bins, room, capacity)
    return bins


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> float:
    """Mean squared fill: higher with fewer bins and with unused space gathered in few of them."""
    fill = np.bincount(bins, sizes) / capacity
    return float((fill**2).sum() / max(len(fill), 1))


def crossover(into: np.ndarray, source: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """A child of ``into`` with some of the best-filled bins of ``source``."""
    fill = np.bincount(source, sizes)
    best = np.argsort(-fill, kind="stable")[: max(1, len(fill) * 2 // 3)]
    injected = rng.permutation(best)[: max(1, len(best) // 2)]
    moved = np.isin(source, injected)
    worst = np.argsort(np.bincount(into, sizes), kind="stable")[:2]  # the emptiest bins are opened as well
    dropped = np.zeros(into.max() + 1, bool)
    dropped[np.unique(into[moved])] = True
    dropped[worst] = True
    loose = np.flatnonzero(~moved & dropped[into])
    kept = np.cumsum(~dropped) - 1
    child = np.where(moved, 0, kept[into])
    base = int((~dropped).sum())
    child[moved] = base + np.unique(source[moved], return_inverse=True)[1]
    stay = np.ones(len(sizes), bool)
    stay[loose] = False
    room = (capacity - np.bincount(child[stay], sizes[stay], minlength=base + len(injected))).astype(int).tolist()
    out = child.tolist()
    _fill(loose[np.argsort(-sizes[loose], kind="stable")].tolist(), sizes.tolist(), out, room, capacity)
    return np.unique(np.array(out), return_inverse=True)[1]


def evolve(population: list[np.ndarray], sizes: np.ndarray, capacity: int, generations: int, seed: tuple[int, ...], patience: int = 60) -> list[np.ndarray]:
    """The population after some generations, best first; ends early when no solution can have fewer bins, or after ``patience`` generations without a better one."""
    rng = np.random.default_rng(seed)
    least = -(-int(sizes.sum()) // capacity)
    scored = sorted(((fitness(p, sizes, capacity), k, p) for k, p in enumerate(population)), key=lambda x: (-x[0], x[1]))
    since = 0
    for _ in range(generations):
        if scored[0][2].max() + 1 <= least or since >= patience:
            break
        a, b = sorted(rng.choice(len(scored), 2, replace=len(scored) < 2).tolist())
        into, source = (scored[a][2], scored[b][2]) if rng.random() < 0.5 else (scored[b][2], scored[a][2])
        child = crossover(into, source, sizes, capacity, rng)
        f = fitness(child, sizes, capacity)
        since = 0 if f > scored[0][0] + 1e-12 else since + 1
        if all(abs(f - s[0]) > 1e-12 for s in scored):
            scored[-1] = (f, 0, child)
            scored.sort(key=lambda x: -x[0])
    return [p for _, _, p in scored]


def _start(sizes: np.ndarray, capacity: int, individuals: int, seed: tuple[int, ...]) -> list[np.ndarray]:
    """Plain best fit, each time in another order."""
    rng = np.random.default_rng(seed)
    plain = sizes.tolist()
    return [np.array(_solve(rng.permutation(len(sizes)).tolist(), plain, capacity), np.int64) for _ in range(individuals)]


def _epoch(capacity: int, individuals: int, generations: int, epoch: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("block", "island", "sizes", "population", "fit")}
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                seed = (row["block"], row["island"], epoch)
                people = [np.array(p, np.int64) for p in row["population"] or []] or _start(sizes, capacity, individuals, seed)
                if row.get("guest") is not None:
                    people[-1] = np.array(row["guest"], np.int64)
                people = evolve(people, sizes, capacity, generations, seed)
                for k, v in (("block", row["block"]), ("island", row["island"]), ("sizes", row["sizes"]), ("population", [p.tolist() for p in people]), ("fit", fitness(people[0], sizes, capacity))):
                    out[k].append(v)
            types = {"block": pa.int32(), "island": pa.int32(), "sizes": pa.list_(pa.int32()), "population": pa.list_(pa.list_(pa.int32())), "fit": pa.float64()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in out.items()})

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the bins of their best solution as a row per item, with its bin's fill, and the best and the median fill in the block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        items, bins = batch.column("items"), batch.column("bins").flatten().to_numpy()
        n = np.diff(items.offsets.to_numpy())
        block = np.repeat(np.arange(batch.num_rows), n)
        size = items.flatten().field("size").to_numpy()
        width = int(bins.max()) + 1
        used = np.bincount(block * width + bins, size, minlength=batch.num_rows * width).reshape(batch.num_rows, width)
        held = np.bincount(block * width + bins, minlength=batch.num_rows * width).reshape(batch.num_rows, width) > 0
        best, middle = used.max(axis=1), np.array([np.median(u[h]) for u, h in zip(used, held, strict=True)])
        flat = items.flatten()
        yield pa.RecordBatch.from_pydict({
            "doc_id": flat.field("doc_id"), "part": flat.field("part"), "start": flat.field("start"), "size": flat.field("size"), "block": batch.column("block").take(pa.array(block)), "bin": pa.array(bins, pa.int32()),
            "used": pa.array(used[block, bins]), "best": pa.array(best[block]), "middle": pa.array(middle[block]),
        })


def _pack_blocks(items: DataFrame, blocks: int, capacity: int, salt: int, islands: int, individuals: int, epochs: int, generations: int) -> DataFrame:
    """``doc_id, part, start, size, block, bin, used, best, middle``: each item's bin in its block's best solution, its fill, and the best and the median fill of the block's bins."""
    dealt = items.withColumn("block", F.pmod(F.xxhash64("doc_id", "part", "size", F.lit(salt)), F.lit(blocks)).cast("int"))
    members = cut_lineage(dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("size", "doc_id", "part", "start"))).alias("items")))
    state = members.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("items.size").alias("sizes"), F.lit(None).cast("array<array<int>>").alias("population"), F.lit(None).cast("array<int>").alias("guest"))
    # an island is seconds of work on little data: their number, not their bytes, says how many tasks they take
    tasks = max(1, min(blocks * islands, max(4 * items.sparkSession.sparkContext.defaultParallelism, blocks * islands // 50)))
    for epoch in range(epochs):
        state = state.repartition(tasks, "block", "island").mapInArrow(_epoch(capacity, individuals, generations, epoch), STATE)
        if epoch + 1 < epochs:
            # every island hands its best solution to the next one
            ring = F.array_sort(F.collect_list(F.struct("island", "sizes", "population")))
            state = cut_lineage(state).groupBy("block").agg(ring.alias("ring")).select("block", F.posexplode("ring").alias("at", "one"), "ring")
            guest = F.element_at("ring", F.when(F.col("at") == 0, F.size("ring")).otherwise(F.col("at")))
            state = state.select("block", "one.island", "one.sizes", "one.population", guest["population"][0].alias("guest"))
    # of the islands' best solutions the one with the fewest bins, then with the fullest
    best = state.select("block", "island", "fit", F.col("population")[0].alias("bins")).groupBy("block").agg(F.max_by("bins", F.struct(-F.array_max("bins"), F.col("fit"), F.col("island"))).alias("bins"))
    doc = items.schema["doc_id"].dataType.simpleString()
    return members.join(best, "block").select("block", "items", "bins").mapInArrow(_unpack, f"doc_id {doc}, part int, start bigint, size int, block int, bin int, used double, best double, middle double")


def pack(
    sizes: DataFrame, capacity: int = 2048, block_items: int = 1000, full: float = 0.995, islands: int = 3, individuals: int = 4, epochs: int = 2, generations: int = 200
) -> DataFrame:
    """``doc_id, part, start_token, n_tokens, container_id`` of every item of ``doc_id, n_tokens``.

    No container holds more than the capacity. Only an item above it is split, into parts that fill containers and a
    rest; parts are numbered from 0 and start where the one before ends. Items of size 0 (empty and null texts) get a
    container too. Rows repeated exactly count once; rows of one doc_id with other sizes are items of their own. An
    empty table has no rows. In every round bins stay that are ``full`` times as full as the block's best, at least the
    better half of them, so that every round leaves at most half of the bins for the next, until one block is left.
    """
    items = cut_lineage(pieces(sizes.select("doc_id", F.greatest(F.coalesce("n_tokens", F.lit(0)), F.lit(0)).alias("n_tokens")).distinct(), capacity))
    whole = items.filter(F.col("size") == capacity)
    done = [whole.select("doc_id", "part", "start", "size", F.concat_ws("-", F.lit("full"), "doc_id", "start", F.xxhash64("doc_id", "start").cast("string")).alias("container_id"))]
    rest, round_no = items.filter(F.col("size") < capacity), 0
    while True:
        n = rest.count()
        if not n:
            break
        blocks = -(-n // block_items)
        packed = cut_lineage(_pack_blocks(rest, blocks, capacity, round_no, islands, individuals, epochs, generations))
        name = F.concat_ws("-", F.lit(f"r{round_no}"), "block", "bin").alias("container_id")
        if blocks == 1:
            done.append(packed.select("doc_id", "part", "start", "size", name))
            break
        kept = F.col("used") >= F.least(full * F.col("best"), F.col("middle"))
        done.append(packed.filter(kept).select("doc_id", "part", "start", "size", name))
        rest, round_no = packed.filter(~kept).select("doc_id", "part", "start", "size"), round_no + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("doc_id", "part", F.col("start").alias("start_token"), F.col("size").cast("bigint").alias("n_tokens"), "container_id")
