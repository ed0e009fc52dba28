"""Implausible readings, judged by their own source: isolation forests, physical limits and frozen values.

The readings of a source are scored by an isolation forest of that source on four features per field: level (distance
from the running median over wavelength, or over time for what does not depend on wavelength), difference (the smaller
of the steps from the reading before and to the one after), season (distance from the readings nearest in wavelength)
and run length (readings in a row with one value). The forest decides: readings that it isolates no sooner than usual
are the source's ordinary ones, and only they make its curve and scatter; the others are candidates, and only they are
tested against that curve and scatter.

A source of many readings is split into blocks, each with a forest of its own that samples its share of the source.
Curve and scatter come from sums over the ordinary readings of all blocks, so they are the same least squares whether
a source is one block or many, and no task ever holds more than a block of one source.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.functions.forest import forest_scores
from skyloom.session import cut_lineage, maybe_broadcast

FIELDS = ("point_flux_uJy", "wavelength_um", "chi2_reduced")
JUDGED = ("point_flux_uJy", "chi2_reduced")
WAVELENGTHS = (0.7, 5.1)
FROZEN = 5  # readings in a row
SCATTERS = 10.0
LEAST = 20  # distinct readings of a source
TERMS = 5  # of the curve over wavelength
ORDINARY = 0.35  # readings with a lower score are ordinary
POWERS = 2 * TERMS - 1
SUMS = POWERS + TERMS + 1  # of the powers of wavelength, of their products with the value, and of its square
PARTS = "source_id string, block bigint, measurement_id string, field_name string, value double, wavelength double, score double, reason string, n bigint, sums array<double>"
FIT = "source_id string, field_name string, n bigint, coef array<double>, scatter double"


def six_digits(v: np.ndarray) -> np.ndarray:
    """Mantissa and exponent of values rounded to six significant digits; NaN for what is not finite."""
    with np.errstate(all="ignore"):
        size = np.abs(v)
        e = np.where(size > 0, np.floor(np.log10(np.where(size > 0, size, 1.0))), 0.0)
        m = np.rint(v / 10.0 ** (e - 5))
        over = np.abs(m) >= 1e6
        return np.stack([np.where(over, np.rint(m / 10), m), e + over])


def run_lengths(value: np.ndarray, run: np.ndarray) -> np.ndarray:
    """For each reading the number of consecutive ones of its run that hold its value, NaN (null) skipped."""
    out = np.zeros(len(value), np.int64)
    at = np.flatnonzero(~np.isnan(value))
    if len(at):
        m, e = six_digits(value[at])
        fresh = np.append(True, (run[at][1:] != run[at][:-1]) | (m[1:] != m[:-1]) | (e[1:] != e[:-1]))
        island = np.cumsum(fresh) - 1
        out[at] = np.bincount(island)[island]
    return out


def _place(w: np.ndarray) -> np.ndarray:
    """Wavelengths on a scale from -1 to 1."""
    return (w - 2.9) / 2.2


def _as_before(t: pa.Table, column: str) -> np.ndarray:
    """For each row from the second on whether it holds the value of the row before; two nulls are the same."""
    now, before = t[column][1:], t[column][:-1]
    both_null = pc.and_(pc.is_null(now), pc.is_null(before))
    return pc.or_(pc.fill_null(pc.equal(now, before), False), both_null).to_numpy()


class Chunk:
    """The distinct readings of whole blocks, in the order of source, block, run and time, as arrays."""

    def __init__(self, t: pa.Table):
        t = t.combine_chunks()
        if len(t) > 1:
            again = _as_before(t, "measurement_id") & _as_before(t, "created_us") & _as_before(t, "photometry_run_id") & _as_before(t, "source_id")
            t = t.filter(pa.array(np.append(True, ~again))).combine_chunks()
        self.table, self.n = t, len(t)
        block = np.append(True, ~(_as_before(t, "source_id") & _as_before(t, "block")))[: self.n]
        self.starts = np.flatnonzero(block)
        self.sizes = np.diff(np.append(self.starts, self.n))
        self.group = np.cumsum(block) - 1
        run = np.append(True, ~_as_before(t, "photometry_run_id"))[: self.n]
        self.run = np.cumsum(block | run)
        self.known = t["source_id"].is_valid().to_numpy()
        self.null = {f: t[f].is_null().to_numpy() for f in FIELDS}
        self.value = {f: t[f].fill_null(float("nan")).to_numpy() for f in FIELDS}
        self.length = {f: np.where(self.known, run_lengths(np.where(np.isfinite(v), v, np.where(self.null[f], np.nan, np.inf)), self.run), 0) for f, v in self.value.items()}
        # readings at the ends of a slice of a long run that are frozen together with those of the next slice
        given = t["frozen_bits"].fill_null(0).to_numpy() if "frozen_bits" in t.column_names else np.zeros(self.n, np.int64)
        self.frozen = {f: (v >= FROZEN) | ((given >> i & 1) == 1) for i, (f, v) in enumerate(self.length.items())}
        w, c = self.value["wavelength_um"], self.value["chi2_reduced"]
        out = {f: ~np.isfinite(v) & ~self.null[f] for f, v in self.value.items()}
        with np.errstate(invalid="ignore"):
            out["wavelength_um"] |= (w < WAVELENGTHS[0]) | (w > WAVELENGTHS[1])
            out["chi2_reduced"] |= c < 0
        self.limit = out
        self.usable = {f: ~self.null[f] & ~self.limit[f] & ~self.frozen[f] for f in FIELDS}
        self.seeds = t["seed"].to_numpy().view(np.uint64)[self.starts] if self.n else np.zeros(0, np.uint64)


def _chunks(batches: Iterator[pa.RecordBatch], least: int = 30_000) -> Iterator[Chunk]:
    """Whole blocks at a time from sorted batches; a block is bounded, so is what is kept back."""
    kept: list[pa.RecordBatch] = []
    rows, wanted = 0, least
    for batch in batches:
        kept.append(batch)
        rows += batch.num_rows
        if rows < wanted:
            continue
        t = pa.Table.from_batches(kept).combine_chunks()
        last = t.slice(len(t) - 1, 1)
        mine = pc.and_kleene(pc.equal(t["block"], last["block"][0]), pc.equal(t["source_id"], last["source_id"][0]) if last["source_id"][0].is_valid else pc.is_null(t["source_id"]))
        at = pc.index(mine, True).as_py()
        if at:
            yield Chunk(t.slice(0, at))
        kept = t.slice(at).to_batches()
        rows = len(t) - at
        wanted = max(least, 2 * rows)
    if rows:
        yield Chunk(pa.Table.from_batches(kept))


def _neighbours(v: np.ndarray, order: np.ndarray, group: np.ndarray, reach: int) -> np.ndarray:
    """For each value the ``reach`` ones before and after it in an order within its group, NaN beyond the group's ends."""
    s, g = v[order], group[order]
    cols = []
    for d in range(1, reach + 1):
        same = g[d:] == g[:-d]
        before, after = np.full(len(v), np.nan), np.full(len(v), np.nan)
        before[d:][same], after[:-d][same] = s[:-d][same], s[d:][same]
        cols += [before, after]
    out = np.empty((len(v), 2 * reach))
    out[order] = np.stack(cols, axis=1)
    return out


def _medians(m: np.ndarray) -> np.ndarray:
    """The median of each row without NaN; 0 for a row without values."""
    s = np.sort(m, axis=1)
    held = (~np.isnan(s)).sum(axis=1)
    row = np.arange(len(s))
    mid = (s[row, np.maximum((held - 1) // 2, 0)] + s[row, np.minimum(held // 2, s.shape[1] - 1)]) / 2
    return np.where(held > 0, mid, 0.0)


def _spread(rest: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """A robust scatter of each group's values."""
    order = np.lexsort((np.abs(rest), group))
    size = np.bincount(group, minlength=groups)
    first = np.cumsum(size) - size
    out = np.zeros(groups)
    held = size > 0
    out[held] = 1.4826 * np.abs(rest[order])[(first + size // 2)[held]]
    return out


def _squash(z: np.ndarray) -> np.ndarray:
    """Far values drawn nearer, but kept apart."""
    z = np.clip(np.nan_to_num(z, nan=0.0, posinf=1e6, neginf=-1e6), -1e6, 1e6)
    return np.sign(z) * np.where(np.abs(z) < 20, np.abs(z), 20 + 8 * np.log(np.maximum(np.abs(z), 20) / 20))


def _field_scores(c: Chunk, field: str, usable: np.ndarray) -> np.ndarray:
    """Forest scores of a field's readings; null readings have none. Level and scale come from the usable ones."""
    out = np.full(c.n, np.nan)
    held = np.flatnonzero(~c.null[field])
    if not len(held):
        return out
    v, g = c.value[field][held], c.group[held]
    good = usable[held]
    along = c.value["wavelength_um"][held] if field == "point_flux_uJy" else held
    order = np.lexsort((np.where(good, along, np.inf), g))
    # what is not usable is no neighbour of anything
    pool = np.where(good, v, np.nan)
    with np.errstate(all="ignore"):
        rest = v - _medians(_neighbours(pool, order, g, 5))
        scale = _spread(np.nan_to_num(rest[good]), g[good], len(c.starts))[g]
        z = rest / np.maximum(scale, 1e-12 * np.abs(v) + 1e-300)
        clean = np.where(good, z, np.nan)
        season = z - _medians(_neighbours(clean, order, g, 2))
        step = np.abs(np.nan_to_num(z, posinf=1e6, neginf=-1e6)[:, None] - np.nan_to_num(_neighbours(z, np.arange(len(held)), c.run[held], 1), nan=np.inf, posinf=1e6, neginf=-1e6)).min(axis=1)
        step = np.where(np.isfinite(step), step, 0.0)
    x = np.stack([_squash(z), _squash(step), _squash(season), np.log1p(c.length[field][held])], axis=1)
    starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    out[held] = forest_scores(x, starts, c.seeds[g[starts]] + np.uint64(FIELDS.index(field)))
    return out


def _moments(c: Chunk, value: np.ndarray, w: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """SUMS per block over the readings that are ok; with w of 0 they are those of a mean."""
    at = np.flatnonzero(ok)
    x, y, g = w[at], value[at], c.group[at]
    powers = np.vander(x, POWERS, increasing=True)
    cols = [powers[:, k] for k in range(POWERS)] + [powers[:, k] * y for k in range(TERMS)] + [y * y]
    return np.stack([np.bincount(g, col, minlength=len(c.starts)) for col in cols], axis=1)


def _strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())


def _judge(c: Chunk, flagged_only: bool) -> Iterator[pa.RecordBatch]:
    """The readings to go on with (flagged ones and candidates, or all) and each block's sums, as rows of PARTS."""
    t, w = c.table, c.value["wavelength_um"]
    by_wave = c.usable["wavelength_um"]
    source, block, name = (t[k].combine_chunks() for k in ("source_id", "block", "measurement_id"))
    for f in FIELDS:
        usable = c.usable[f] & by_wave if f == "point_flux_uJy" else c.usable[f]
        reason = np.select([c.limit[f], c.frozen[f]], ["limit", "frozen"], "")
        if f in JUDGED:
            score = _field_scores(c, f, usable)
            ordinary = usable & (score < ORDINARY)
            place = np.where(by_wave, _place(w), 0.0) if f == "point_flux_uJy" else np.zeros(c.n)
            sums = _moments(c, c.value[f], place, ordinary)
            at = pa.array(c.starts)
            yield pa.RecordBatch.from_pydict({
                "source_id": source.take(at), "block": block.take(at), "measurement_id": pa.nulls(len(at), pa.string()), "field_name": _strings([f] * len(at)), "value": pa.nulls(len(at), pa.float64()), "wavelength": pa.nulls(len(at), pa.float64()),
                "score": pa.nulls(len(at), pa.float64()), "reason": pa.nulls(len(at), pa.string()), "n": pa.array(c.sizes, pa.int64()), "sums": pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * SUMS, pa.int32()), pa.array(sums.ravel().astype(np.float64))),
            })
            judged = ~c.null[f] & ~c.limit[f] & c.known & (by_wave if f == "point_flux_uJy" else True)
            reason = np.where((reason == "") & judged & ~ordinary, "candidate", reason)
        else:
            score = np.full(c.n, np.nan) if flagged_only else _field_scores(c, f, usable)
        keep = (reason != "") if flagged_only else ~c.null[f]
        at = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_pydict({
            "source_id": source.take(at), "block": block.take(at), "measurement_id": name.take(at), "field_name": _strings([f] * len(at)), "value": pa.array(c.value[f][keep]),
            "wavelength": pa.array(np.where(by_wave, w, np.nan)[keep], from_pandas=True), "score": pa.array(score[keep], from_pandas=True), "reason": _strings([x or None for x in reason[keep].tolist()]),
            "n": pa.nulls(len(at), pa.int64()), "sums": pa.nulls(len(at), pa.list_(pa.float64())),
        })


def _judge_batches(flagged_only: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunks(batches):
            yield from _judge(c, flagged_only)

    return run


def solve(n: np.ndarray, sums: np.ndarray, curved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares coefficients and scatter of each row of sums; a curve's terms grow with its readings, a mean has one."""
    ordinary, coef, scatter = sums[:, 0], np.zeros((len(n), TERMS)), np.full(len(n), np.nan)
    terms = np.where(~curved, 1, np.select([ordinary >= 60, ordinary >= 30, ordinary >= 12], [TERMS, 4, 3], 1))
    for k in np.unique(terms):
        mine = np.flatnonzero((terms == k) & (ordinary > k))
        if not len(mine):
            continue
        left = np.stack([sums[mine][:, i : i + k] for i in range(k)], axis=1)
        right = sums[mine][:, POWERS : POWERS + k]
        # wavelengths that don't span a curve get the shortest solution
        c = np.einsum("nij,nj->ni", np.linalg.pinv(left, rcond=1e-12, hermitian=True), right)
        coef[mine, :k] = c
        rest = sums[mine][:, -1] - 2 * np.einsum("ni,ni->n", c, right) + np.einsum("ni,nij,nj->n", c, left, c)
        scatter[mine] = np.sqrt(np.maximum(rest, 0) / (ordinary[mine] - k))
    return coef, scatter


def _solve_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sums = np.stack([b.column(f"s{i}").to_numpy(zero_copy_only=False) for i in range(SUMS)], axis=1)
        coef, scatter = solve(b.column("n").to_numpy(zero_copy_only=False), sums, pc.equal(b.column("field_name"), "point_flux_uJy").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_pydict({"source_id": b.column("source_id"), "field_name": b.column("field_name"), "n": b.column("n"), "coef": pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * TERMS, pa.int32()), pa.array(coef.ravel())), "scatter": pa.array(scatter)})


def usual_fits(sums: DataFrame) -> DataFrame:
    """FIT rows: every source's curve or mean and scatter, from the sums of all its blocks."""
    merged = sums.filter("source_id is not null").groupBy("source_id", "field_name").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(SUMS)))
    return merged.mapInArrow(_solve_batches, FIT)


def slice_runs(rows: DataFrame, runs: DataFrame, run_rows: int) -> DataFrame:
    """Rows of long runs with the ``slice`` of time they lie in, and as ``frozen_bits`` the fields in which they are frozen only together with another slice.

    ``runs`` has ``holder, unit, n, low, high`` of the long runs. A run is cut into many equal steps of time, and steps
    are joined to slices of about ``run_rows`` rows; readings of one instant stay together. Runs of equal values are
    counted in each slice, and those at the ends of slices are put together from one row per slice, so no task holds
    more than a slice of one run.
    """
    by = ["holder", "unit"]
    steps = F.ceil(F.col("n") / run_rows) * 16
    step = F.floor((F.col("created_us") - F.col("low")) / (F.col("high") - F.col("low") + 1) * steps).cast("bigint")
    # repeated deliveries count once, as they do within a block
    # readings without a time come before all others; names and times as they are joined are never null
    long = rows.join(runs, by).withColumns({"step": F.coalesce(step, F.lit(-1)), "at": F.coalesce("created_us", F.lit(-(2**62))), "name": F.coalesce("measurement_id", F.lit(""))}).drop("n", "low", "high").dropDuplicates([*by, "name", "at"])
    sizes = long.groupBy(*by, "step").count()
    before = F.sum("count").over(Window.partitionBy(*by).orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
    slices = sizes.select(*by, "step", F.floor(F.coalesce(before, F.lit(0)) / run_rows).cast("bigint").alias("slice"))
    long = cut_lineage(long.join(maybe_broadcast(slices), [*by, "step"]).drop("step"))
    finite = lambda c: ~F.isnan(c) & (F.abs(c) != float("inf"))
    digits = lambda c: F.when(finite(F.col(c)), F.format_string("%.5e", c)).otherwise("not finite")
    fields = F.array(*(F.struct(F.lit(i).alias("field"), F.when(F.col(f).isNotNull(), digits(f)).alias("digits")) for i, f in enumerate(FIELDS)))
    values = long.select(*by, "slice", "at", "name", F.inline(fields)).filter("digits is not null")
    w = Window.partitionBy(*by, "slice", "field").orderBy("at", "name")
    values = values.withColumn("fresh", F.when(F.lag("digits").over(w).eqNullSafe(F.col("digits")), 0).otherwise(1)).withColumn("island", F.sum("fresh").over(w))
    islands = values.groupBy(*by, "slice", "field", "island").agg(F.count(F.lit(1)).alias("size"), F.first("digits").alias("digits"))
    whole = Window.partitionBy(*by, "slice", "field")
    ends = islands.withColumn("last", F.max("island").over(whole)).filter("island = 1 or island = last")
    along = Window.partitionBy(*by, "field").orderBy("slice", "island")
    goes_on = (F.lag("slice").over(along) != F.col("slice")) & (F.lag("digits").over(along) == F.col("digits"))
    ends = ends.withColumn("starts", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn("chain", F.sum("starts").over(along))
    frozen = ends.withColumn("total", F.sum("size").over(Window.partitionBy(*by, "field", "chain"))).filter(f"total >= {FROZEN} and size < {FROZEN}").select(*by, "slice", "field", "island")
    bits = values.join(frozen, [*by, "slice", "field", "island"], "left_semi").groupBy(*by, "slice", "at", "name").agg(F.sum(F.pow(F.lit(2), F.col("field")).cast("bigint")).alias("frozen_bits"))
    return long.join(bits, [*by, "slice", "at", "name"], "left").drop("at", "name")


def score_readings(m: DataFrame, block_rows: int = 4096, flagged_only: bool = False, run_rows: int = 50_000) -> DataFrame:
    """``measurement_id, source_id, field_name, value, score, scatters, reason`` of every not-null reading of FIELDS: its forest score, its distance from the usual in scatters, and the reason it is wrong.

    ``m`` has ``measurement_id, source_id, photometry_run_id, created_us`` and FIELDS; other columns are ignored. Rows
    repeated exactly count once. Reasons: ``limit`` (not finite, wavelength outside 0.7..5.1, chi2 below 0), ``frozen``
    (one of at least five consecutive values of a source's run that agree to six digits, nulls skipped) and
    ``outlier`` (flux and chi2 of sources with at least 20 distinct readings: a candidate of the forest that is further
    than ten scatters from the source's curve over wavelength, or its mean). Flux without a usable wavelength is no
    outlier. Readings without a source are judged by limits only. A null run counts as one run. An empty table has no
    rows. With ``flagged_only`` only readings with a reason come out. Sources of more than ``block_rows`` readings are
    split by run into blocks, and runs of more than ``run_rows`` by time.
    """
    rows = m.select("measurement_id", "source_id", "photometry_run_id", F.col("created_us").cast("bigint").alias("created_us"), *(F.col(f).cast("double").alias(f) for f in FIELDS))
    # readings without a source are shared out like those of one large source
    by_id = F.concat(F.lit("m"), "measurement_id")
    run = F.when(F.col("photometry_run_id").isNull(), "?").otherwise(F.concat(F.lit("="), "photometry_run_id"))
    lost = F.col("source_id").isNull()
    rows = rows.withColumns({"holder": F.when(lost, "?").otherwise(F.concat(F.lit("="), "source_id")), "unit": F.when(lost, by_id).otherwise(run)})
    counted = cut_lineage(rows.groupBy("holder", F.when(lost, "?").otherwise(F.col("unit")).alias("unit")).agg(F.count(F.lit(1)).alias("n"), F.min("created_us").alias("low"), F.max("created_us").alias("high")))
    large = maybe_broadcast(counted.groupBy("holder").agg(F.sum("n").alias("n")).filter(F.col("n") > block_rows).select("holder", F.ceil(F.col("n") / block_rows).alias("blocks")))
    runs = maybe_broadcast(counted.filter((F.col("holder") != "?") & (F.col("n") > run_rows)))
    order = ["source_id", "block", "photometry_run_id", "created_us", "measurement_id"]
    cols = [*order, *FIELDS, "frozen_bits"]
    short = rows.join(large, "holder", "left").withColumn("block", F.pmod(F.xxhash64("unit"), F.coalesce("blocks", F.lit(1))).cast("bigint")).withColumn("frozen_bits", F.lit(None).cast("bigint"))
    if runs.isEmpty():
        blocked = short.select(*cols)
    else:
        sliced = slice_runs(rows, runs, run_rows).withColumn("block", F.xxhash64("unit", "slice"))
        blocked = short.join(runs, ["holder", "unit"], "left_anti").select(*cols).unionByName(sliced.select(*cols))
    blocked = blocked.withColumn("seed", F.xxhash64("source_id", "block"))
    # flagged readings, candidates and sums are far fewer than the readings, and are read three times
    parts = blocked.repartition("source_id", "block").sortWithinPartitions(*order).mapInArrow(_judge_batches(flagged_only), PARTS)
    parts = cut_lineage(parts)
    sums = parts.filter("sums is not null")
    fits = sums.select("source_id", "block", "field_name").join(usual_fits(sums), ["source_id", "field_name"])
    readings = parts.filter("sums is null").drop("sums", "n").join(maybe_broadcast(fits), ["source_id", "block", "field_name"], "left")
    x = F.when(F.col("field_name") == "point_flux_uJy", (F.col("wavelength") - 2.9) / 2.2).otherwise(0.0)
    usual = F.col("coef")[TERMS - 1]
    for i in range(TERMS - 2, -1, -1):
        usual = usual * x + F.col("coef")[i]
    away = F.abs(F.col("value") - usual) / F.greatest(F.col("scatter"), 1e-12 * F.abs(usual) + 1e-300)
    scatters = F.when((F.col("n") >= LEAST) & ~F.isnan("scatter"), away)
    reason = F.when(F.col("reason") != "candidate", F.col("reason")).when((F.col("reason") == "candidate") & (scatters > SCATTERS), "outlier")
    out = readings.select("measurement_id", "source_id", "field_name", "value", "score", F.when(F.col("field_name").isin(*JUDGED), scatters).alias("scatters"), reason.alias("reason"))
    return out.filter("reason is not null") if flagged_only else out
