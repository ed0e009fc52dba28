"""Images as rows with arrays: masks, backgrounds and connected areas of many images at once, without a shuffle.

An image is a row of ``image_id``, ``width`` and arrays in row-major order (``value``, ``variance``, ``flag``,
``template``). A batch's images of one shape are worked on together as one block of numbers; an image never leaves its
task and takes no more memory than its own arrays, so the work grows with the number of pixels and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.operators import pixels
from skyloom.operators.background import CLIP, LEAST, LEAST_PLANE, MAD, ROUNDS, WORST_CONDITION

PLANE = "n_pixels bigint, b0 double, bx double, `by` double, rms double, uncertainty double, clipped_share double, ok boolean"
CONSTANT = "n_pixels bigint, value double, sigma double"
SHARES = ("fit_share", "background_share", "protected_share", "hard_bad_core_share", "source_fit_share", "central_fit_share", "template_unmasked", "template_hard_bad", "template_bad_variance")
COUNTS = ("n_fit", "n_background", "n_source_finding", "n_protected", "n_hard_bad", "n_science_bad_fit", "flags_all", "flags_fit", "flags_central", "flags_footprint")
STATISTICS = ", ".join([*(f"{c} bigint" for c in COUNTS), *(f"{c} double" for c in SHARES)])


def _block(column: pa.ListArray, rows: np.ndarray, size: int, kind: type) -> np.ndarray:
    """The arrays of some rows of one length as a block; nulls are NaN, or 0 in whole numbers."""
    flat = column.take(pa.array(rows)).flatten()
    return flat.fill_null(0 if kind is np.int64 else float("nan")).to_numpy(zero_copy_only=False).astype(kind).reshape(len(rows), size)


def over_images(images: DataFrame, columns: dict[str, type], work: Callable[[dict[str, np.ndarray], int], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """``image_id`` and what ``work`` makes of the blocks of each shape: arrays with an entry, or a row, per image.

    Images without pixels, and those whose arrays have different lengths, give no row.
    """
    names = [c.split()[0].strip("`") for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = np.stack([batch.column(c).value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for c in columns])
            width = batch.column("width").fill_null(0).to_numpy(zero_copy_only=False)
            whole = (lengths == lengths[0]).all(axis=0) & (lengths[0] > 0) & (width > 0)
            whole &= lengths[0] % np.maximum(width, 1) == 0
            for size, w in sorted({(int(a), int(b)) for a, b in zip(lengths[0][whole], width[whole], strict=True)}):
                rows = np.flatnonzero(whole & (lengths[0] == size) & (width == w))
                made = work({c: _block(batch.column(c), rows, size, k) for c, k in columns.items()}, w)
                out = {"image_id": batch.column("image_id").take(pa.array(rows))}
                for n in names:
                    v = made[n]
                    out[n] = pa.array(v, from_pandas=v.dtype.kind == "f") if v.ndim == 1 else pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel(), from_pandas=v.dtype.kind == "f"))
                yield pa.RecordBatch.from_pydict(out)

    kind = images.schema["image_id"].dataType.simpleString()
    return images.select("image_id", F.col("width").cast("int").alias("width"), *columns).mapInArrow(run, f"image_id {kind}, {schema}")


def _places(size: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.arange(size)
    return i % width, i // width


def _median(v: np.ndarray, keep: np.ndarray) -> np.ndarray:
    s = np.sort(np.where(keep, v, np.nan), axis=1)
    n = keep.sum(axis=1)
    row = np.arange(len(s))
    mid = (s[row, np.maximum((n - 1) // 2, 0)] + s[row, np.minimum(n // 2, s.shape[1] - 1)]) / 2
    return np.where(n > 0, mid, np.nan)


def _scatter(v: np.ndarray, keep: np.ndarray, mid: np.ndarray) -> np.ndarray:
    """1.4826 times the median distance from the median, or the standard deviation where that is 0."""
    mad = _median(np.abs(v - mid[:, None]), keep)
    n = np.maximum(keep.sum(axis=1), 1)
    mean = np.where(keep, v, 0).sum(axis=1) / n
    sd = np.sqrt((np.where(keep, v - mean[:, None], 0) ** 2).sum(axis=1) / n)
    return np.where(mad > 0, MAD * mad, sd)


def _plane_fit(value: np.ndarray, weight: np.ndarray, xc: np.ndarray, yc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of each image's weighted plane, NaN where the sums don't determine it, and whether they do."""
    s = lambda t: (weight * t).sum(axis=1)
    a = np.stack([np.stack([s(1.0), s(xc), s(yc)], 1), np.stack([s(xc), s(xc * xc), s(xc * yc)], 1), np.stack([s(yc), s(xc * yc), s(yc * yc)], 1)], 1)
    b = np.stack([s(value), s(xc * value), s(yc * value)], 1)
    det = np.linalg.det(a)
    ok = ((weight > 0).sum(axis=1) >= LEAST_PLANE) & (np.abs(det) * WORST_CONDITION > a[:, 0, 0] * a[:, 1, 1] * a[:, 2, 2])
    out = np.full((len(a), 3), np.nan)
    if ok.any():
        out[ok] = np.linalg.solve(a[ok], b[ok][..., None])[..., 0]
    return out, ok


def plane(value: np.ndarray, variance: np.ndarray, mask: np.ndarray, width: int, x0: float, y0: float) -> dict[str, np.ndarray]:
    """PLANE of each image: a weighted plane is fitted ROUNDS + 1 times, and pixels further from it than CLIP times the larger of robust scatter and noise are dropped."""
    x, y = _places(value.shape[1], width)
    xc, yc = (x - x0)[None, :], (y - y0)[None, :]
    v, noise = np.where(mask, value, 0.0), np.sqrt(np.where(mask, variance, 1.0))
    kept, n0 = mask.copy(), mask.sum(axis=1)
    for _ in range(ROUNDS + 1):
        fit, ok = _plane_fit(v, np.where(kept, 1 / noise**2, 0.0), xc, yc)
        with np.errstate(invalid="ignore"):
            rest = v - (fit[:, :1] + fit[:, 1:2] * xc + fit[:, 2:] * yc)
            rms = np.fmax(_scatter(rest, kept, _median(rest, kept)), _median(noise, kept))
            kept = kept & (np.abs(rest) <= CLIP * rms[:, None])
    n = kept.sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        rms = np.fmax(_scatter(rest, kept, _median(rest, kept)), _median(noise, kept))
        ok = ok & (n >= LEAST_PLANE)
        b0, bx, by = (np.where(ok, fit[:, k], np.nan) for k in range(3))
        return {"n_pixels": n, "b0": b0, "bx": bx, "by": by, "rms": np.where(ok, rms, np.nan), "uncertainty": np.where(ok, rms / np.sqrt(n), np.nan), "clipped_share": 1 - n / n0, "ok": ok}


def constant(value: np.ndarray, mask: np.ndarray, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """CONSTANT of each image: the median after rounds of clipping; once fewer than LEAST pixels are left nothing more is clipped."""
    v, kept = np.where(mask, value, 0.0), mask.copy()
    for _ in range(rounds):
        mid = _median(v, kept)
        sigma = _scatter(v, kept, mid)
        free = (kept.sum(axis=1) < LEAST) | ~(sigma > 0)
        kept = kept & (free[:, None] | (np.abs(v - mid[:, None]) <= CLIP * sigma[:, None]))
    mid = _median(v, kept)
    return {"n_pixels": kept.sum(axis=1), "value": mid, "sigma": _scatter(v, kept, mid)}


def calm(value: np.ndarray, base: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Base pixels within CLIP scatters of the median, both re-estimated from what each round keeps but always applied to the whole base."""
    v, out = np.where(base, value, 0.0), base.copy()
    for _ in range(rounds):
        mid = _median(v, out)
        sigma = _scatter(v, out, mid)
        out = np.where((sigma > 0)[:, None], base & (np.abs(v - mid[:, None]) <= CLIP * sigma[:, None]), out)
    return out


def _dilated(mask: np.ndarray, radius: int) -> np.ndarray:
    """Pixels of images (n x height x width) within a square of the radius around a masked one."""
    out = mask
    for axis in (1, 2):
        grown = out.copy()
        for d in range(1, min(radius, out.shape[axis] - 1) + 1):
            ahead, back = [slice(None)] * 3, [slice(None)] * 3
            ahead[axis], back[axis] = slice(d, None), slice(None, -d)
            grown[tuple(ahead)] |= out[tuple(back)]
            grown[tuple(back)] |= out[tuple(ahead)]
        out = grown
    return out


def masks(value: np.ndarray, variance: np.ndarray, flag: np.ndarray, template: np.ndarray, width: int, x0: float, y0: float) -> dict[str, np.ndarray]:
    """The masks of a forced measurement at a place."""
    n, size = value.shape
    x, y = _places(size, width)
    r2 = ((x - x0) ** 2 + (y - y0) ** 2)[None, :]
    bits = lambda names: (flag & pixels.bit_value(names)) != 0
    clean = np.nan_to_num(template, nan=0.0)
    peak = clean.max(axis=1, keepdims=True)
    footprint = lambda share: (peak > 0) & (clean >= peak * share)
    good = np.isfinite(variance) & (variance > 0)
    finite = np.isfinite(value) & good
    wide = _dilated(footprint(pixels.PROTECTED_FOOTPRINT).reshape(n, -1, width), pixels.PROTECTED_DILATION).reshape(n, size)
    m = {"good_variance": good, "hard_bad": bits(pixels.FIT_BITS), "science_bad": bits(pixels.SCIENCE_BITS), "source_flag": bits(["SOURCE"]), "central": np.broadcast_to(r2 <= pixels.CENTRAL_RADIUS**2, value.shape), "footprint": footprint(pixels.FOOTPRINT)}
    m["protected"] = (r2 <= pixels.PROTECTED_RADIUS**2) | wide
    m["fit"] = finite & ~m["hard_bad"]
    m["background"] = finite & ~bits(pixels.BACKGROUND_BITS) & ~m["protected"]
    edge = (x < pixels.EDGE) | (x > width - 1 - pixels.EDGE) | (y < pixels.EDGE) | (y > size // width - 1 - pixels.EDGE)
    m["source_finding"] = m["fit"] & ~m["protected"] & ~edge[None, :]
    m["fit_region"] = m["footprint"] | m["central"]
    return m


def mask_statistics(flag: np.ndarray, template: np.ndarray, m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """STATISTICS of each image's masks; shares of empty regions are 0."""
    count = lambda a: a.sum(axis=1)
    union = lambda a: np.bitwise_or.reduce(np.where(a, flag, 0), axis=1)
    every = np.ones(flag.shape, bool)

    def share(mask: np.ndarray, region: np.ndarray) -> np.ndarray:
        return count(mask & region) / np.maximum(count(region), 1)

    weight = np.maximum(np.nan_to_num(template, nan=0.0), 0.0)
    total = weight.sum(axis=1)
    weighted = lambda mask: np.where(total > 0, np.where(mask, weight, 0).sum(axis=1) / np.where(total > 0, total, 1), 0.0)
    out = {f"n_{k}": count(m[k]) for k in ("fit", "background", "source_finding", "protected", "hard_bad")} | {"n_science_bad_fit": count(m["science_bad"] & m["fit_region"])}
    out |= {"flags_all": union(every), "flags_fit": union(m["fit_region"]), "flags_central": union(m["central"]), "flags_footprint": union(m["footprint"])}
    out |= {"fit_share": share(m["fit"], every), "background_share": share(m["background"], every), "protected_share": share(m["protected"], every), "hard_bad_core_share": share(m["hard_bad"], m["central"])}
    out |= {"source_fit_share": share(m["source_flag"], m["fit_region"]), "central_fit_share": share(m["fit"], m["central"]), "template_unmasked": weighted(m["fit"]), "template_hard_bad": weighted(m["hard_bad"]), "template_bad_variance": weighted(~m["good_variance"])}
    return {k: v.astype(np.int64) if k in COUNTS else v for k, v in out.items()}


def label(mask: np.ndarray, width: int) -> np.ndarray:
    """For each masked pixel the first pixel of its 8-connected area, -1 elsewhere.

    Labels spread to the smallest among the neighbours, and a pixel also takes the label of its label, so that they
    travel further with every turn.
    """
    n, size = mask.shape
    none = size
    labels = np.where(mask, np.arange(size)[None, :], none)
    held = np.concatenate([mask, np.zeros((n, 1), bool)], axis=1)
    while True:
        grid = np.pad(labels.reshape(n, -1, width), ((0, 0), (1, 1), (1, 1)), constant_values=none)
        h = size // width
        least = np.minimum.reduce([grid[:, 1 + dy : 1 + dy + h, 1 + dx : 1 + dx + width] for dy in (-1, 0, 1) for dx in (-1, 0, 1)]).reshape(n, size)
        least = np.where(mask, least, none)
        # the label of the label; what lies outside of the mask is its own
        jumped = np.take_along_axis(np.concatenate([least, np.full((n, 1), none)], axis=1), least, axis=1)
        jumped = np.where(mask & np.take_along_axis(held, least, axis=1), jumped, least)
        if (jumped == labels).all():
            return np.where(mask, labels, -1)
        labels = jumped


def image_masks(images: DataFrame, x0: float, y0: float) -> DataFrame:
    def work(a: dict[str, np.ndarray], width: int) -> dict[str, np.ndarray]:
        return mask_statistics(a["flag"], a["template"], masks(a["value"], a["variance"], a["flag"], a["template"], width, x0, y0))

    return over_images(images, {"value": float, "variance": float, "flag": np.int64, "template": float}, work, STATISTICS)


def backgrounds(images: DataFrame, x0: float, y0: float, middle: tuple[float, float], method: str) -> DataFrame:
    """PLANE or CONSTANT of each image: ``plane`` through its background mask, ``calm`` through all sound pixels outside of the target that aren't bright, or the ``constant`` of all pixels fit for use."""

    def work(a: dict[str, np.ndarray], width: int) -> dict[str, np.ndarray]:
        m = masks(a["value"], a["variance"], a["flag"], a["template"], width, x0, y0)
        if method == "constant":
            return constant(a["value"], m["fit"])
        mask = m["background"] if method == "plane" else calm(np.nan_to_num(a["value"]), m["fit"] & ~m["protected"])
        return plane(a["value"], a["variance"], mask, width, *middle)

    return over_images(images, {"value": float, "variance": float, "flag": np.int64, "template": float}, work, CONSTANT if method == "constant" else PLANE)


def bright_areas(images: DataFrame, threshold: float) -> DataFrame:
    """``image_id, y, x, value, variance, component``: pixels above a threshold, each with the first pixel of its area."""

    def work(a: dict[str, np.ndarray], width: int) -> dict[str, np.ndarray]:
        with np.errstate(invalid="ignore"):
            return {"component": label(a["value"] > threshold, width), "value": a["value"], "variance": a["variance"], "width": np.full(len(a["value"]), width)}

    found = over_images(images, {"value": float, "variance": float}, work, "component array<bigint>, value array<double>, variance array<double>, width bigint")
    flat = found.select("image_id", "width", F.posexplode(F.arrays_zip("component", "value", "variance")).alias("i", "p")).filter("p.component >= 0")
    at = {"y": F.floor(F.col("i") / F.col("width")).cast("int"), "x": (F.col("i") % F.col("width")).cast("int")}
    return flat.select("image_id", *(c.alias(k) for k, c in at.items()), "p.value", "p.variance", F.col("p.component").cast("int").alias("component"))


def connected_pixels(members: DataFrame, width: int) -> DataFrame:
    """``image_id, y, x, component`` of distinct pixel rows ``image_id, y, x``: every image's places are brought together once."""
    per = members.groupBy("image_id").agg(F.collect_list((F.col("y") * width + F.col("x")).cast("int")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places, n = batch.column("at").flatten().to_numpy(), batch.column("at").value_lengths().to_numpy()
            image = np.repeat(np.arange(batch.num_rows), n)
            mask = np.zeros((batch.num_rows, (int(places.max()) // width + 1) * width), bool)
            mask[image, places] = True
            found = label(mask, width)[image, places]
            yield pa.RecordBatch.from_pydict({"image_id": batch.column("image_id").take(pa.array(image)), "y": pa.array(places // width, pa.int32()), "x": pa.array(places % width, pa.int32()), "component": pa.array(found, pa.int32())})

    return per.mapInArrow(run, f"image_id {members.schema['image_id'].dataType.simpleString()}, y int, x int, component int")
