"""Locations near other locations, or inside regions: codes along a space-filling curve, discs as ranges of codes, a join
of the ranges with the sorted codes, an exact test.

Every point has one code of the finest level. Every disc, and the disc around every region, is covered by a few ranges
of codes. Coarse cells, which are prefixes of codes, share the work out; within a task ranges and points are sorted by
code and merged in one sweep, so a range meets the points between its ends and no others. A coarse cell that holds too
much is split: its points into parts and its ranges into parts, each part of the one meeting each of the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions import cells
from skyloom.session import cut_lineage, maybe_broadcast

FINER = 1  # levels below the one as wide as a disc: the cover of a disc has at most some 4 x 4 cells of a face
BUCKET_LEVEL = 8  # cells of about a third of a degree, 393,216 of them; coarser for larger discs
PAIRS = 500_000  # tested at a time
SWEEP = "salt bigint, code bigint, is_point boolean, hi bigint, loc string, ra double, dec double, radius double, corners array<double>, both boolean"


def positions(df: DataFrame) -> DataFrame:
    """Distinct usable ``loc, ra, dec``; null and not finite positions are none, repeated ones count once."""
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < F.lit(1e6)) for c in ("ra", "dec")]
    return df.select("loc", F.col("ra").cast("double").alias("ra"), F.col("dec").cast("double").alias("dec")).filter(F.col("loc").isNotNull() & finite[0] & finite[1]).distinct()


def regions(df: DataFrame) -> DataFrame:
    """Distinct ``loc, ra, dec, radius, corners`` of ``loc, region``: a circle, or a polygon with the circle around it.

    Texts are ``CIRCLE [frame] ra dec radius`` and ``POLYGON [frame] ra dec ra dec ...`` in degrees, the radius below
    35. A text that is none of these, or has other than finite numbers, is no region.
    """
    number = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
    shape = r"^(CIRCLE|POLYGON)(\s+[A-Z][A-Z0-9]*)?"
    text = df.select("loc", F.upper(F.trim("region")).alias("region")).filter(F.col("loc").isNotNull() & F.col("region").rlike(rf"{shape}(\s+{number})+$"))
    n = F.transform(F.regexp_extract_all(F.regexp_replace("region", shape, ""), F.lit(f"({number})"), F.lit(1)), lambda x: x.cast("double"))
    # distinct numbers before they are used again and again
    parsed = text.select("loc", F.col("region").startswith("CIRCLE").alias("is_circle"), n.alias("n")).distinct()
    circles = parsed.filter("is_circle and size(n) = 3 and get(n, 2) >= 0").select("loc", F.get("n", F.lit(0)).alias("ra"), F.get("n", F.lit(1)).alias("dec"), F.get("n", F.lit(2)).alias("radius"), F.lit(None).cast("array<double>").alias("corners"))
    polygons = parsed.filter("not is_circle and size(n) >= 6 and size(n) % 2 = 0").select("loc", F.col("n").alias("corners")).mapInArrow(_circles_around, "loc string, ra double, dec double, radius double, corners array<double>")
    return circles.unionByName(polygons).filter("radius < 35")


def _circles_around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        corners = b.column("corners")
        flat, at = corners.flatten().to_numpy(), (corners.offsets.to_numpy() - corners.offsets[0].as_py()) // 2
        ra, dec = np.radians(flat[::2]), np.radians(flat[1::2])
        x, y, z = (np.add.reduceat(v, at[:-1]) for v in (np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)))
        ra0, dec0 = np.degrees(np.arctan2(y, x)), np.degrees(np.arctan2(z, np.hypot(x, y)))
        owner = np.repeat(np.arange(b.num_rows), np.diff(at))
        reach = np.maximum.reduceat(_distance(ra0[owner], dec0[owner], flat[::2], flat[1::2]), at[:-1]) * (1 + 1e-9)
        yield pa.RecordBatch.from_pydict({"loc": b.column("loc"), "ra": pa.array(ra0), "dec": pa.array(dec0), "radius": pa.array(reach), "corners": corners})


def _distance(ra1: np.ndarray, dec1: np.ndarray, ra2: np.ndarray, dec2: np.ndarray) -> np.ndarray:
    d1, d2 = np.radians(dec1), np.radians(dec2)
    h = np.sin((d2 - d1) / 2) ** 2 + np.cos(d1) * np.cos(d2) * np.sin(np.radians(ra2 - ra1) / 2) ** 2
    return np.degrees(2 * np.arcsin(np.minimum(1.0, np.sqrt(h))))


def _plane(ra: np.ndarray, dec: np.ndarray, ra0: np.ndarray, dec0: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places on the plane that touches the sphere at (ra0, dec0), where great circles are straight lines; the third is above 0 on the near half."""
    a, d, d0 = np.radians(ra - ra0), np.radians(dec), np.radians(dec0)
    ahead = np.sin(d0) * np.sin(d) + np.cos(d0) * np.cos(d) * np.cos(a)
    with np.errstate(all="ignore"):
        return np.cos(d) * np.sin(a) / ahead, (np.cos(d0) * np.sin(d) - np.sin(d0) * np.cos(d) * np.cos(a)) / ahead, ahead


def in_polygons(ra: np.ndarray, dec: np.ndarray, corners: pa.ListArray, which: np.ndarray, ra0: np.ndarray, dec0: np.ndarray) -> np.ndarray:
    """Whether each point lies inside the polygon ``which`` it is asked about; sides are great circles.

    ``corners`` holds ra, dec, ra, dec ... of each polygon and ``ra0, dec0`` its middle. A point is inside if a ray from it crosses the sides an odd number of times.
    """
    flat, at = corners.flatten().to_numpy(), corners.offsets.to_numpy() - corners.offsets[0].as_py()
    n = np.diff(at) // 2
    x, y, ahead = _plane(ra, dec, ra0[which], dec0[which])
    owner = np.repeat(np.arange(len(n)), n)
    cx, cy, _ = _plane(flat[::2], flat[1::2], ra0[owner], dec0[owner])
    first, size = (at[:-1] // 2)[which], n[which]
    inside = np.zeros(len(ra), bool)
    for k in range(int(n.max(initial=0))):
        has = k < size
        i, j = first + np.where(has, k, 0), first + np.where(has, (k + 1) % np.maximum(size, 1), 0)
        with np.errstate(all="ignore"):
            crosses = has & ((cy[i] > y) != (cy[j] > y)) & (x < (cx[j] - cx[i]) * (y - cy[i]) / (cy[j] - cy[i]) + cx[i])
        inside ^= crosses
    return inside & (ahead > 0)


def _pairs(ranges: pa.Table, points: pa.Table) -> Iterator[pa.RecordBatch]:
    """The pairs that pass the exact test, of ranges and points of one part, points sorted by code."""
    codes, n = points["code"].to_numpy(), ranges.num_rows
    low = np.searchsorted(codes, ranges["code"].to_numpy(), "left")
    high = np.searchsorted(codes, ranges["hi"].to_numpy(), "right")
    met = np.maximum(high - low, 0)
    r_ra, r_dec, reach = (ranges[k].to_numpy() for k in ("ra", "dec", "radius"))
    p_ra, p_dec = points["ra"].to_numpy(), points["dec"].to_numpy()
    shaped = ranges["corners"].is_valid().to_numpy()
    before = np.append(0, np.cumsum(met))
    for a in range(0, int(before[-1]), PAIRS):
        flat = np.arange(a, min(a + PAIRS, int(before[-1])))
        r = np.searchsorted(before, flat, "right") - 1
        p = low[r] + flat - before[r]
        ok = _distance(r_ra[r], r_dec[r], p_ra[p], p_dec[p]) <= reach[r]
        r, p = r[ok], p[ok]
        if shaped.any() and len(r):
            mine = np.flatnonzero(shaped[r])
            used, which = np.unique(r[mine], return_inverse=True)
            corners = ranges["corners"].combine_chunks().take(pa.array(used))
            inside = np.ones(len(r), bool)
            inside[mine] = in_polygons(p_ra[p[mine]], p_dec[p[mine]], corners, which, r_ra[used], r_dec[used])
            r, p = r[inside], p[inside]
        if not len(r):
            continue
        one, other, twice = ranges["loc"].take(pa.array(r)), points["loc"].take(pa.array(p)), points["both"].take(pa.array(p))
        # two discs meet each other twice; one of the two is enough
        keep = pc.and_(pc.not_equal(one, other), pc.or_(pc.invert(twice), pc.less(one, other)))
        out = pa.table({"disc": one, "point": other}).filter(keep).combine_chunks()
        yield from out.to_batches()


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge ranges and points that come sorted by salt, code, ranges first; ranges stay open until a code beyond their end."""
    open_, salt = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        salts = t["salt"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(salts)) + 1).tolist(), len(salts)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = t.slice(a, b - a)
            new = part.filter(pc.invert(part["is_point"]))
            if open_ is None or salts[a] != salt:
                open_, salt = new, salts[a]
            else:
                open_ = pa.concat_tables([open_, new])
            open_ = open_.combine_chunks()
            points = part.filter(part["is_point"]).combine_chunks()
            if points.num_rows and open_.num_rows:
                yield from _pairs(open_, points)
            open_ = open_.filter(pc.greater_equal(open_["hi"], part["code"][-1]))


def _range_join(discs: DataFrame, points: DataFrame, bucket_level: int, rows_per_task: int) -> DataFrame:
    """``disc, point`` of every disc and point that pass the exact test; a pair may come several times."""
    held = points.select("bucket", F.lit(1).alias("p"), F.lit(0).alias("r")).unionByName(discs.select("bucket", F.lit(0).alias("p"), F.lit(1).alias("r"))).groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("r").alias("r"))
    parts = lambda c: F.ceil(F.col(c) / rows_per_task).cast("int")
    # at most one for every rows_per_task rows
    crowded = maybe_broadcast(held.filter((F.col("p") > rows_per_task) | (F.col("r") > rows_per_task)).select("bucket", F.greatest(parts("p"), F.lit(1)).alias("p_parts"), F.greatest(parts("r"), F.lit(1)).alias("r_parts")))

    def split(df: DataFrame, mine: str, other: str) -> DataFrame:
        df = df.join(crowded, "bucket", "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("p_parts", "r_parts")})
        own = F.pmod(F.xxhash64("loc", "ra", "dec"), F.col(f"{mine}_parts")).cast("bigint")
        df = df.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}_parts").cast("bigint") - 1)))
        number = F.col("own") * F.col("r_parts") + F.col("met") if mine == "p" else F.col("met") * F.col("r_parts") + F.col("own")
        return df.withColumn("salt", number)

    cols = ["bucket", *(c.split()[0] for c in SWEEP.split(", "))]
    left = split(discs, "r", "p").withColumns({"is_point": F.lit(False), "both": F.lit(False)}).select(*cols)
    right = split(points, "p", "r").withColumns({"is_point": F.lit(True), "hi": F.lit(None).cast("bigint"), "radius": F.lit(None).cast("double"), "corners": F.lit(None).cast("array<double>")}).select(*cols)
    rows = left.unionByName(right).repartition("bucket", "salt").sortWithinPartitions("salt", "code", "is_point").drop("bucket")
    return rows.mapInArrow(sweep, "disc string, point string")


def _coded(df: DataFrame, bucket_level: int) -> DataFrame:
    df = df.withColumn("code", cells.point_cell(cells.unit_vector(F.col("ra"), F.col("dec"))))
    return df.withColumn("bucket", cells.bucket_of(F.col("code"), bucket_level))


def _covered(discs: DataFrame, bucket_level: int) -> DataFrame:
    """Discs of ``loc, ra, dec, radius, corners`` as a row for every range of codes."""
    level = F.greatest(F.lit(bucket_level), F.least(F.lit(cells.FINEST), cells.level_of(F.col("radius")) + FINER))
    met = discs.withColumn("level", level).withColumn("cells", cells.disc_cells(cells.unit_vector(F.col("ra"), F.col("dec")), F.col("radius"), F.col("level")))
    ranges = met.select("loc", "ra", "dec", "radius", "corners", F.explode(cells.code_ranges(F.col("cells"), F.col("level"), bucket_level)).alias("x"))
    return ranges.select("loc", "ra", "dec", "radius", "corners", F.col("x.lo").alias("code"), F.col("x.hi").alias("hi"), cells.bucket_of(F.col("x.lo"), bucket_level).alias("bucket"))


def near_pairs(left: DataFrame, right: DataFrame, radius_deg: float, rows_per_task: int = 200_000) -> DataFrame:
    """Distinct ``loc_a, loc_b`` (the smaller string first): two left locations, or a left and a right one, with a position of each at most ``radius_deg`` apart.

    Both sides are ``loc, ra, dec`` as from positions(); a location is never paired with itself, two right ones never
    with each other. Empty sides give an empty result. ``rows_per_task`` is the size above which a coarse cell is split.
    """
    bucket_level = min(BUCKET_LEVEL, cells.level_for(radius_deg))
    # each side is read and given codes once; the count of crowded cells and the join go on from there
    left = cut_lineage(_coded(left, bucket_level))
    points = left.withColumn("both", F.lit(True)).unionByName(cut_lineage(_coded(right, bucket_level)).withColumn("both", F.lit(False)))
    discs = _covered(left.select("loc", "ra", "dec", F.lit(float(radius_deg)).alias("radius"), F.lit(None).cast("array<double>").alias("corners")), bucket_level)
    hits = _range_join(discs, points, bucket_level, rows_per_task)
    return hits.select(F.least("disc", "point").alias("loc_a"), F.greatest("disc", "point").alias("loc_b")).distinct()


def containing_regions(points: DataFrame, areas: DataFrame, rows_per_task: int = 200_000) -> DataFrame:
    """Distinct ``loc, region_loc`` of points and the regions that hold them, borders of circles included.

    ``points`` is ``loc, ra, dec`` as from positions(), ``areas`` as from regions(). Regions of any sizes may be mixed.
    """
    areas = cut_lineage(areas)
    largest = areas.agg(F.max("radius").alias("r")).first().r
    bucket_level = min(BUCKET_LEVEL, cells.level_for(largest or 0.0))
    points = cut_lineage(_coded(points, bucket_level)).withColumn("both", F.lit(False))
    return _range_join(_covered(areas, bucket_level), points, bucket_level, rows_per_task).select(F.col("point").alias("loc"), F.col("disc").alias("region_loc")).distinct()
