import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skyloom.functions import cells
from skyloom.operators.skyjoin import containing_regions, in_polygons, near_pairs, positions, regions


def separation(a, b):
    r1, d1, r2, d2 = map(math.radians, (*a, *b))
    h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((r2 - r1) / 2) ** 2
    return math.degrees(2 * math.asin(min(1, math.sqrt(h))))


def brute(left, right, r):
    return {tuple(sorted((a, b))) for a, ra, da in left for b, rb, db in right if a != b and None not in (ra, da, rb, db) and separation((ra, da), (rb, db)) <= r}


def frame(spark, rows):
    return positions(spark.createDataFrame(rows, "loc string, ra double, dec double"))


def pairs(spark, left, right, r, **k):
    return {tuple(x) for x in near_pairs(frame(spark, left), frame(spark, right), r, **k).collect()}


def clustered(rng, n, r, name):
    """Points near each other at poles, at RA 0, at corners and edges of the cube, and anywhere."""
    corner = math.degrees(math.asin(1 / math.sqrt(3)))
    centres = [(0, 90), (123, -90), (0, 0), (359.9999, 10), (45, corner), (135, -corner), (45, 0), (45, 20), (0, 45), (300, -60), (225, -corner)]
    out = []
    for i in range(n):
        ra, dec = map(float, rng.choice(centres))
        dec = max(-90.0, min(90.0, dec + rng.uniform(-3, 3) * r))
        ra = ra + rng.uniform(-3, 3) * r / max(math.cos(math.radians(dec)), 1e-3) if abs(dec) < 89 else rng.uniform(-180, 540)
        out.append((f"{name}{i}", ra, dec))
    return out


def test_against_brute_force_at_hard_places(spark):
    rng = random.Random(5)
    for r in (3 / 3600, 0.5, 7.0):
        left, right = clustered(rng, 150, r, "a"), clustered(rng, 200, r, "b")
        assert pairs(spark, left, right, r) == brute(left, left + right, r)


def test_nulls_repeats_not_a_number_and_empty(spark):
    left = [("s1", 10.0, 0.0), ("s1", 10.0, 0.0), ("s2", None, 0.0), ("s3", 370.0, 0.0), ("s4", float("nan"), 0.0), (None, 10.0, 0.0)]
    assert pairs(spark, left, [], 0.001) == {("s1", "s3")}
    assert pairs(spark, [], left, 0.001) == set()


def test_cells_of_discs_hold_their_points(spark):
    rng = random.Random(8)
    rows = clustered(rng, 200, 0.01, "p")
    df = spark.createDataFrame([(n, a, d, a, max(-90.0, min(90.0, d + rng.uniform(-0.01, 0.01)))) for n, a, d in rows], "n string, ra double, dec double, ra2 double, dec2 double")
    level = cells.level_for(0.01)
    cover = cells.disc_cells(cells.unit_vector(F.col("ra"), F.col("dec")), 0.01, level)
    own = cells.point_cell(cells.unit_vector(F.col("ra2"), F.col("dec2")), level)
    got = df.select(F.array_contains(cover, own).alias("hit"), F.size(cover).alias("n")).collect()
    assert all(r.hit for r in got) and max(r.n for r in got) <= 12


def test_a_crowded_place_is_split_and_whole(spark):
    rng = random.Random(3)
    left = [(f"a{i}", 10.0 + rng.uniform(0, 1e-4), 5.0) for i in range(70)] + clustered(rng, 40, 0.01, "c")
    right = [(f"b{i}", 10.0 + rng.uniform(0, 1e-4), 5.0) for i in range(300)]
    want = brute(left, left + right, 5e-5)
    assert pairs(spark, left, right, 5e-5, rows_per_task=25) == pairs(spark, left, right, 5e-5) == want


def test_ranges_join_cells_and_stay_within_buckets(spark):
    rows = clustered(random.Random(4), 100, 0.01, "p")
    df = spark.createDataFrame(rows, "n string, ra double, dec double").withColumn("dec", F.greatest(F.lit(-90.0), F.least(F.lit(90.0), F.col("dec"))))
    level, bucket = cells.level_for(0.01) + 1, 8
    cover = cells.disc_cells(cells.unit_vector(F.col("ra"), F.col("dec")), 0.01, level)
    got = df.select(F.size(cover).alias("n"), cells.code_ranges(cover, level, bucket).alias("r")).collect()
    width = 4 ** (cells.FINEST - level)
    for r in got:
        assert sum((x.hi - x.lo + 1) // width for x in r.r) == r.n
        assert all(x.lo >> 2 * (cells.FINEST - bucket) == x.hi >> 2 * (cells.FINEST - bucket) for x in r.r)
    assert sum(len(r.r) for r in got) < sum(r.n for r in got)


def test_without_the_cover_nothing_is_found(spark, monkeypatch):
    left = [("s1", 10.0, 0.0), ("s2", 10.0, 0.0)]
    assert pairs(spark, left, [], 0.001)
    monkeypatch.setattr(cells, "code_ranges", lambda c, level, b: F.filter(F.array(F.struct(F.lit(0).cast("bigint").alias("lo"), F.lit(0).cast("bigint").alias("hi"))), lambda x: F.lit(False)))
    assert pairs(spark, left, [], 0.001) == set()


def test_regions_of_all_kinds(spark):
    rng = random.Random(6)
    texts = {"c1": "CIRCLE ICRS 10 20 1.75", "c2": " circle 359.9 -89 3 ", "c3": "CIRCLE ICRS 0.1 0 0.5", "p1": "POLYGON ICRS 1 -1 -1 -1 -1 1 1 1", "p2": "POLYGON 40 40 44 40 42 41 44 44 40 44", "p3": "Polygon ICRS 0 88 90 88 180 88 270 88", "bad": "CIRCLE ICRS 10 20", "worse": "BOX 1 2 3 4", "x": "POLYGON 1 2 3 4", "huge": "CIRCLE 1 1 50", "text": "CIRCLE a b c"}
    centres = [(10, 20), (0, -89.5), (0, 0), (42, 42), (0, 89.5)]
    points = []
    for i in range(400):
        ra, dec = rng.choice(centres)
        points.append((f"q{i}", (ra + rng.uniform(-3, 3)) if abs(dec) < 89 else rng.uniform(0, 360), max(-90.0, min(90.0, dec + rng.uniform(-3, 3)))))
    areas = regions(spark.createDataFrame([*texts.items(), (None, "CIRCLE 1 1 1"), ("n", None), ("c1", texts["c1"])], "loc string, region string"))
    assert {r.loc for r in areas.collect()} == {"c1", "c2", "c3", "p1", "p2", "p3"}
    want = set()
    for name in ("c1", "c2", "c3"):
        ra, dec, r = map(float, texts[name].split()[-3:])
        want |= {(q, name) for q, a, d in points if separation((a, d), (ra, dec)) <= r}
    def inside(x, y, corners, ra, dec):
        return in_polygons(np.array(x, float), np.array(y, float), pa.array([corners], pa.list_(pa.float64())), np.zeros(len(x), int), np.array([ra], float), np.array([dec], float))

    for r in areas.filter("corners is not null").collect():
        want |= {(p[0], r.loc) for p, ok in zip(points, inside([p[1] for p in points], [p[2] for p in points], r.corners, r.ra, r.dec), strict=True) if ok}
    assert {tuple(r) for r in containing_regions(frame(spark, points), areas).collect()} == want and len(want) > 100
    hollow = inside([43.5, 41.0], [41.0, 43.0], [40, 40, 44, 40, 42, 41, 44, 44, 40, 44], 42, 42)
    assert hollow.tolist() == [False, True]
