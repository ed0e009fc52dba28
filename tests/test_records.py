"""Upserts, catalogue rows, names, places in an order, and projections on small made-up cases."""

import math
import random

from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.operators import calibration, catalog, components, discovery, ordering, selection, upsert

ROW = "k int, a string, b string, c string"


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_upsert_rules_and_twice_is_once(spark):
    old = spark.createDataFrame([(1, "a1", "b1", "c1"), (2, "a2", "b2", "c2"), (None, "an", "bn", "cn")], ROW)
    new = spark.createDataFrame([(2, "A2", "B2", None), (3, "A3", None, "C3"), (None, "AN", "BN", None)], ROW)
    once = upsert.upsert(old, new, ["k"], preserve=["b"], coalesce=["c"])
    assert rows(once) == {(1, "a1", "b1", "c1"), (2, "A2", "b2", "c2"), (3, "A3", None, "C3"), (None, "AN", "bn", "cn")}
    assert rows(upsert.upsert(once, new, ["k"], preserve=["b"], coalesce=["c"])) == rows(once)
    assert rows(upsert.upsert(old, new.limit(0), ["k"])) == rows(old) and rows(upsert.upsert(old.limit(0), new, ["k"])) == rows(new)


def test_retire_and_counts(spark):
    table = spark.createDataFrame([(1, True, None), (2, True, None), (3, False, "before")], "k int, active boolean, retired string")
    present = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(upsert.retire(table, present, ["k"], "active", "retired", F.lit("now"))) == {(1, True, None), (2, False, "now"), (3, False, "before")}
    old, new = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, h string"), spark.createDataFrame([(1, "x"), (2, "z"), (3, None), (4, "w")], "k int, h string")
    assert rows(upsert.upsert_counts(old, new, ["k"], "h")) == {(1, 1, 2, 0)}
    assert rows(upsert.last_per_key(spark.createDataFrame([(1, "a", "1", "x"), (1, "b", "2", "y"), (2, None, None, None)], ROW), ["k"], ["b"])) == {(1, "b", "2", "y"), (2, None, None, None)}


def test_column_mapping_prefers_exact_names_in_order():
    assert catalog.map_columns(["name", "Name", "ra", "D.E.C", "size_arcsec"]) == {"source_id": "Name", "source_name": "Name", "ra_deg": "ra", "dec_deg": "D.E.C", "cutout_size_arcsec": "size_arcsec"}
    assert catalog.map_columns(["id", "Name", "S.I.D", "sid"])["source_id"] == "Name" and catalog.map_columns(["R.A", "r_a"])["ra_deg"] == "r_a"
    assert catalog.missing_columns(["Name", "ra"]) == ["dec_deg"]
    assert catalog.map_columns([]) == {}


def test_normalized_catalogue(spark):
    df = spark.createDataFrame([(" a  b/c ", "10", "-5", "", "no", "n1"), ("***", "x", "91", "7000", "maybe", None)], "Name string, RA_deg string, DEC_deg string, cutout_size_arcsec string, active string, remark string")
    got = catalog.checked(catalog.normalize(df)).orderBy("source_name").collect()
    bad, good = got[0], got[1]
    assert (good.source_id, good.source_name, good.ra_deg, good.active, good.errors) == ("a_b_c", "a  b/c", 10.0, False, []) and good.extra_json == '{"remark":"n1"}' and len(good.row_hash) == 64
    assert bad.source_id is None and bad.active and bad.errors == ["missing_id", "bad_ra", "bad_dec", "bad_size"]


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(6)
    at = [(rng.choice([0.0, 10.0, 359.95, 180.0]) + rng.uniform(0, 0.3), rng.choice([-90.0, -89.9, 0.0, 44.9, 89.7]) + rng.uniform(0, 0.3)) for _ in range(220)]
    data = [(f"s{i}", ra, min(90.0, dec)) for i, (ra, dec) in enumerate(at)] + [("n", None, 1.0)]
    for tol in (0.02, 0.11):
        want = set()
        for i, (a, ra, da) in enumerate(data[:-1]):
            for b, rb, db in data[i + 1 : -1]:
                if math.hypot((ra - rb) * math.cos(math.radians((da + db) / 2)), da - db) <= tol:
                    want.add(tuple(sorted((a, b))))
        df = spark.createDataFrame(data, "source_id string, ra_deg double, dec_deg double")
        assert {(r.id_a, r.id_b) for r in catalog.near_duplicates(df, tol).collect()} == want


def test_names_and_addresses(spark):
    urls = [("https://h.example/a/b/level2b_2025W19_2B_0073_D3_l2b-v20-2025-247.fits?x=1#f",), ("https://h.example/",), ("",), (None,), ("file.tar.gz",)]
    df = spark.createDataFrame(urls, "u string").withColumn("n", discovery.file_name("u"))
    m = discovery.file_metadata(F.col("n"))
    got = {r.u: r for r in df.select("u", "n", *(m[k].alias(k) for k in m), discovery.stem(F.col("n")).alias("stem")).collect()}
    a = got[urls[0][0]]
    assert (a.detector, a.band, a.period, a.version, a.date, a.observation) == (3, "D3", "2025W19_2B", "l2b-v20-2025-247", "2025-247", "0073")
    assert got["https://h.example/"].n is None and got[""].n is None and got[None].period == "unknown_period" and got["file.tar.gz"].stem == "file.tar"
    texts = [("  a b\t*c ",), ("",), (None,), ("x" * 70,), ("__",)]
    slugs = [r.s for r in spark.createDataFrame(texts, "t string").select(discovery.slug("t").alias("s")).collect()]
    assert slugs[:3] == ["a_b__c", "unknown", "unknown"] and slugs[4] == "unknown" and len(slugs[3]) == 64 and slugs[3].startswith("x" * 55 + "_")
    size = lambda a: spark.range(1).select(discovery.cutout_url(F.lit("http://h/p?q=1"), F.lit(1.5), F.lit(-2.0), F.lit(a)).alias("u")).first().u
    assert size(180.0) == "http://h/p?q=1&center=1.5000000000,-2.0000000000&size=0.05"
    assert size(100.0).endswith("size=0.02777777778") and size(0.0) is None and size(3600.0).endswith("size=1")


def test_places_of_a_hot_group(spark):
    rng = random.Random(1)
    data = [("hot", rng.choice([1.5, 2.5, 0.1, None, 9.0]), i) for i in range(500)] + [("b", 1.0, 500), (None, 2.0, 501), (None, 1.0, 502)]
    w = F.col("w")
    slices = F.when(w.isNull(), 99).otherwise(F.floor(w * 2)).cast("int")
    got = {r.i: r.place for r in ordering.places(spark.createDataFrame(data, "k string, w double, i int"), "k", slices, [w, F.col("i")]).collect()}
    for key in ("hot", "b", None):
        order = sorted((r for r in data if r[0] == key), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        assert [got[r[2]] for r in order] == list(range(len(order)))


def test_projection_there_and_back(spark):
    rng = random.Random(2)
    data = [(rng.uniform(0, 360), rng.uniform(-89, 89)) for _ in range(100)] + [(0.01, 89.9), (359.99, -89.9)]
    df = spark.createDataFrame([(a + rng.uniform(-0.02, 0.02), max(-90.0, min(90.0, d + rng.uniform(-0.02, 0.02))), a, d) for a, d in data], "ra double, dec double, a double, d double")
    x, y = sky.to_pixel(F.col("ra"), F.col("dec"), F.col("a"), F.col("d"), 1 / 3600, 100.0, 100.0)
    ra, dec = sky.to_sky(F.col("x"), F.col("y"), F.col("a"), F.col("d"), 1 / 3600, 100.0, 100.0)
    for r in df.withColumn("x", x).withColumn("y", y).withColumn("ra2", ra).withColumn("dec2", dec).collect():
        assert abs(r.dec2 - r.dec) < 1e-9 and abs((r.ra2 - r.ra + 180) % 360 - 180) * math.cos(math.radians(r.dec)) < 1e-9
    far = df.limit(1).select(sky.to_pixel(F.col("a") + 180, -F.col("d"), F.col("a"), F.col("d"), 1.0, 0.0, 0.0)[0].alias("x")).first()
    assert far.x is None


def test_calibration_ties_and_gaps(spark):
    data = [("r", "t", 1, "b", "p", "2025-01-01"), ("r", "t", 1, "a", "q", "2025-01-01"), ("r", "t", 1, "c", "s", None), ("r", "u", 1, "d", "s", None), ("r", "t", 2, "e", "z", "2024-01-01")]
    df = spark.createDataFrame(data, "release string, calibration_type string, detector_id int, calibration_id string, local_path string, validated_at string")
    best = calibration.best_products(df)
    assert {(r.detector_id, r.calibration_id) for r in best.collect()} == {(1, "a"), (2, "e")}
    need = calibration.required(spark.createDataFrame([(1,), (3,)], "detector_id int"), ["t", "u"], "r")
    assert {tuple(r) for r in calibration.resolve(need, best).select("detector_id", "complete", "calibration_ids", "missing").collect()} == {(1, False, "a;-", "u"), (3, False, "-;-", "t;u")}
    assert calibration.missing(need, best).count() == 3


def test_long_snake_is_one_component(spark):
    snake = [(1, y, x) for y in range(0, 7, 2) for x in range(8)] + [(1, y, 7 if y % 4 == 1 else 0) for y in range(1, 6, 2)] + [(2, 0, 0), (2, 1, 1), (2, 5, 5)]
    got = components.connected_components(spark.createDataFrame(snake, "image_id int, y int, x int"), 8).collect()
    assert {r.component for r in got if r.image_id == 1} == {0} and {r.component for r in got if r.image_id == 2} == {0, 45}


def test_greedy_merge_follows_the_order(spark):
    data = [(1, 5, 0.0, 0.0), (1, 9, 1.5, 0.0), (1, 12, 3.0, 0.0), (2, 1, 9.0, 9.0)]
    got = components.merge_nearby(spark.createDataFrame(data, "image_id int, component int, centroid_x double, centroid_y double"), 2.0)
    assert {(r.image_id, r.component): r.kept for r in got.collect()} == {(1, 5): True, (1, 9): False, (1, 12): True, (2, 1): True}


def test_detection_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    data = [(10.0, 1.0), (-10.0, 1.0), (2.0, 1.0), (nan, 1.0), (1.0, nan), (1.0, inf), (1.0, 0.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(data, "f double, e double").select(selection.detection_status(F.col("f"), F.col("e")).alias("s"), selection.upper_limit(F.col("e")).alias("u"))
    got = df.collect()
    assert [r.s for r in got] == ["detected", "negative_flux", "non_detection"] + ["invalid_fit"] * 6
    assert got[0].u == 3.0 and all(math.isnan(got[i].u) for i in (4, 5, 8))
    flags = spark.range(1).select(selection.flag_list(F.lit("A; B;A;;C")).alias("x"), selection.blocking(selection.flag_list(F.lit("A;B")), ["A"]).alias("y")).first()
    assert flags.x == ["A", "B", "C"] and flags.y == ["B"]
