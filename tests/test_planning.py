"""Readers of the survey's tables on small made-up cases, and projections with distortion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.operators import planning as p


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_sources(spark):
    s = spark.createDataFrame([("a", "A", 1, None), ("b", "A", 1, 5), ("c", "B", 0, 1), ("d", None, None, 1)], "source_id string, source_name string, active int, priority int")
    assert [r.source_id for r in p.active_sources(s, limit=2).collect()] == ["b", "a"]
    assert rows(p.active_sources(s, ["a", "c"]).select("source_id")) == {("a",)}
    assert rows(p.by_id_or_name(s, source_id="c").select("source_id")) == {("c",)} and rows(p.by_id_or_name(s, name="A").select("source_id")) == {("a",), ("b",)} and rows(p.by_id_or_name(s, name="B")) == set()


def test_sizes_out_of_range_are_an_error(spark):
    df = spark.createDataFrame([(None,), (60.0,)], "x double")
    assert {r[0] for r in df.select(p.effective_size("x", 180.0)).collect()} == {180.0, 60.0}
    with pytest.raises(Exception, match="out of range"):
        df.select(p.effective_size(F.lit(5.0), 180.0)).collect()


def test_versions_and_files(spark):
    names = ["cal-wcs-v2-2025-100", "cal-wcs-v10-2025-100", "cal-wcs-v3-2024-300", "nothing"]
    df = spark.createDataFrame([("k", n) for n in names], "g string, name string")
    assert rows(p.latest_versions(df, "name", ["g"])) == {("k", "cal-wcs-v10-2025-100")}
    listing = spark.createDataFrame([("wcs_D1_cal-v1-2025-001.fits", 5), ("wcs_D1_cal-v2-2025-001.fits", 6), ("wcs_D1_cal-v3-2025-001.fits", None), ("wcs_D2_x.txt", 3), ("other_D2_v1.fits", 3), ("wcs_D3_a.FITS", 1)], "name string, size bigint")
    assert rows(p.detector_files(listing, "wcs").select("detector_id", "name")) == {(1, "wcs_D1_cal-v2-2025-001.fits"), (3, "wcs_D3_a.FITS")}
    paths = spark.createDataFrame([("r/cal-wcs-v2-2025_100/f.fits",), ("r/map_v3.1.fits",), ("r/map.fits",)], "x string")
    assert [r[0] for r in paths.select(p.calibration_version("x")).collect()] == ["cal-wcs-v2-2025-100", "v3.1", None]
    sizes = spark.createDataFrame([(5, 5), (5, None), (0, None), (5, 6), (None, 5)], "a bigint, b bigint")
    assert [r[0] for r in sizes.select(p.same_size(F.col("a"), F.col("b"))).collect()] == [True, True, False, False, False]
    assert spark.createDataFrame([("D3, 4,x,",)], "t string").select(p.detector_list(F.col("t"))).first()[0] == [3, 4]


def test_references(spark):
    refs = spark.createDataFrame([("abc",), ("b",), ("",), (None,), ("zzz",)], "reference string")
    held = spark.createDataFrame([("c1", "abc", None), ("c2", "xabcx", "b"), ("c3", None, None)], "calibration_id string, filename string, source_url string")
    assert rows(p.referenced_calibrations(refs, held, ["filename", "source_url"])) == {("abc", "c1"), ("abc", "c2"), ("b", "c1"), ("b", "c2")}
    assert rows(p.referenced_calibrations(refs.limit(0), held, ["filename"])) == set()
    row = spark.createDataFrame([("", "w", "s")], "spectral_wcs_calibration_id string, WCS_CALID string, SOLIDANG string")
    assert tuple(row.select(*p.references(row.columns).values()).first()) == ("w", "s")


def test_upserts_of_matches_calibrations_and_validations(spark):
    old = spark.createDataFrame([("s", 1, "t0", "t1", False)], "source_id string, product_id int, first_seen_at string, last_seen_at string, active boolean")
    found = spark.createDataFrame([("s", 1, "t5"), ("s", 1, "t4"), ("s", 2, "t5")], "source_id string, product_id int, last_seen_at string")
    assert rows(p.upsert_matches(old, found)) == {("s", 1, "t0", "t5", True), ("s", 2, "t5", "t5", True)}
    table = spark.createDataFrame([("c", "u", "v0", False)], "calibration_id string, source_url string, validated_at string, active boolean")
    files = spark.createDataFrame([("c", None, "v1"), ("d", "w", "v1")], "calibration_id string, source_url string, validated_at string")
    assert rows(p.register_calibrations(table, files)) == {("c", "u", "v1", True), ("d", "w", "v1", True)}
    history = spark.createDataFrame([("a", 1, "failed", "bad"), ("a", 2, "passed", "bad"), ("b", 1, "failed", "x")], "cutout string, at int, status string, failure_reason string")
    assert rows(p.validation_states(history, "cutout", ["at"])) == {("a", 2, "passed", None), ("b", 1, "failed", "x")}


def test_fallback_failures_and_runs(spark):
    a, b = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "p")], [(1, "f"), (2, "f")]))
    assert rows(p.with_fallback(a, b, ["k"])) == {(1, "p"), (2, "f")}
    f = spark.createDataFrame([(1, 5, "late"), (1, 2, "first"), (2, 1, "open")], "k int, at int, why string")
    assert rows(p.first_failures(f, spark.createDataFrame([(2,)], "k int"), ["k"], ["at"])) == {(1, 2, "first")}
    m = spark.createDataFrame([("r1", "detected"), ("r2", "x"), (None, "detected")], "photometry_run_id string, detection_status string")
    assert p.of_run(m, F.lit(None).cast("string")).count() == 3 and rows(p.of_run(m, F.lit("r1"))) == {("r1", "detected")} and p.of_run(m, F.lit(None).cast("string"), ["detected"]).count() == 2


def test_projection_with_distortion_goes_back(spark):
    rng = np.random.default_rng(4)
    a, b = {(2, 0): 2e-5, (1, 1): -1e-5}, {(0, 2): 1.5e-5, (2, 1): 1e-8}
    cd, crpix = (-1.7e-3, 2e-5, 3e-5, 1.7e-3), (12.0, 15.0)
    px = rng.uniform(-20, 50, (30, 2))
    u, v = px[:, 0] + 1 - crpix[0], px[:, 1] + 1 - crpix[1]
    f, g = (u + sum(c * u**i * v**j for (i, j), c in t.items()) if k == 0 else v + sum(c * u**i * v**j for (i, j), c in t.items()) for k, t in ((0, a), (1, b)))
    xi, eta = np.radians(cd[0] * f + cd[1] * g), np.radians(cd[2] * f + cd[3] * g)
    ra0, dec0 = np.radians(200.0), np.radians(-35.0)
    below = np.cos(dec0) - eta * np.sin(dec0)
    ra, dec = ra0 + np.arctan2(xi, below), np.arctan2(np.sin(dec0) + eta * np.cos(dec0), np.hypot(xi, below))
    df = spark.createDataFrame([(float(np.degrees(r)), float(np.degrees(d))) for r, d in zip(ra, dec, strict=True)], "ra double, dec double")
    x, y = sky.to_image(F.col("ra"), F.col("dec"), F.lit(200.0), F.lit(-35.0), tuple(map(F.lit, cd)), tuple(map(F.lit, crpix)), a, b)
    got = np.array([tuple(r) for r in df.select(x, y).collect()])
    assert np.abs(got - px).max() < 1e-6
    assert spark.range(1).select(sky.to_image(F.lit(20.0), F.lit(35.0), F.lit(200.0), F.lit(-35.0), tuple(map(F.lit, cd)), tuple(map(F.lit, crpix)), a, b)[0]).first()[0] is None
