"""Header cards, units and detector maps on small made-up files."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import headers as h
from skyloom.operators import units as u


def one(spark, expr, **cols):
    names = {"m": "map<string,string>", "n": "map<string,string>", "p": "map<string,string>", "i": "map<string,string>", "s": "array<int>"}
    schema = ", ".join(f"{k} {names.get(k, 'array<double>')}" for k in cols) or "x int"
    df = spark.createDataFrame([tuple(cols.values()) or (1,)], schema)
    return df.select(expr.alias("r")).first().r


def test_spatial_cards(spark):
    cards = {"NAXIS": "3", "WCSAXES": "3", "CTYPE1": "RA---TAN-SIP", "CTYPE1A": "X", "CRPIX2W": "1", "A_ORDER": "2", "A_0_2": "1e-5", "AP_1_1": "0", "CD1_1": "1", "CD3_3": "1", "PV1_2": "0", "PV3_1": "0", "EXPTIME": "5", "BAND": "1", "PCA": "1"}
    got = one(spark, h.spatial_cards("m"), m=cards)
    assert got == {"CTYPE1": "RA---TAN-SIP", "A_ORDER": "2", "A_0_2": "1e-5", "AP_1_1": "0", "CD1_1": "1", "PV1_2": "0", "NAXIS": "2", "WCSAXES": "2"}
    assert one(spark, h.dropped_cards("m"), m=cards) == ["CRPIX2W", "CTYPE1A", "PCA"]
    assert one(spark, h.spatial_cards("m"), m={}) == {"WCSAXES": "2"}


@pytest.mark.parametrize(("primary", "image", "want"), [({"VERSION": "6.5.5"}, {}, True), ({"VERSION": "6.5.6"}, {}, False), ({}, {"VERSION": "l2b-v6.4"}, True), ({}, {"PROCVER": "6.5.5-psffix1"}, False), ({}, {}, False), ({"VERSION": "x"}, {}, False), ({"VERSION": ""}, {"PROCVER": "5.9.9"}, True), ({"VERSION": "10.1"}, {}, False)])
def test_versions_that_need_mending(spark, primary, image, want):
    assert one(spark, h.needs_mending("p", "i"), p=primary, i=image) is want


def test_centres(spark):
    cards = {"XCTR_1": "10", "YCTR_1": "20", "XCTR2": "30", "YCTR02": "20", "XCTR03": "10", "YCTR3": "40", "XCTR_4": "30", "YCTR_4": "40"}
    notes = {"XCTR_1": "centre (0, 0)", "XCTR2": "(0,1)", "XCTR03": "(1 , 0)", "XCTR_4": "(1,1)"}
    direct = [(10, 20), (30, 20), (10, 40), (30, 40)]
    df = spark.createDataFrame([(cards, notes, {"VERSION": "6.5.5"}, {}, 4), (cards, notes, {"VERSION": "7.0"}, {}, 4), (cards, notes, {}, {}, 5), (cards, {}, {"VERSION": "6.0"}, {}, 4)], "m map<string,string>, n map<string,string>, p map<string,string>, i map<string,string>, planes int")
    c = h.psf_centres("m", "n", "p", "i", F.col("planes"))
    got = df.select(c["centres"].alias("c"), c["warning"].alias("w")).collect()
    assert [(x.x, x.y) for x in got[1].c] == direct and got[1].w is None
    # by its comments the second value stands in the next row of the grid
    assert [(x.x, x.y) for x in got[0].c] == [(30, 40), (30, 40), (30, 40), (30, 40)]
    assert got[0].w == "PSF_HEADER_CORRECTION_APPLIED"
    assert got[2].c == [] and got[2].w == "PSF_CENTER_COUNT_MISMATCH:4/5"
    assert [(x.x, x.y) for x in got[3].c] == direct and got[3].w is None


def test_oversampling_and_metadata(spark):
    assert [one(spark, h.oversampling("m", 4), m=m) for m in ({"OVERSAMP": "10.4"}, {"OVERSAMP": "0"}, {"OVERSAMP": "x"}, {})] == [10, 1, 4, 4]
    hdus = spark.createDataFrame([("f", 0, "PRIMARY", {"VERSION": "1", "X": "2"}), ("f", 1, "IMAGE", {"BAND": "3"}), ("f", 2, "FLAGS", {"BAND": "9"}), ("f", 3, "IMAGE", {"BAND": "8"})], "path string, hdu int, name string, cards map<string,string>")
    assert h.metadata(hdus).first().metadata == {"primary.VERSION": "1", "image.BAND": "3"}
    assert one(spark, h.metadata_value("m", "n", ["a", "b"]), m={"b": "1"}, n={"a": "2"}) == "2"
    p = h.psf_metadata("m", "s")
    df = spark.createDataFrame([({"XCTR_1": "1", "YCTR_1": "1"}, [2, 5, 5])], "m map<string,string>, s array<int>").select(*(c.alias(k) for k, c in p.items())).first()
    assert (df.planes, df.n_x, df.n_y, df.issue) == (2, 1, 1, True) and len(df.header_sha256) == 64


def test_coordinate_checks(spark):
    good = {"CTYPE1": "RA---TAN", "CTYPE2": "DEC--TAN", "CRVAL1": "10", "CRVAL2": "-5", "CRPIX1": "3", "CRPIX2": "3", "CD2_2": "1e-3"}
    status = lambda **k: one(spark, h.spatial_status("m", "s"), m={a: b for a, b in (good | k).items() if b is not None}, s=[5, 5])
    assert status() == "passed" and status(CTYPE1="WAVE") == "not_celestial" and status(CRVAL2=None) == "incomplete" and status(CD2_2="0") == "incomplete" and status(CRVAL1="x") == "incomplete"
    rows = [("a", "WCS-WAVE", "BINTABLE", {"NAXIS2": "1", "TFIELDS": "3"}), ("b", "IMAGE", "IMAGE", {}), ("c", "WCS-WAVE", "IMAGE", {}), ("d", "WCS-WAVE", "BINTABLE", {"NAXIS2": "0"})]
    got = h.spectral_status(spark.createDataFrame(rows, "path string, name string, kind string, cards map<string,string>")).collect()
    assert {r.path: r.status for r in got} == {"a": "passed", "b": "missing", "c": "no_table", "d": "empty"}


def test_units(spark):
    omega = [37.0, 38.0]
    sr = [x / 206265.0**2 for x in omega]
    assert one(spark, u.to_steradian(F.col("a")), a=omega) == pytest.approx(sr)
    assert one(spark, u.to_steradian(F.col("a")), a=[float("nan"), -1.0]) is None and one(spark, u.to_steradian(F.col("a")), a=[]) is None
    assert one(spark, u.to_microjansky(F.col("a"), F.col("b")), a=[2.0, 3.0], b=sr) == pytest.approx([2 * sr[0] * 1e12, 3 * sr[1] * 1e12])
    assert one(spark, u.variance_to_microjansky(F.col("a"), F.col("b")), a=[2.0, 3.0], b=sr) == pytest.approx([2 * (sr[0] * 1e12) ** 2, 3 * (sr[1] * 1e12) ** 2])


def test_sampling_and_wavelengths(spark):
    rng = np.random.default_rng(1)
    wave, band = rng.uniform(1, 5, (4, 6)), rng.uniform(0.01, 0.1, (4, 6))
    x, y = rng.uniform(-1, 7, 9), rng.uniform(-1, 5, 9)
    want = wave[np.clip(np.rint(y).astype(int), 0, 3), np.clip(np.rint(x).astype(int), 0, 5)]
    flat = lambda a: a.ravel().tolist()
    assert one(spark, u.sample(F.col("a"), F.col("b"), F.col("c"), 6, 4), a=flat(wave), b=flat(x), c=flat(y)) == pytest.approx(flat(want))
    yy, xx = np.indices((4, 6), dtype=float)
    assert one(spark, u.same_grid(F.col("a"), F.col("b"), 6, 4), a=flat(xx), b=flat(yy)) and not one(spark, u.same_grid(F.col("a"), F.col("b"), 6, 4), a=flat(xx + 0.1), b=flat(yy))
    weights = rng.uniform(0, 1, (4, 6))
    weights[0, 0], wave[1, 1] = np.nan, np.nan
    df = spark.createDataFrame([(flat(wave), flat(band), flat(weights)), (flat(wave), flat(band), [0.0] * 24)], "w array<double>, b array<double>, r array<double>")
    got = df.select(*(c.alias(k) for k, c in u.wavelength(F.col("w"), F.col("b"), F.col("r"), 6, 4).items())).collect()
    good = np.isfinite(weights) & np.isfinite(wave) & (weights > 0)
    assert got[0].wavelength_um == pytest.approx((weights * wave)[good].sum() / weights[good].sum()) and got[0].bandwidth_um == pytest.approx((weights * band)[good].sum() / weights[good].sum())
    top = np.unravel_index(np.nanargmax(weights), weights.shape)
    assert got[0].method.endswith("weighted") and (math.isnan(wave[top]) or got[0].wavelength_center_um == wave[top])
    assert got[1].method == "spectral_wcs_center" and got[1].wavelength_um == wave[2, 3]


def test_maps_of_calibration_files(spark):
    rows = [
        ("good", 0, "PRIMARY", [], {}, None), ("good", 1, "CWAVE", [1, 2], {}, [1.0, 2.0]), ("good", 2, "CBAND", [1, 2], {}, [0.1, 0.2]), ("odd", 1, "CWAVE", [1, 2], {}, [1.0, 2.0]), ("odd", 2, "CBAND", [2, 1], {}, [0.1, 0.2]),
        ("nan", 1, "CWAVE", [1, 1], {}, [float("nan")]), ("nan", 2, "CBAND", [1, 1], {}, [1.0]), ("low", 1, "CWAVE", [1, 1], {}, [-1.0]), ("low", 2, "CBAND", [1, 1], {}, [1.0]), ("none", 0, "PRIMARY", [], {}, None), ("bad", None, None, [], {"ERROR": "the header has no end"}, None),
    ]
    maps = u.detector_maps(spark.createDataFrame(rows, "path string, hdu int, name string, shape array<int>, cards map<string,string>, data array<double>"))
    spectral = {r.path: (r.status, r.reason) for r in u.map_status(maps, "spectral_wcs").collect()}
    assert spectral["good"] == ("valid", None) and {spectral[k][0] for k in ("odd", "nan", "low", "none", "bad")} == {"failed"} and spectral["bad"][1] == "the header has no end"
    angle = {r.path: r.status for r in u.map_status(maps, "solid_angle_pixel_map").collect()}
    assert angle == {"good": "valid", "odd": "valid", "nan": "failed", "low": "failed", "none": "failed", "bad": "failed"}


def test_flags_and_codes(spark):
    df = spark.createDataFrame([(True, ["PSF_CENTER_COUNT_MISMATCH:1/2"], 1, 0.2, 0.9)], "t boolean, w array<string>, n int, c double, s double")
    assert df.select(u.template_flags(F.col("t"), F.col("w"))).first()[0] == [u.PSF_TRUNCATED, u.PSF_UNCERTAIN]
    assert df.select(u.mask_flags(F.col("n"), F.col("c"), F.col("s"), 0.5)).first()[0] == [u.SEVERE_FLAG, u.CORE_MASKED]
    m = spark.createDataFrame([([True, True, True, False], [False, True, True, False], [False, False, True, False])], "fit_mask array<boolean>, fit_exclude array<boolean>, neighbour array<boolean>")
    assert m.select(u.mask_map({c: F.col(c) for c in m.columns})).first()[0] == [1, 8, 4, 0]
    assert all(math.isnan(x) for x in df.select(*(c.alias(k) for k, c in u.invalid_central_metrics().items())).first())
