"""Synthetic images with known background, target and neighbour."""

import math

import numpy as np
import pytest

from skyloom.operators import background, measure, pixels

SIZE, X0, Y0 = 25, 12.2, 11.9
SCHEMA = "image_id bigint, y int, x int, value double, variance double, flag bigint, template double"


def bump(x0, y0, sigma=1.2):
    y, x = np.indices((SIZE, SIZE))
    b = np.exp(-0.5 * (((x - x0) / sigma) ** 2 + ((y - y0) / sigma) ** 2))
    return b / b.sum()


def rows(image_id, image, variance=0.04, flags=None):
    t = bump(X0, Y0)
    flags = np.zeros((SIZE, SIZE), int) if flags is None else flags
    return [(image_id, y, x, float(image[y, x]), float(variance), int(flags[y, x]), float(t[y, x])) for y in range(SIZE) for x in range(SIZE)]


def plane(a=10.0, b=0.2, c=-0.1):
    y, x = np.indices((SIZE, SIZE))
    return a + b * (x - X0) + c * (y - Y0)


@pytest.fixture(scope="module")
def results(spark):
    noise = np.random.default_rng(7).normal(0, 0.2, (SIZE, SIZE))
    images = {
        1: plane() + 100 * bump(X0, Y0) + noise, 2: plane() - 40 * bump(X0, Y0) + noise, 3: plane() + noise, 4: plane() + 100 * bump(X0, Y0) + 300 * bump(18.0, 12.0) + noise,
        5: plane() + 100 * bump(X0, Y0) + noise, 6: plane() + 100 * bump(X0, Y0) + 300 * bump(18.0, 12.0) + noise,
    }
    flags = {5: np.full((SIZE, SIZE), 1 << pixels.FLAG_BITS["HOT"]), 6: np.full((SIZE, SIZE), 1 << pixels.FLAG_BITS["SOURCE"])}
    data = [r for k, v in images.items() for r in rows(k, v, flags=flags.get(k))]
    return {r.image_id: r for r in measure.measure(spark.createDataFrame(data, SCHEMA), X0, Y0, SIZE).collect()}


def test_flux_of_alone_negative_and_absent_targets(results):
    assert abs(results[1].flux - 100) < 4 * results[1].flux_err and results[1].status == "detected" and results[1].deblending == "none"
    assert results[2].flux < 0 and abs(results[2].flux + 40) < 4 * results[2].flux_err and results[2].status == "negative_flux"
    assert results[3].status in ("non_detection", "negative_flux") and math.isclose(results[3].upper_limit, 3 * results[3].flux_err)
    assert 0.6 < results[1].chi2_reduced < 1.5


def test_neighbour_is_fitted_along(results):
    assert results[4].n_neighbours == 1 and results[4].deblending == "joint_stable"
    assert abs(results[4].flux - 100) < 5 * results[4].flux_err


def test_background_fails_closed(results):
    assert results[5].flux is None and results[5].status == "invalid_background"


def test_background_falls_back_to_calm_pixels(results):
    assert results[6].deblending == "joint_stable" and abs(results[6].flux - 100) < 5 * results[6].flux_err


def test_plane_is_recovered_exactly(spark):
    image = plane()
    df = spark.createDataFrame(rows(1, image), SCHEMA)
    got = background.clipped_plane(pixels.with_masks(df, X0, Y0), "background", X0, Y0).first()
    assert got.ok and abs(got.b0 - 10) < 1e-8 and abs(got.bx - 0.2) < 1e-8 and abs(got.by + 0.1) < 1e-8


def test_bits_and_names(spark):
    assert pixels.bit_value(["HOT", 1]) == 1025
    with pytest.raises(ValueError):
        pixels.bit_value(["NO_SUCH_BIT"])
    from pyspark.sql import functions as F

    assert spark.range(1).select(pixels.flag_names(F.lit((1 << 21) + 1)).alias("n")).first().n == ["TRANSIENT", "SOURCE"]
