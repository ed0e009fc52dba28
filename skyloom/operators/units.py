"""Physical units and detector maps: solid angles, fluxes per pixel, wavelengths of an image, and flags of what was measured.

Images, maps and masks are arrays of numbers in row-major order; each image is a row, so nothing is shuffled for its pixels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A square arcsecond in steradians, and microjanskys in a megajansky.
ARCSEC2_TO_SR = 1 / 206265.0**2
MJY_TO_UJY = 1.0e12
# Flags of templates and masks, and codes of a mask map in the order in which they are painted.
PSF_TRUNCATED, PSF_UNCERTAIN = "PSF_TRUNCATED", "PSF_COORDINATE_UNCERTAIN"
SEVERE_FLAG, CORE_MASKED, LOW_SUPPORT = "SEVERE_IMAGE_FLAG", "TARGET_CORE_MASKED", "LOW_TEMPLATE_SUPPORT"
PAINTED = (("fit_mask", 1), ("background_mask", 2), ("target_mask", 3), ("flagged", 5), ("fallback_mask", 6), ("fallback_source", 7), ("fit_exclude", 8), ("invalid_variance", 9), ("neighbour", 4))


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def median(values: Column) -> Column:
    """The median of an array's finite numbers."""
    s = F.array_sort(F.filter(values, finite))
    n = F.size(s)
    return F.when(n > 0, (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2)


def to_steradian(arcsec2: Column) -> Column:
    """A map in square arcseconds in steradians; null where it holds no finite value or its middle is not above 0."""
    return F.when(median(arcsec2) > 0, F.transform(arcsec2, lambda x: x * ARCSEC2_TO_SR))


def to_microjansky(image: Column, solid_angle_sr: Column) -> Column:
    """Surface brightness in MJy/sr as microjanskys per pixel."""
    return F.zip_with(image, solid_angle_sr, lambda v, s: v * s * MJY_TO_UJY)


def variance_to_microjansky(variance: Column, solid_angle_sr: Column) -> Column:
    return F.zip_with(variance, solid_angle_sr, lambda v, s: v * (s * MJY_TO_UJY) * (s * MJY_TO_UJY))


def same_grid(x: Column, y: Column, width: int, height: int) -> Column:
    """Whether detector places are those of the image's own pixels."""
    near = lambda a, b: (F.abs(a - b) <= 1.0e-6 + 1.0e-5 * F.abs(b))
    grid = F.transform(F.sequence(F.lit(0), F.lit(width * height - 1)), lambda i: F.struct((i % width).cast("double").alias("x"), F.floor(i / width).cast("double").alias("y")))
    own = F.zip_with(x, grid, lambda a, g: near(a, g.x)), F.zip_with(y, grid, lambda a, g: near(a, g.y))
    return (F.size(x) == width * height) & F.forall(own[0], lambda ok: F.coalesce(ok, F.lit(False))) & F.forall(own[1], lambda ok: F.coalesce(ok, F.lit(False)))


def sample(detector_map: Column, x: Column, y: Column, width: int, height: int) -> Column:
    """Values of a detector's map at rounded places, clipped to the map."""
    place = lambda v, n: F.least(F.lit(n - 1), F.greatest(F.lit(0), F.rint(v).cast("int")))
    return F.zip_with(x, y, lambda a, b: F.get(detector_map, place(b, height) * width + place(a, width)))


def wavelength(wave: Column, band: Column, weights: Column, width: int, height: int) -> dict[str, Column]:
    """Wavelength and bandwidth of an image: means weighted by the response, or the values at its centre where no weight is usable.

    ``wave`` and ``band`` are the maps sampled at the image's pixels. The centre is the pixel of the largest weight, else the middle one.
    """
    usable = F.filter(F.arrays_zip(wave.alias("w"), band.alias("b"), weights.alias("r")), lambda p: finite(p["w"]) & finite(p["b"]) & finite(p["r"]) & (p["r"] > 0))
    total = F.aggregate(usable, F.lit(0.0), lambda a, p: a + p["r"])
    mean = lambda k: F.aggregate(usable, F.lit(0.0), lambda a, p: a + p["r"] * p[k]) / total
    largest = F.array_max(F.filter(weights, finite))
    centre = F.coalesce(F.when(largest > 0, F.array_position(weights, largest).cast("int") - 1), F.lit((height // 2) * width + width // 2))
    at = lambda m: F.get(m, centre)
    good = F.size(usable) > 0
    return {
        "wavelength_um": F.when(good, mean("w")).otherwise(at(wave)), "bandwidth_um": F.when(good, mean("b")).otherwise(at(band)), "wavelength_center_um": at(wave), "bandwidth_center_um": at(band),
        "method": F.when(good, "spectral_wcs_psf_weighted").otherwise("spectral_wcs_center"),
    }


def detector_maps(hdus: DataFrame) -> DataFrame:
    """``path, cwave, cband, shape, solid_angle, solid_angle_shape`` of calibration files: the named wavelength planes, and the first plane of two axes."""
    named = lambda n, c: F.min_by(F.when(F.upper("name") == n, F.col(c)), F.when(F.upper("name") == n, F.col("hdu")))
    plane = F.when((F.size("shape") == 2) & F.col("data").isNotNull(), F.col("hdu"))
    return hdus.groupBy("path").agg(
        named("CWAVE", "data").alias("cwave"), named("CBAND", "data").alias("cband"), named("CWAVE", "shape").alias("shape"), named("CBAND", "shape").alias("band_shape"),
        F.min_by("data", plane).alias("solid_angle"), F.min_by("shape", plane).alias("solid_angle_shape"), F.max(F.try_element_at("cards", F.lit("ERROR"))).alias("error"),
    )


def map_status(maps: DataFrame, kind: str) -> DataFrame:
    """``path, status, reason`` of calibration files of a kind, as from detector_maps()."""
    any_finite = lambda c: F.exists(c, finite)
    if kind == "spectral_wcs":
        reason = (
            F.when(F.col("cwave").isNull() | F.col("cband").isNull(), "missing required unit").when((F.size("shape") != 2) | (F.col("shape") != F.col("band_shape")), "wavelength planes must be matching and of two axes")
            .when(~any_finite("cwave") | ~any_finite("cband"), "no finite values").when(~((median(F.col("cwave")) > 0) & (median(F.col("cband")) > 0)), "median values must be positive")
        )
    else:
        reason = F.when(F.col("solid_angle").isNull(), "no plane of two axes").when(~any_finite("solid_angle"), "no finite values").when(~(median(F.col("solid_angle")) > 0), "median value must be positive")
    reason = F.when(F.col("error").isNotNull(), F.col("error")).otherwise(reason)
    return maps.select("path", F.when(reason.isNull(), "valid").otherwise("failed").alias("status"), reason.alias("reason"))


def template_flags(truncated: Column, warnings: Column) -> Column:
    return F.array_compact(F.array(F.when(truncated, PSF_TRUNCATED), F.when(F.exists(warnings, lambda w: F.contains(w, F.lit("PSF_CENTER"))), PSF_UNCERTAIN)))


def mask_flags(n_blocking: Column, core_share: Column, template_share: Column, least: float) -> Column:
    return F.array_compact(F.array(F.when(n_blocking > 0, SEVERE_FLAG), F.when(core_share < least, CORE_MASKED), F.when(template_share < least, LOW_SUPPORT)))


def mask_map(masks: dict[str, Column]) -> Column:
    """A code per pixel from arrays of booleans: where masks overlap the one painted last is seen, 0 where there is none."""
    names = [n for n, _ in PAINTED if n in masks]
    codes = dict(PAINTED)
    out = F.transform(masks[names[0]], lambda m: F.lit(0))

    def paint(under: Column, mask: Column, code: int) -> Column:
        return F.zip_with(under, mask, lambda old, m: F.when(m, code).otherwise(old))

    for n in names:
        out = paint(out, masks[n], codes[n])
    return out


def fit_summary(**fields: Column) -> Column:
    """A fit's numbers as one nested value."""
    return F.struct(*(c.alias(k) for k, c in fields.items()))


def invalid_central_metrics() -> dict[str, Column]:
    """What stands for the central residuals of a failed fit."""
    return {k: F.lit(float("nan")) for k in ("max_abs_sigma", "mean_abs_sigma", "chi2_central")}
