"""Images as pixel rows: templates, bit flags, masks and what they cover.

A pixel row has ``image_id, y, x, value, variance, flag``; every operator groups by image, and images are bounded in
size, so groups are too.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

# Names of the bits of a pixel's flag, by bit number.
FLAG_BITS = {
    "TRANSIENT": 0, "OVERFLOW": 1, "SUR_ERROR": 2, "PHANTOM": 4, "REFERENCE": 5, "NONFUNC": 6, "DICHROIC": 7, "MISSING_DATA": 9, "HOT": 10, "COLD": 11, "FULLSAMPLE": 12, "SUR_MISMATCH": 13, "PHANMISS": 14,
    "NONLINEAR": 15, "VAR_UNDER": 16, "PERSIST": 17, "PERSIST_UNK": 18, "OUTLIER": 19, "CROSSTALK": 20, "SOURCE": 21, "GHOST": 22, "GHOST_EXT": 24, "BLOOM": 26, "SNOWBALL": 27, "HALO": 28, "SATELLITE_HALO": 29,
}
# Bits that bar a pixel from the fit, from the background, and from science use.
FIT_BITS = ("SUR_ERROR", "NONFUNC", "MISSING_DATA", "HOT", "COLD", "NONLINEAR", "PERSIST")
BACKGROUND_BITS = ("TRANSIENT", "OVERFLOW", "SUR_ERROR", "NONFUNC", "MISSING_DATA", "HOT", "COLD", "NONLINEAR", "PERSIST", "OUTLIER", "SOURCE")
SCIENCE_BITS = ("OVERFLOW", "SUR_ERROR", "NONFUNC", "DICHROIC", "MISSING_DATA", "HOT", "COLD", "NONLINEAR", "PERSIST")
# Footprint and protection settings.
FOOTPRINT, PROTECTED_FOOTPRINT, PROTECTED_RADIUS, PROTECTED_DILATION, EDGE, CENTRAL_RADIUS = 0.01, 0.2, 2.0, 1, 1, 2.0

def _image() -> WindowSpec:
    return Window.partitionBy("image_id")


def bit_value(names: Sequence[str | int]) -> int:
    """Names (or numbers) of bits as one number; an unknown name is an error."""
    unknown = [n for n in names if isinstance(n, str) and n.upper() not in FLAG_BITS]
    if unknown:
        raise ValueError(f"unknown flag bits: {unknown}")
    return reduce(int.__or__, (n if isinstance(n, int) else 1 << FLAG_BITS[n.upper()] for n in names), 0)


def has_bits(flag: Column, names: Sequence[str | int]) -> Column:
    return flag.cast("bigint").bitwiseAND(F.lit(bit_value(names)).cast("bigint")) != 0


def flag_names(flag: Column) -> Column:
    """Names of the set bits in the order of the bits."""
    return F.array_compact(F.array(*(F.when(has_bits(flag, [name]), name) for name in FLAG_BITS)))


def explode_images(images: DataFrame, key: str, values: str, width: int) -> DataFrame:
    """Pixel rows of images stored as flat arrays in row-major order."""
    flat = images.select(F.col(key).alias("image_id"), F.posexplode(values).alias("i", "value"))
    return flat.select("image_id", "i", F.floor(F.col("i") / width).cast("int").alias("y"), (F.col("i") % width).cast("int").alias("x"), F.col("value").cast("double").alias("value"))


def gaussian_template(x0: Column | float, y0: Column | float, sigma: float = 1.2) -> Column:
    """A round template of unit sum over its image."""
    x0, y0 = (c if isinstance(c, Column) else F.lit(float(c)) for c in (x0, y0))
    bump = F.exp(-0.5 * (F.pow((F.col("x") - x0) / sigma, 2) + F.pow((F.col("y") - y0) / sigma, 2)))
    return bump / F.sum(bump).over(_image())


def footprint_in(template: str, threshold: float, keys: Sequence[str]) -> Column:
    """Pixels where a template reaches a share of its peak among rows of equal keys; none where it has no positive peak."""
    clean = F.coalesce(F.nanvl(F.col(template), F.lit(0.0)), F.lit(0.0))
    peak = F.max(clean).over(Window.partitionBy(*keys))
    return (peak > 0) & (clean >= peak * threshold)


def footprint(template: str, threshold: float) -> Column:
    return footprint_in(template, threshold, ["image_id"])


def dilate(pixels: DataFrame, mask: str, radius: int, out: str) -> DataFrame:
    """``out``: pixels within a square of the radius around a masked one.

    The running maximum along a row and then along a column is that square, so no pixel is ever multiplied.
    """
    along = lambda a, b: Window.partitionBy("image_id", a).orderBy(b).rangeBetween(-radius, radius)
    wide = pixels.withColumn("__w", F.max(F.col(mask).cast("int")).over(along("y", "x")))
    return wide.withColumn(out, F.max("__w").over(along("x", "y")) == 1).drop("__w")


def with_masks(pixels: DataFrame, x0: float, y0: float, template: str = "template", neighbour: Column | None = None) -> DataFrame:
    """Pixel rows with the masks of a forced measurement at a place."""
    r2 = F.pow(F.col("x") - x0, 2) + F.pow(F.col("y") - y0, 2)
    size = [(F.min(c).over(_image()), F.max(c).over(_image())) for c in ("x", "y")]
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    base = pixels.withColumns({
        "good_variance": finite("variance") & (F.col("variance") > 0),
        "hard_bad": has_bits(F.col("flag"), FIT_BITS), "background_bad": has_bits(F.col("flag"), BACKGROUND_BITS), "science_bad": has_bits(F.col("flag"), SCIENCE_BITS), "source_flag": has_bits(F.col("flag"), ["SOURCE"]),
        "central": r2 <= CENTRAL_RADIUS**2, "target_footprint": footprint(template, FOOTPRINT), "__peak": footprint(template, PROTECTED_FOOTPRINT), "__disc": r2 <= PROTECTED_RADIUS**2,
        "edge": (F.col("x") < size[0][0] + EDGE) | (F.col("x") > size[0][1] - EDGE) | (F.col("y") < size[1][0] + EDGE) | (F.col("y") > size[1][1] - EDGE),
        "neighbour": F.lit(False) if neighbour is None else neighbour,
    })
    base = dilate(base, "__peak", PROTECTED_DILATION, "__wide").withColumn("finite", finite("value") & F.col("good_variance"))
    base = base.withColumn("protected", F.col("__disc") | F.col("__wide")).drop("__disc", "__wide", "__peak")
    base = base.withColumn("fit", F.col("finite") & ~F.col("hard_bad"))
    return base.withColumns({
        "background": F.col("finite") & ~F.col("background_bad") & ~F.col("protected") & ~F.col("neighbour"),
        "source_finding": F.col("fit") & ~F.col("protected") & ~F.col("edge"),
        "fit_region": F.col("target_footprint") | F.col("central"),
    })


def share(mask: str, region: Column) -> Column:
    """Share of a region's pixels that are masked; 0 for an empty region."""
    return F.coalesce(F.count_if(F.col(mask) & region) / F.nullif(F.count_if(region), F.lit(0)), F.lit(0.0))


def weighted_share(weight: str, mask: Column) -> Column:
    w = F.greatest(F.coalesce(F.nanvl(F.col(weight), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    return F.coalesce(F.sum(F.when(mask, w).otherwise(0.0)) / F.nullif(F.sum(w), F.lit(0.0)), F.lit(0.0))


def mask_statistics(masked: DataFrame, template: str = "template") -> DataFrame:
    """One row of counts, shares and flag unions per image."""
    every = F.lit(True)
    union = lambda region: F.coalesce(F.bit_or(F.when(region, F.col("flag").cast("bigint"))), F.lit(0).cast("bigint"))
    return masked.groupBy("image_id").agg(
        F.count_if("fit").alias("n_fit"), F.count_if("background").alias("n_background"), F.count_if("source_finding").alias("n_source_finding"), F.count_if("protected").alias("n_protected"),
        F.count_if("hard_bad").alias("n_hard_bad"), F.count_if(F.col("science_bad") & F.col("fit_region")).alias("n_science_bad_fit"),
        union(every).alias("flags_all"), union(F.col("fit_region")).alias("flags_fit"), union(F.col("central")).alias("flags_central"), union(F.col("target_footprint")).alias("flags_footprint"),
        share("fit", every).alias("fit_share"), share("background", every).alias("background_share"), share("protected", every).alias("protected_share"), share("hard_bad", F.col("central")).alias("hard_bad_core_share"),
        share("source_flag", F.col("fit_region")).alias("source_fit_share"), share("fit", F.col("central")).alias("central_fit_share"), weighted_share(template, F.col("fit")).alias("template_unmasked"),
        weighted_share(template, F.col("hard_bad")).alias("template_hard_bad"), weighted_share(template, ~F.col("good_variance")).alias("template_bad_variance"),
    )


def flag_counts(pixels: DataFrame) -> DataFrame:
    """``image_id, flag_name, n_pixels`` for every bit that occurs in an image."""
    return pixels.select("image_id", F.explode(flag_names(F.col("flag"))).alias("flag_name")).groupBy("image_id", "flag_name").agg(F.count(F.lit(1)).alias("n_pixels"))
