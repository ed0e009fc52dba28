"""Weighted linear fits of one or two templates to images, and measures of their residuals, as grouped sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _use(mask: str) -> Column:
    return F.col(mask) & (F.col("variance") > 0)


def point_fit(pixels: DataFrame, template: str, mask: str, background_sigma: float = 0.0) -> DataFrame:
    """``image_id, n_pixels, flux, flux_err, chi2_reduced`` of one template per image.

    The flux is the matched filter sum(t d / v) / sum(t t / v). The error has a share from the uncertainty of the
    background, through sum(t / v). No more than one usable pixel, or a template without weight there, gives nulls.
    """
    t, d, v, use = F.col(template), F.col("value"), F.col("variance"), _use(mask)
    s = pixels.groupBy("image_id").agg(
        F.count_if(use).alias("n"), F.sum(F.when(use, t * d / v)).alias("td"), F.sum(F.when(use, t * t / v)).alias("tt"), F.sum(F.when(use, d * d / v)).alias("dd"), F.sum(F.when(use, t / v)).alias("t1"),
    )
    ok = (F.col("n") > 1) & (F.col("tt") > 0)
    flux = F.col("td") / F.col("tt")
    err = F.sqrt(1 / F.col("tt") + F.lit(background_sigma**2) * F.pow(F.col("t1") / F.col("tt"), 2))
    chi2 = (F.col("dd") - F.col("td") * flux) / F.greatest(F.col("n") - 1, F.lit(1))
    return s.select("image_id", F.col("n").alias("n_pixels"), F.when(ok, flux).alias("flux"), F.when(ok, err).alias("flux_err"), F.when(ok, chi2).alias("chi2_reduced"))


def joint_fit(pixels: DataFrame, a: str, b: str, mask: str, worst_condition: float = 1.0e8) -> DataFrame:
    """``image_id, n_pixels, flux_a, flux_b, err_a, err_b, correlation, chi2_reduced`` of two templates fitted together, in closed form."""
    ta, tb, d, v, use = F.col(a), F.col(b), F.col("value"), F.col("variance"), _use(mask)
    terms = {"aa": ta * ta / v, "ab": ta * tb / v, "bb": tb * tb / v, "da": d * ta / v, "db": d * tb / v, "dd": d * d / v}
    s = pixels.groupBy("image_id").agg(F.count_if(use).alias("n"), *(F.sum(F.when(use, x)).alias(k) for k, x in terms.items()))
    c = F.col
    det = c("aa") * c("bb") - c("ab") * c("ab")
    fa, fb = (c("bb") * c("da") - c("ab") * c("db")) / det, (c("aa") * c("db") - c("ab") * c("da")) / det
    half, root = (c("aa") + c("bb")) / 2, F.sqrt(F.pow((c("aa") - c("bb")) / 2, 2) + c("ab") * c("ab"))
    ok = (c("n") > 2) & (half - root > 0) & ((half + root) / (half - root) < worst_condition)
    chi2 = (c("dd") - fa * c("da") - fb * c("db")) / F.greatest(c("n") - 2, F.lit(1))
    values = {"flux_a": fa, "flux_b": fb, "err_a": F.sqrt(c("bb") / det), "err_b": F.sqrt(c("aa") / det), "correlation": -c("ab") / F.sqrt(c("aa") * c("bb")), "chi2_reduced": chi2}
    return s.select("image_id", F.col("n").alias("n_pixels"), *(F.when(ok, x).alias(k) for k, x in values.items()))


def stable_joint(point: DataFrame, joint: DataFrame, worst_correlation: float = 0.9, worst_inflation: float = 3.0) -> DataFrame:
    """``image_id, inflation, stable``: whether the joint fit may replace the single one."""
    p = point.select("image_id", F.col("flux_err").alias("p_err"), F.col("chi2_reduced").alias("p_chi2"))
    both = joint.join(p, "image_id")
    inflation = F.col("err_a") / F.col("p_err")
    stable = (F.abs(F.col("correlation")) <= worst_correlation) & (inflation <= worst_inflation) & (F.col("chi2_reduced") <= 1.05 * F.col("p_chi2"))
    return both.select("image_id", inflation.alias("inflation"), F.coalesce(stable, F.lit(False)).alias("stable"))


def residual_metrics(pixels: DataFrame, fits: DataFrame, template: str, mask: str, central: str, r2: Column) -> DataFrame:
    """Median, largest and mean residual in sigmas within the centre, and the mean size within 2.5 pixels."""
    z = (F.col("value") - F.col("flux") * F.col(template)) / F.sqrt("variance")
    rest = pixels.join(fits.select("image_id", "flux"), "image_id").filter(_use(mask) & F.col("flux").isNotNull()).withColumn("z", z).withColumn("near", r2 <= 6.25)
    c = lambda x: F.when(F.col(central), x)
    return rest.groupBy("image_id").agg(
        F.median(c(F.abs("z"))).alias("central_median_abs"), F.max(c(F.col("z"))).alias("central_peak"), F.avg(c(F.col("z"))).alias("central_mean"), F.avg(F.when(F.col("near"), F.abs("z"))).alias("mean_abs_2p5")
    )


def weighted_mean(pixels: DataFrame, value: str, template: str, mask: str) -> DataFrame:
    """``image_id, weighted, at_peak``: a value's mean with weights t t / v, and its value where the weight is largest (ties to the first pixel)."""
    w = F.col(template) * F.col(template) / F.col("variance")
    use = pixels.filter(_use(mask)).withColumn("w", w).filter("w > 0")
    out = use.groupBy("image_id").agg((F.sum(F.col("w") * F.col(value)) / F.sum("w")).alias("weighted"), F.max_by(value, F.struct(F.col("w"), -F.col("y"), -F.col("x"))).alias("at_peak"))
    return out


def overlap(pixels: DataFrame, a: str, b: str) -> DataFrame:
    """``image_id, overlap``: the cosine between two templates."""
    x, y = F.col(a), F.col(b)
    return pixels.groupBy("image_id").agg((F.sum(x * y) / F.sqrt(F.sum(x * x) * F.sum(y * y))).alias("overlap"))
