"""Forced photometry of whole images: masks, background, fit, neighbours, joint fit and the gate between the fits.

Every step is a frame keyed by image; only the small normal equations of a joint fit are solved in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.operators import background, components, fit, pixels, selection
from skyloom.session import cut_lineage

# Settings of the search for neighbours and of the gate between the fits.
FIT_BOX, SNR, MIN_AREA, GUARD, MIN_DISTANCE, MATERIAL_OVERLAP, MERGE_RADIUS, MOST = 15, 5.0, 1, 1.5, 2.0, 0.05, 2.0, 8
# Why an area of the residuals is no neighbour, in the order of the rules.
REJECTED = ("touches_target_protection", "small_component", "near_target_protected_residual", "inside_minimum_target_distance", "low_target_influence", "merged_with_nearby_component", "max_neighbors_exceeded")
WORST_CORRELATION, WORST_INFLATION, CHI2_GAIN, WORST_CONDITION = 0.9, 3.0, 1.05, 1.0e8
SOLVED = "image_id bigint, n_pixels bigint, fluxes array<double>, errors array<double>, worst_correlation double, chi2_reduced double, ok boolean"


def distance2(x0: float, y0: float) -> Column:
    return F.pow(F.col("x") - x0, 2) + F.pow(F.col("y") - y0, 2)


def subtract_plane(masked: DataFrame, planes: DataFrame, x0: float, y0: float) -> DataFrame:
    """Pixels above the background plane; images without one keep no pixels."""
    ok = planes.filter("ok").select("image_id", "b0", "bx", "by", "uncertainty")
    plane = F.col("b0") + F.col("bx") * (F.col("x") - x0) + F.col("by") * (F.col("y") - y0)
    return masked.join(ok, "image_id").withColumn("value", F.col("value") - plane).drop("b0", "bx", "by")


def find_neighbours(rest: DataFrame, x0: float, y0: float, width: int) -> DataFrame:
    """Every bright area of the residuals with ``reason``: null for a neighbour, else the first rule that rejects it.

    Rules in order: touches the protected target, too small, within the guard radius, too near, without influence on
    the target, merged with an earlier kept one, beyond the MOST strongest. ``rest`` has masks, ``residual`` and
    ``template``.
    """
    guard = pixels.PROTECTED_RADIUS + GUARD
    snr = F.col("residual") / F.sqrt("variance")
    bright = rest.filter(F.col("source_finding") & (snr >= SNR) & (distance2(x0, y0) <= (FIT_BOX / 2) ** 2) & ~F.col("protected") & (distance2(x0, y0) > guard**2))
    labelled = components.connected_components(bright.select("image_id", "y", "x"), width)
    members = labelled.join(rest.select("image_id", "y", "x", F.col("residual").alias("value"), "variance"), ["image_id", "y", "x"])
    found = components.summarize(members, x0, y0)
    shielded = rest.filter("protected").select("image_id", F.col("x").alias("cx"), F.col("y").alias("cy"), F.lit(True).alias("inside"))
    found = found.withColumn("cx", F.rint("centroid_x").cast("int")).withColumn("cy", F.rint("centroid_y").cast("int")).join(shielded, ["image_id", "cx", "cy"], "left")
    cosine = neighbour_templates(found, rest).groupBy("image_id", "component").agg((F.sum(F.col("t") * F.col("template")) / F.sqrt(F.sum(F.col("t") * F.col("t")) * F.sum(F.col("template") * F.col("template")))).alias("overlap"))
    found = found.join(cosine, ["image_id", "component"], "left").withColumn("overlap", F.coalesce("overlap", F.lit(0.0)))
    heard = (F.abs("peak_snr") >= SNR) | (F.abs("total_snr") >= SNR)
    material = heard & ((F.col("overlap") >= MATERIAL_OVERLAP) | ((F.col("distance") <= FIT_BOX / 2) & (F.abs("total_snr") >= SNR)))
    reason = F.when(F.coalesce("inside", F.lit(False)), REJECTED[0]).when(F.col("area") < MIN_AREA, REJECTED[1]).when(F.col("distance") <= guard, REJECTED[2])
    reason = reason.when(F.col("distance") < MIN_DISTANCE, REJECTED[3]).when(~material, REJECTED[4])
    found = found.withColumn("reason", reason).drop("cx", "cy", "inside")
    passed = components.merge_nearby(found.filter("reason is null"), MERGE_RADIUS).withColumn("reason", F.when(~F.col("kept"), REJECTED[5]))
    rank = F.row_number().over(Window.partitionBy("image_id", "kept").orderBy(F.desc("peak_snr"), "component"))
    passed = passed.withColumn("rank", F.when(F.col("kept"), rank)).withColumn("reason", F.when(F.col("rank") > MOST, REJECTED[6]).otherwise(F.col("reason")))
    return found.filter("reason is not null").withColumn("rank", F.lit(None).cast("int")).unionByName(passed.drop("kept"))


def neighbour_templates(found: DataFrame, rest: DataFrame, sigma: float = 1.2) -> DataFrame:
    """``image_id, component, y, x, template, t``: a round template of unit sum at each component's centroid."""
    bump = F.exp(-0.5 * (F.pow((F.col("x") - F.col("centroid_x")) / sigma, 2) + F.pow((F.col("y") - F.col("centroid_y")) / sigma, 2)))
    each = found.select("image_id", "component", "centroid_x", "centroid_y").join(rest.select("image_id", "y", "x", "template"), "image_id").withColumn("b", bump)
    return each.withColumn("t", F.col("b") / F.sum("b").over(Window.partitionBy("image_id", "component"))).drop("b", "centroid_x", "centroid_y")


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            k = len(r.rhs)
            normal, rhs = np.array(r.normal, float).reshape(k, k), np.array(r.rhs, float)
            cond = np.linalg.cond(normal) if np.isfinite(normal).all() else np.inf
            ok = bool(r.n > k and np.isfinite(cond) and cond < WORST_CONDITION)
            if not ok:
                out.append((r.image_id, r.n, None, None, None, None, False))
                continue
            cov = np.linalg.inv(normal)
            flux = cov @ rhs
            chi2 = (r.dd - flux @ rhs) / max(r.n - k, 1)
            coupling = cov @ np.array(r.ones, float)
            cov = cov + r.sigma**2 * np.outer(coupling, coupling)
            size = np.sqrt(np.diag(cov))
            corr = float(np.max(np.abs(cov[0, 1:] / (size[0] * size[1:])))) if k > 1 else 0.0
            out.append((r.image_id, r.n, flux.tolist(), size.tolist(), corr, float(chi2), True))
        yield pd.DataFrame(out, columns=["image_id", "n_pixels", "fluxes", "errors", "worst_correlation", "chi2_reduced", "ok"])


def joint_fit(data: DataFrame, mask: str) -> DataFrame:
    """SOLVED rows of weighted least squares with any number of templates per image.

    ``data`` has ``image_id, value, variance, ts`` (the templates at the pixel, as many at all pixels of an image),
    ``uncertainty`` (of the background) and the mask. The normal equations are sums over pixels; no more than a few
    numbers per image reach the solver. Too few pixels or a condition of 1e8 or more give ok false.
    """
    use = data.filter(F.col(mask) & (F.col("variance") > 0))
    pairs = use.select("image_id", "variance", F.posexplode("ts").alias("i", "a"), "ts").select("image_id", "variance", "i", "a", F.posexplode("ts").alias("j", "b"))
    normal = pairs.groupBy("image_id", "i", "j").agg(F.sum(F.col("a") * F.col("b") / F.col("variance")).alias("s")).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("i", "j", "s"))).alias("m"))
    each = use.select("image_id", "value", "variance", F.posexplode("ts").alias("i", "a")).groupBy("image_id", "i").agg(F.sum(F.col("a") * F.col("value") / F.col("variance")).alias("r"), F.sum(F.col("a") / F.col("variance")).alias("o"))
    sides = each.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("i", "r", "o"))).alias("v"))
    rest = use.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value") * F.col("value") / F.col("variance")).alias("dd"), F.first("uncertainty").alias("sigma"))
    rows = normal.join(sides, "image_id").join(rest, "image_id")
    return rows.select("image_id", "n", "dd", F.coalesce("sigma", F.lit(0.0)).alias("sigma"), F.col("m.s").alias("normal"), F.col("v.r").alias("rhs"), F.col("v.o").alias("ones")).mapInPandas(_solve, SOLVED)


def measure(images: DataFrame, x0: float, y0: float, width: int) -> DataFrame:
    """One row per image of ``image_id, y, x, value, variance, flag, template``: the forced flux of the target at a place.

    The background plane is fitted outside the protected target, the target is fitted, bright areas of what is left
    are taken as neighbours, the background is fitted again without them, and target and neighbours are fitted
    together. The joint flux counts where it is stable: not too correlated, not much less certain, and no worse a fit.
    Where the background mask leaves too little, the plane goes through all sound pixels outside the target that aren't
    bright. Images whose background can't be fitted either way come out with null flux and status invalid_background.
    """
    masked = pixels.with_masks(images, x0, y0)
    first = cut_lineage(subtract_plane(masked, background.plane_or_fallback(masked, x0, y0), x0, y0))
    point = fit.point_fit(first, "template", "fit")
    rest = cut_lineage(first.join(point.select("image_id", "flux"), "image_id").withColumn("residual", F.col("value") - F.coalesce("flux", F.lit(0.0)) * F.col("template")))
    found = cut_lineage(find_neighbours(rest, x0, y0, width))
    kept = found.filter("reason is null")
    at = neighbour_templates(kept, rest).join(kept.select("image_id", "component", "rank"), ["image_id", "component"])
    covered = at.withColumn("near", pixels.footprint_in("t", pixels.FOOTPRINT, ["image_id", "component"])).groupBy("image_id", "y", "x").agg(F.bool_or("near").alias("neighbour"), F.array_sort(F.collect_list(F.struct("rank", "t"))).alias("others"))
    again = images.join(covered, ["image_id", "y", "x"], "left").withColumn("covered", F.coalesce("neighbour", F.lit(False))).drop("neighbour")
    masked = pixels.with_masks(again, x0, y0, neighbour=F.col("covered"))
    data = subtract_plane(masked, background.plane_or_fallback(masked, x0, y0), x0, y0)
    data = cut_lineage(data.withColumn("ts", F.concat(F.array("template"), F.coalesce(F.transform("others", lambda o: o.t), F.array().cast("array<double>")))))
    alone = joint_fit(data.withColumn("ts", F.array("template")), "fit").select("image_id", "n_pixels", F.col("fluxes")[0].alias("p_flux"), F.col("errors")[0].alias("p_err"), F.col("chi2_reduced").alias("p_chi2"))
    together = joint_fit(data.filter("size(ts) > 1"), "fit").select("image_id", F.col("fluxes")[0].alias("j_flux"), F.col("errors")[0].alias("j_err"), F.col("chi2_reduced").alias("j_chi2"), "worst_correlation", (F.size("fluxes") - 1).alias("n_neighbours"), F.col("ok").alias("j_ok"))
    counts = found.groupBy("image_id").agg(F.count_if(F.col("reason").isNotNull()).alias("n_rejected"))
    out = images.select("image_id").distinct().join(alone, "image_id", "left").join(together, "image_id", "left").join(counts, "image_id", "left")
    inflation = F.col("j_err") / F.col("p_err")
    stable = F.coalesce(F.col("j_ok") & (F.col("worst_correlation") <= WORST_CORRELATION) & (inflation <= WORST_INFLATION) & (F.col("j_chi2") <= CHI2_GAIN * F.col("p_chi2")), F.lit(False))
    out = out.withColumn("stable", stable)
    flux, err = (F.when(F.col("stable"), F.col(f"j_{c}")).otherwise(F.col(f"p_{c}")) for c in ("flux", "err"))
    return out.select(
        "image_id", "n_pixels", flux.alias("flux"), err.alias("flux_err"), F.when(F.col("stable"), F.col("j_chi2")).otherwise(F.col("p_chi2")).alias("chi2_reduced"), F.coalesce("n_neighbours", F.lit(0)).alias("n_neighbours"), F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"),
        F.when(F.col("j_ok").isNull(), "none").when(F.col("stable"), "joint_stable").otherwise("needed_unstable").alias("deblending"),
        F.when(F.col("n_pixels").isNull(), "invalid_background").otherwise(selection.detection_status(flux, err)).alias("status"), selection.upper_limit(err).alias("upper_limit"),
    )
