"""Clipped plane and constant backgrounds of images, as a fixed number of rounds of grouped sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLIP, ROUNDS, LEAST, LEAST_PLANE, WORST_CONDITION = 3.0, 2, 10, 12, 1.0e8
MAD = 1.4826
OVER = "over (partition by image_id)"
# robust scatter: 1.4826 times the median distance from the median, or the standard deviation where that is 0
SCATTER = f"if(mad > 0, {MAD} * mad, sd)"


def _with_middle(pixels: DataFrame, value: str, keep: str, *more: str) -> DataFrame:
    """``mid, sd, mad`` of each image's kept values, and more columns over the image; two windows of one partitioning."""
    kept = f"case when {keep} then {value} end"
    out = pixels.selectExpr("*", f"median({kept}) {OVER} as mid", f"stddev_pop({kept}) {OVER} as sd", *more)
    return out.selectExpr("*", f"median(case when {keep} then abs({value} - mid) end) {OVER} as mad")


def _plane(pixels: DataFrame, keep: str, carried: list[str]) -> DataFrame:
    """The carried columns with ``b0, bx, by`` of the weighted plane through each image's kept pixels and the rest ``r``.

    The plane comes from nine sums and Cramer's rule; its coefficients are null where the sums don't determine it.
    """
    terms = {"s": "1", "sx": "xc", "sy": "yc", "sxx": "xc * xc", "sxy": "xc * yc", "syy": "yc * yc", "sz": "value", "sxz": "xc * value", "syz": "yc * value"}
    sums = pixels.selectExpr(*carried, f"count_if({keep}) {OVER} as n", *(f"sum(case when {keep} then {t} / variance end) {OVER} as {k}" for k, t in terms.items()))
    # minors of the symmetric matrix (s sx sy / sx sxx sxy / sy sxy syy)
    minors = {"m00": "sxx * syy - sxy * sxy", "m01": "sx * syy - sxy * sy", "m02": "sx * sxy - sxx * sy", "m11": "s * syy - sy * sy", "m12": "s * sxy - sx * sy", "m22": "s * sxx - sx * sx"}
    sums = sums.selectExpr("*", *(f"{m} as {k}" for k, m in minors.items())).selectExpr("*", "s * m00 - sx * m01 + sy * m02 as det")
    ok = f"n >= {LEAST_PLANE} and abs(det) * {WORST_CONDITION} > s * sxx * syy"
    rows = {"b0": "m00 * sz - m01 * sxz + m02 * syz", "bx": "-m01 * sz + m11 * sxz - m12 * syz", "by": "m02 * sz - m12 * sxz + m22 * syz"}
    solved = sums.selectExpr(*carried, *(f"case when {ok} then ({v}) / det end as `{k}`" for k, v in rows.items()))
    return solved.selectExpr("*", "value - (b0 + bx * xc + `by` * yc) as r")


def clipped_plane(pixels: DataFrame, mask: str, x0: float, y0: float) -> DataFrame:
    """``image_id, n_pixels, b0, bx, by, rms, uncertainty, clipped_share, ok`` of each image's background plane.

    ``ROUNDS + 1`` times a weighted plane is fitted to the kept pixels, and pixels further from it than CLIP times the
    larger of robust scatter and noise floor are dropped. An image left with too few pixels or undetermined equations
    has nulls and ok false; one without any masked pixel has no row. All rounds are windows over one partitioning by
    image.
    """
    carried = ["image_id", "value", "variance", "xc", "yc", "noise", "kept"]
    state = pixels.filter(mask).selectExpr("image_id", "value", "variance", f"x - {x0!r}D as xc", f"y - {y0!r}D as yc", "sqrt(variance) as noise", "true as kept")
    floor, rms = f"median(case when kept then noise end) {OVER} as floor_", f"greatest({SCATTER}, floor_)"
    for _ in range(ROUNDS + 1):
        fitted = _with_middle(_plane(state, "kept", carried), "r", "kept", floor)
        state = fitted.selectExpr(*carried[:-1], "b0", "bx", "`by`", "r", f"coalesce(kept and abs(r) <= {CLIP} * {rms}, false) as kept")
    state = _with_middle(state, "r", "kept", floor)
    firsts = [F.expr(f"first(`{k}`)").alias(k) for k in ("b0", "bx", "by")]
    out = state.groupBy("image_id").agg(F.expr("count(1)").alias("n0"), F.expr("count_if(kept)").alias("n_pixels"), *firsts, F.expr(f"first({rms})").alias("rms"))
    out = out.selectExpr("*", f"b0 is not null and n_pixels >= {LEAST_PLANE} as ok")
    return out.selectExpr("image_id", "n_pixels", *(f"if(ok, `{k}`, null) as `{k}`" for k in ("b0", "bx", "by", "rms")), "if(ok, rms / sqrt(n_pixels), null) as uncertainty", "1 - n_pixels / n0 as clipped_share", "ok")


def clipped_median(pixels: DataFrame, mask: str, rounds: int = ROUNDS) -> DataFrame:
    """``image_id, n_pixels, value, sigma``: the median after rounds of clipping about it; once fewer than LEAST pixels are left nothing more is clipped."""
    state = pixels.filter(mask).selectExpr("image_id", "value", "true as kept")
    for _ in range(rounds):
        near = f"(n < {LEAST} or not {SCATTER} > 0 or abs(value - mid) <= {CLIP} * {SCATTER})"
        state = _with_middle(state, "value", "kept", f"count_if(kept) {OVER} as n").selectExpr("image_id", "value", f"kept and {near} as kept")
    end = _with_middle(state, "value", "kept")
    return end.groupBy("image_id").agg(F.expr("count_if(kept)").alias("n_pixels"), F.expr("first(mid)").alias("value"), F.expr(f"first({SCATTER})").alias("sigma"))


def without_bright(pixels: DataFrame, base: str, out: str, rounds: int = ROUNDS) -> DataFrame:
    """``out``: base pixels within CLIP scatters of the median, both re-estimated from what each round keeps but always applied to the whole base."""
    columns, state = pixels.columns, pixels.withColumn(out, F.col(base))
    for _ in range(rounds):
        calm = f"if({SCATTER} > 0, {base} and abs(value - mid) <= {CLIP} * {SCATTER}, {out}) as {out}"
        state = _with_middle(state, "value", out).selectExpr(*columns, calm)
    return state


def plane_or_fallback(masked: DataFrame, x0: float, y0: float) -> DataFrame:
    """clipped_plane() rows with ``method``: the plane through the background mask where it holds, else one through all sound pixels outside the target that aren't bright, else failed.

    Only images whose first plane failed go through the second.
    """
    first = clipped_plane(masked, "background", x0, y0).withColumn("method", F.lit("plane"))
    good = first.filter("ok")
    failed = masked.join(good.select("image_id"), "image_id", "left_anti").withColumn("sound", F.col("fit") & ~F.col("protected"))
    second = clipped_plane(without_bright(failed, "sound", "calm"), "calm", x0, y0).withColumn("method", F.when(F.col("ok"), "image_clipped").otherwise("failed"))
    return good.unionByName(second)
