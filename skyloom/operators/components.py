"""8-connected components of masked pixels, their summaries, and the strongest of an image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.operators.images import connected_pixels


def connected_components(pixels: DataFrame, width: int) -> DataFrame:
    """``image_id, y, x, component``: each masked pixel with the first pixel (``y * width + x``) of its component.

    Components never reach beyond an image, so every image's places are brought together once and labelled there.
    """
    return connected_pixels(pixels.select("image_id", "y", "x").distinct(), width)


def summarize(members: DataFrame, x0: float, y0: float) -> DataFrame:
    """One row per component of ``image_id, component, y, x, value, variance``.

    Area, peak (the first in row order on ties), centroid weighted by signal to noise, summed signal to noise, and
    distance from a place.
    """
    m = members.withColumn("snr", F.col("value") / F.sqrt("variance")).withColumn("w", F.greatest(F.col("snr"), F.lit(0.0)))
    mean = lambda c: F.coalesce(F.sum(F.col(c) * F.col("w")) / F.nullif(F.sum("w"), F.lit(0.0)), F.avg(c))
    first_best = F.struct(F.col("snr"), -F.col("y"), -F.col("x"))
    out = m.groupBy("image_id", "component").agg(
        F.count(F.lit(1)).alias("area"), F.max_by("x", first_best).alias("peak_x"), F.max_by("y", first_best).alias("peak_y"), F.max("snr").alias("peak_snr"),
        mean("x").alias("centroid_x"), mean("y").alias("centroid_y"), (F.sum("value") / F.sqrt(F.sum("variance"))).alias("total_snr"),
    )
    return out.withColumn("distance", F.hypot(F.col("centroid_x") - x0, F.col("centroid_y") - y0))


def strongest(components: DataFrame, k: int) -> DataFrame:
    """The k components of each image with the highest peaks, ranked; ties go to the first in row order."""
    w = Window.partitionBy("image_id").orderBy(F.desc("peak_snr"), "component")
    return components.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def merge_nearby(components: DataFrame, radius: float) -> DataFrame:
    """``kept``: false for a component within the radius of an earlier one that is kept, in the order of their first pixels.

    Which are kept depends on those before, so each image's short list is folded in order.
    """
    lists = components.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("component", "centroid_x", "centroid_y"))).alias("items"))
    near = lambda kept, s: F.exists(kept, lambda k: F.hypot(k.centroid_x - s.centroid_x, k.centroid_y - s.centroid_y) <= radius)
    start = F.slice(F.col("items"), 1, 0)
    kept = F.aggregate("items", start, lambda acc, s: F.when(near(acc, s), acc).otherwise(F.array_append(acc, s)))
    names = lists.select("image_id", F.transform(kept, lambda s: s.component).alias("names"))
    return components.join(names, "image_id").withColumn("kept", F.array_contains("names", F.col("component"))).drop("names")
