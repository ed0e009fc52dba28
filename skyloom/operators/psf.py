"""Point-spread functions: the nearest zone to a place, and binning of an oversampled plane into pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


WHOLE = 0.98  # a smaller sum within the stamp is a truncated function


def nearest_zone(places: DataFrame, zones: DataFrame, key: str) -> DataFrame:
    """Each place's nearest zone of its own detector; ties go to the zone with the lower number.

    ``places`` has the key, ``detector_id, x, y``; ``zones`` has ``detector_id, zone, zx, zy``: a detector has a fixed
    grid of zones, so a place meets few.
    """
    met = places.join(zones, "detector_id").withColumn("d2", F.pow(F.col("x") - F.col("zx"), 2) + F.pow(F.col("y") - F.col("zy"), 2))
    best = F.min(F.struct("d2", "zone"))
    return met.groupBy(key).agg(best.alias("b")).select(key, F.col("b.zone").alias("zone"), F.col("b.d2").alias("d2"))


def normalized(plane: Column, total: Column) -> Column:
    """A plane's cell without negative and not finite parts, as a share of the total."""
    return F.greatest(F.coalesce(F.nanvl(plane, F.lit(0.0)), F.lit(0.0)), F.lit(0.0)) / total


def bin_plane(cells: DataFrame, size: int, x0: float | Column, y0: float | Column, oversampling: int, radius: int, width: int, height: int) -> DataFrame:
    """``image_id, y, x, weight``: oversampled cells (``image_id, py, px, p``) summed into the pixels they fall in."""
    mid = (size - 1) / 2
    x = F.floor(x0 + (F.col("px") - mid) / oversampling + 0.5).cast("int")
    y = F.floor(y0 + (F.col("py") - mid) / oversampling + 0.5).cast("int")
    placed = cells.select(*(c for c in cells.columns if c not in ("py", "px")), y.alias("y"), x.alias("x"))
    inside = F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1) & (F.abs(F.col("x") - x0) <= radius + 0.5) & (F.abs(F.col("y") - y0) <= radius + 0.5)
    return placed.filter(inside).groupBy("image_id", "y", "x").agg(F.sum("p").alias("weight"))


def render(places: DataFrame, zones: DataFrame, planes: DataFrame, size: int, oversampling: int, radius: int, width: int, height: int) -> DataFrame:
    """``image_id, y, x, weight`` of the function at each place: the plane of the nearest zone, without negative and not finite cells, of unit sum, summed into pixels about the place on the image.

    ``places`` has ``image_id, detector_id, x, y`` on the detector and ``cutout_x, cutout_y`` on the image; ``planes``
    has a row ``detector_id, zone, py, px, p`` per cell. What falls beyond the stamp is lost, nothing is scaled up for it.
    """
    clean = planes.withColumn("p", F.greatest(F.coalesce(F.nanvl("p", F.lit(0.0)), F.lit(0.0)), F.lit(0.0)))
    totals = clean.groupBy("detector_id", "zone").agg(F.sum("p").alias("total")).filter("total > 0")
    unit = clean.join(totals, ["detector_id", "zone"]).withColumn("p", F.col("p") / F.col("total"))
    cells = places.join(nearest_zone(places, zones, "image_id").select("image_id", "zone"), "image_id").join(unit, ["detector_id", "zone"])
    return bin_plane(cells.select("image_id", "py", "px", "p", "cutout_x", "cutout_y"), size, F.col("cutout_x"), F.col("cutout_y"), oversampling, radius, width, height)


def sample_map(places: DataFrame, grid: DataFrame, width: int, height: int) -> DataFrame:
    """Places with the map's values at their rounded (half to even) and clipped coordinates."""
    at = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.rint(c).cast("int")))
    return places.withColumn("gx", at("x", width)).withColumn("gy", at("y", height)).join(grid, ["detector_id", "gy", "gx"], "left")
