"""Best calibration product per kind and detector, and whether each product of the survey has all it needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def best_products(calibrations: DataFrame) -> DataFrame:
    """One row per release, type and detector: the valid product validated last, ties to the smaller id."""
    valid = calibrations.filter("validated_at is not null")
    last = F.max(F.col("validated_at")).over(Window.partitionBy("release", "calibration_type", "detector_id"))
    kept = valid.withColumn("last", last).filter("validated_at = last")
    return kept.groupBy("release", "calibration_type", "detector_id", "validated_at").agg(F.min(F.struct("calibration_id", "local_path")).alias("b")).select("release", "calibration_type", "detector_id", "validated_at", "b.*")


def best_for_dates(needed: DataFrame, calibrations: DataFrame) -> DataFrame:
    """The product of each ``release, calibration_type, detector_id, processing_date`` that is needed: of the same date if there is one, then the one validated last, then the smaller id.

    ``calibrations`` has ``calibration_date`` beside its own columns; those not validated don't count. What has no product comes out without one.
    """
    keys = ["release", "calibration_type", "detector_id"]
    valid = calibrations.filter("validated_at is not null").select(*keys, "calibration_id", "calibration_date", "validated_at")
    met = needed.distinct().join(valid, keys, "left")
    other = F.when(F.col("calibration_date").eqNullSafe(F.col("processing_date")), 0).otherwise(1)
    # a larger time comes first, so the best is the largest of what is turned around in the others
    best = F.min_by("calibration_id", F.struct(other, -F.unix_micros(F.col("validated_at").cast("timestamp")), F.col("calibration_id")))
    return met.groupBy(*keys, "processing_date").agg(best.alias("calibration_id"))


def required(detectors: DataFrame, types: Sequence[str], release: str) -> DataFrame:
    """Every detector with every needed type; the types are a short list from the settings."""
    return detectors.select("detector_id", F.explode(F.array(*map(F.lit, types))).alias("calibration_type")).withColumn("release", F.lit(release))


def missing(needed: DataFrame, best: DataFrame) -> DataFrame:
    return needed.join(best, ["release", "calibration_type", "detector_id"], "left_anti")


def resolve(needed: DataFrame, best: DataFrame) -> DataFrame:
    """Per release and detector: whether all types are there, the ids in the types' order, and the types that are missing."""
    joined = needed.join(best.select("release", "calibration_type", "detector_id", "calibration_id"), ["release", "calibration_type", "detector_id"], "left")
    return joined.groupBy("release", "detector_id").agg(
        F.bool_and(F.col("calibration_id").isNotNull()).alias("complete"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("calibration_type", "calibration_id"))), lambda s: F.coalesce(s.calibration_id, F.lit("-"))), ";").alias("calibration_ids"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("calibration_id").isNull(), F.col("calibration_type")))), ";").alias("missing"),
    )
