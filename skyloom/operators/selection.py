"""Detection status and scientific use of forced measurements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

THRESHOLD = 3.0


def detection_status(flux: Column, err: Column, threshold: float = THRESHOLD) -> Column:
    bad = flux.isNull() | err.isNull() | F.isnan(flux) | F.isnan(err) | (F.abs(flux) == float("inf")) | (err == float("inf")) | (err <= 0)
    return F.when(bad, "invalid_fit").when(flux < 0, "negative_flux").when(flux / err < threshold, "non_detection").otherwise("detected")


def upper_limit(err: Column, sigmas: float = 3.0) -> Column:
    """So many errors; NaN where the error is not finite."""
    return F.when(err.isNull() | F.isnan(err) | (F.abs(err) == float("inf")), float("nan")).otherwise(sigmas * err)


def flag_list(flags: Column) -> Column:
    """Distinct flags of a text separated by semicolons, in their first order, without blanks."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(flags, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != ""))


def blocking(flags: Column, harmless: list[str]) -> Column:
    return F.array_except(flags, F.array(*map(F.lit, harmless)).cast("array<string>"))
