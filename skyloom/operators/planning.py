"""Relational readers of the survey's tables: which products sources want, what was done, what is left, and which calibration a record names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.identity import json_text, json_whole, stable_hash, texts
from skyloom.operators.discovery import first_match
from skyloom.operators.upsert import last_per_key, upsert

LAST_PRIORITY = 999_999
# Names under which a record names its calibrations, in order of preference.
REFERENCE_NAMES = {
    "spectral_wcs": ("spectral_wcs_calibration_id", "spectral_wcs_sha256", "spectral_wcs_filename", "WCS_CALID", "CWAVE_CALID"),
    "solid_angle_pixel_map": ("solid_angle_calibration_id", "solid_angle_sha256", "solid_angle_filename", "SAPM_CALID", "SOLIDANG"),
}
# Patterns of a calibration's version in its path and in its file's name, of a file's version and of its date.
CALIBRATION_VERSION, FILE_VERSION = r"(cal-[A-Za-z0-9_.-]+-v[A-Za-z0-9_.-]+-\d{4}[-_]?\d{3})", r"(?i)(v\d+(?:[_.-]\d+)*)"
SORT_VERSION, SORT_DATE = r"-v(\d+)", r"(\d{4}-\d{3})"


def priority_rank(c: Column | str = "priority") -> Column:
    """The order of priorities, null last."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(LAST_PRIORITY))


def active_sources(states: DataFrame, ids: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """Active sources, of the given ids where there are any, by priority and id; ``limit`` is the reader's own."""
    out = states.filter(F.col("active").cast("int") == 1)
    if ids:
        out = out.filter(F.col("source_id").isin(list(ids)))
    return out.orderBy(priority_rank(), "source_id").limit(limit) if limit is not None else out


def by_id_or_name(states: DataFrame, source_id: str | None = None, name: str | None = None) -> DataFrame:
    """The source of an id, active or not, or the active ones of a name."""
    if source_id is not None:
        return states.filter(F.col("source_id") == source_id)
    return states.filter((F.col("source_name") == name) & (F.col("active").cast("int") == 1))


def effective_size(c: Column | str, default: float, low: float = 6.0, high: float = 3600.0) -> Column:
    """A row's own size or the default; an error for one out of range."""
    size = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))
    return F.when(size.between(low, high), size).otherwise(F.raise_error(F.concat(F.lit("size out of range: "), size.cast("string"))).cast("double"))


def candidates(matches: DataFrame, sources: DataFrame, products: DataFrame) -> DataFrame:
    """Matches with their active source and their product."""
    return matches.join(active_sources(sources), "source_id").join(products, "product_id")


def work_items(plan: DataFrame, sources: DataFrame, products: DataFrame, calibrations: DataFrame, measured: DataFrame) -> DataFrame:
    """Every planned pair of source and product with what is known of both, the calibrations of the product's detector, and whether it was measured.

    ``calibrations`` has a row per detector, ``measured`` one per pair; nothing that is missing on the right drops a planned pair.
    """
    out = plan.join(sources, "source_id", "left").join(products, "product_id", "left").join(calibrations, "detector_id", "left")
    done = measured.select("source_id", "product_id", *(c for c in measured.columns if c not in ("source_id", "product_id")), F.lit(True).alias("measured"))
    return out.join(done, ["source_id", "product_id"], "left").withColumn("measured", F.coalesce("measured", F.lit(False)))


def calibrations_by_detector(best: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """One row per detector, a column per kind with the id of its best product."""
    return best.groupBy("detector_id").agg(*(F.max(F.when(F.col("calibration_type") == k, F.col("calibration_id"))).alias(f"{k}_id") for k in kinds))


def left_over(plan: DataFrame, completed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Planned rows that are not completed."""
    return plan.join(completed.select(*keys).distinct(), list(keys), "left_anti")


def with_fallback(primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary rows, and those of the fallback for keys that the primary lacks."""
    return primary.unionByName(left_over(fallback, primary, keys))


def first_failures(failures: DataFrame, open_ones: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The failures to record: the first of each key that has none open."""
    rest = [c for c in failures.columns if c not in keys and c not in order]
    first = failures.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("f")).select(*keys, "f.*")
    return left_over(first.select(*failures.columns), open_ones, keys)


def of_run(rows: DataFrame, run: Column, statuses: Sequence[str] | None = None, column: str = "photometry_run_id") -> DataFrame:
    """Rows of a run, of all runs for a null one; of some statuses where they are given."""
    out = rows.filter(run.isNull() | F.col(column).eqNullSafe(run))
    return out.filter(F.col("detection_status").isin(list(statuses))) if statuses else out


def latest_run(rows: DataFrame, column: str, order: str) -> Column:
    """The run of the last row, as a scalar."""
    return rows.agg(F.max(F.struct(order, column)).alias("r")).select(F.col(f"r.{column}")).scalar()


def merged_counters(parts: DataFrame, sums: Sequence[str], largest: Sequence[str]) -> DataFrame:
    """Counters of many parts as one row: sums, and maxima where the largest counts."""
    return parts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums), *(F.max(c).alias(c) for c in largest))


def key_flags(flags: Column, n: int = 8) -> Column:
    """The first n distinct flags of a list."""
    return F.slice(F.array_distinct(flags), 1, n)


def detector_list(text: Column) -> Column:
    """Detector numbers of a text like ``D3, 4``."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.ltrim(F.upper(F.trim(x)), F.lit("D")).try_cast("int")), lambda x: x.isNotNull())


def calibration_version(path: Column | str) -> Column:
    c = F.col(path) if isinstance(path, str) else path
    stem = F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"(?<=.)\.[^.]*$", "")
    return F.coalesce(F.translate(first_match(c, CALIBRATION_VERSION), "_", "-"), first_match(stem, FILE_VERSION))


def version_key(name: Column | str) -> Column:
    """What files and folders of several versions are ordered by: date, number of the version, name."""
    c = F.col(name) if isinstance(name, str) else name
    return F.struct(F.regexp_extract(c, SORT_DATE, 1).alias("date"), F.coalesce(first_match(c, SORT_VERSION).cast("bigint"), F.lit(0)).alias("version"), c.alias("name"))


def latest_versions(entries: DataFrame, name: str, groups: Sequence[str]) -> DataFrame:
    """The entry of the latest version in each group."""
    rest = [c for c in entries.columns if c not in groups]
    return entries.groupBy(*groups).agg(F.max_by(F.struct(*rest), version_key(name)).alias("e")).select(*groups, "e.*")


def detector_files(listing: DataFrame, product: str) -> DataFrame:
    """The latest FITS file of each detector in a listing of ``name, size``; files without a size are not there yet."""
    number = first_match(F.col("name"), rf"^{product}_D([0-9]+)_")
    return latest_versions(listing.withColumn("detector_id", number.cast("int")).filter("detector_id is not null and size is not null and lower(name) like '%.fits'"), "name", ["detector_id"])


def same_size(path_size: Column, expected: Column) -> Column:
    """Whether a file that is there is the one expected: not empty, and of the expected size where that is known."""
    return F.coalesce((path_size > 0) & (expected.isNull() | (path_size == expected)), F.lit(False))


def references(columns: Sequence[str]) -> dict[str, Column]:
    """The calibration a record names for each kind: the first of its names that the record has a value for."""
    out = {}
    for kind, names in REFERENCE_NAMES.items():
        held = [F.nullif(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names if n in columns]
        out[kind] = F.coalesce(*held) if held else F.lit(None).cast("string")
    return out


def referenced_calibrations(refs: DataFrame, calibrations: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``reference, calibration_id``: calibrations of which one of the fields is the reference or contains it.

    A part of a field that is as long as some reference is a possible match, so the parts of the (few) calibrations'
    fields of those lengths meet the references by equality.
    """
    wanted = refs.select("reference").filter("reference != ''").distinct().withColumn("n", F.length("reference"))
    lengths = wanted.agg(F.array_sort(F.collect_set("n")).alias("l")).select("l").scalar()
    held = calibrations.select("calibration_id", F.explode(F.array_compact(F.array(*(F.col(f).cast("string") for f in fields)))).alias("text")).withColumn("n", F.explode(lengths)).filter(F.col("n") <= F.length("text"))
    parts = held.withColumn("at", F.explode(F.sequence(F.lit(1), F.length("text") - F.col("n") + 1))).select("calibration_id", F.expr("substring(text, at, n)").alias("reference")).distinct()
    return wanted.select("reference").join(parts, "reference")


def calibration_id(columns: Sequence[str]) -> Column:
    """Identity of a calibration file."""
    text = lambda c: json_text(c) if c in columns else F.lit("null")
    names = ("product_type", "calibration_version", "processing_date", "sha256", "relative_path")
    return stable_hash({n: text(n) for n in names} | {"release": json_text(F.lower("release")), "detector_id": json_whole("detector_id")})


def measurement_id(config_hash: str, code_version: str, schema_version: str) -> Column:
    """Identity of a measurement: its source, cutout and calibrations, and the settings it was made with."""
    made = {"photometry_config_hash": config_hash, "code_version": code_version, "output_schema_version": schema_version}
    return stable_hash(texts("source_id", "cutout_key", "cutout_sha256", "spectral_wcs_calibration_id", "solid_angle_calibration_id") | {k: json_text(F.lit(v)) for k, v in made.items()})


def register_calibrations(table: DataFrame, files: DataFrame) -> DataFrame:
    """Calibration files taken into their table: all are active, a source address that is not given is kept."""
    fresh = last_per_key(files, ["calibration_id"], ["validated_at"]).withColumn("active", F.lit(True))
    return upsert(table, fresh, ["calibration_id"], coalesce=["source_url"])


def upsert_matches(table: DataFrame, found: DataFrame) -> DataFrame:
    """Matches found again are active again and keep when they were first seen; a pair counts once."""
    keys = ["source_id", "product_id"]
    fresh = last_per_key(found, keys, ["last_seen_at"]).withColumns({"first_seen_at": F.col("last_seen_at"), "active": F.lit(True)})
    return upsert(table, fresh, keys, preserve=["first_seen_at"])


def validation_states(history: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last validation of each key; a passed one has no reason of failure."""
    last = last_per_key(history, [key], order)
    return last.withColumn("failure_reason", F.when(F.col("status") != "passed", F.col("failure_reason")))
