"""Catalogue rows: column mapping, normalised ids, row checks, and positions that nearly coincide."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.functions.identity import json_real, json_text, json_truth, json_whole, stable_hash, texts
from skyloom.functions.scalars import trimmed
from skyloom.operators.reports import digest
from skyloom.operators.upsert import retire, upsert, upsert_counts
from skyloom.session import cut_lineage, maybe_broadcast

# Names under which catalogues give a field, in order of preference.
COLUMN_NAMES = {
    "source_id": ("source_id", "sourceid", "Name", "name", "object_id", "objid", "ID", "id"),
    "source_name": ("source_name", "source", "Name", "name", "object_name", "objname", "tns_name"),
    "ra_deg": ("ra_deg", "RA_deg", "radeg", "RAJ2000_deg", "RAJ2000", "ra", "RA"),
    "dec_deg": ("dec_deg", "DEC_deg", "dedeg", "DEJ2000_deg", "DEJ2000", "dec", "DEC", "Dec"),
    "cutout_size_arcsec": ("cutout_size_arcsec", "cutout_arcsec", "size_arcsec", "cutout_size"),
    "source_type": ("source_type", "Obj. Type", "object_type", "obj_type", "type", "Type"),
    "priority": ("priority", "Priority"),
    "active": ("active", "Active"),
    "notes": ("notes", "Notes", "Remarks", "remarks", "comment", "comments"),
}
NEEDED = ("source_id", "source_name", "ra_deg", "dec_deg")
# Words read as true or false.
TRUE_WORDS, FALSE_WORDS = ("1", "true", "t", "yes", "y"), ("0", "false", "f", "no", "n")
SIZE_LIMITS = (6.0, 3600.0)


def fold(name: str) -> str:
    """A column name in lower case without anything but letters and digits."""
    return re.sub(r"[^0-9a-z]", "", name.lower())


def map_columns(columns: Sequence[str], names: dict[str, Sequence[str]] = COLUMN_NAMES) -> dict[str, str]:
    """Field to column: an exact name first, in order of preference, then the same folded; of columns that fold to one name the last counts."""
    folded = {fold(c): c for c in columns}
    found = {}
    for field, candidates in names.items():
        hit = next((c for c in candidates if c in columns), None) or next((folded[fold(c)] for c in candidates if fold(c) in folded), None)
        if hit:
            found[field] = hit
    return found


def normal_id(c: Column | str) -> Column:
    """White space and other signs become single underscores; null where nothing is left."""
    text = F.regexp_replace(F.regexp_replace(trimmed(c), r"\s+", "_"), r"[^A-Za-z0-9_.:-]+", "_")
    return F.nullif(F.btrim(text, F.lit("_")), F.lit(""))


def flag(c: Column | str, default: bool = True) -> Column:
    word = F.lower(trimmed(F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(default)


def row_hash(df: DataFrame) -> Column:
    """Identity of a normalised row; positions to ten decimals, sizes to four."""
    extra = F.coalesce(F.nullif("extra_json", F.lit("")), F.lit("{}")) if "extra_json" in df.columns else F.lit("{}")
    rounded = {"ra_deg": json_real("ra_deg", 10), "dec_deg": json_real("dec_deg", 10), "cutout_size_arcsec": json_real("cutout_size_arcsec", 4)}
    return stable_hash(texts("source_id", "source_name", "source_type") | rounded | {"priority": json_whole("priority"), "active": json_truth("active"), "extra_json": json_text(extra)})


def missing_columns(columns: Sequence[str], needed: Sequence[str] = NEEDED, mapping: dict[str, str] | None = None) -> list[str]:
    """Needed fields for which a table has no column."""
    m = map_columns(columns) if mapping is None else mapping
    return [f for f in needed if m.get(f) not in columns]


def normalize(df: DataFrame, mapping: dict[str, str] | None = None, position: Column | None = None) -> DataFrame:
    """The catalogue's fields under fixed names, ids normalised, all other columns kept as JSON, and a row hash.

    The id falls back to the normalised name and, where the row's ``position`` in its input is given (from 1), to a
    number made of it; rows without any of these keep a null id and fail the row checks.
    """
    m = map_columns(df.columns) if mapping is None else mapping
    take = lambda f, kind: (F.col(f"`{m[f]}`") if f in m else F.lit(None)).try_cast(kind)
    rest = [c for c in df.columns if c not in m.values()]
    ids = [normal_id(take("source_id", "string")), normal_id(take("source_name", "string")), *([F.format_string("SRC_%06d", position)] if position is not None else [])]
    out = df.select(
        F.coalesce(*ids).alias("source_id"),
        F.nullif(trimmed(take("source_name", "string")), F.lit("")).alias("source_name"),
        take("ra_deg", "double").alias("ra_deg"), take("dec_deg", "double").alias("dec_deg"), take("cutout_size_arcsec", "double").alias("cutout_size_arcsec"),
        F.nullif(trimmed(take("source_type", "string")), F.lit("")).alias("source_type"), take("priority", "int").alias("priority"), flag(take("active", "string")).alias("active"),
        (F.to_json(F.struct(*(F.col(f"`{c}`") for c in rest))) if rest else F.lit("{}")).alias("extra_json"),
    )
    return out.withColumn("row_hash", row_hash(out))


def row_errors(unique_ids: bool = True) -> Column:
    """All that is wrong with a normalised row, as an array of reasons; empty for a valid row."""
    within = lambda c, low, high, closed: F.col(c).isNotNull() & ~F.isnan(c) & (F.col(c) >= low) & ((F.col(c) <= high) if closed else (F.col(c) < high))
    size = F.col("cutout_size_arcsec")
    checks = [
        F.when(F.col("source_id").isNull(), "missing_id"),
        F.when(F.col("source_name").isNull(), "missing_name"),
        F.when(~within("ra_deg", 0.0, 360.0, False), "bad_ra"),
        F.when(~within("dec_deg", -90.0, 90.0, True), "bad_dec"),
        F.when(size.isNotNull() & ~F.isnan(size) & ~size.between(*SIZE_LIMITS), "bad_size"),
    ]
    if unique_ids:
        checks.append(F.when(F.col("id_count") > 1, "duplicate_id"))
    return F.array_compact(F.array(*checks))


def checked(df: DataFrame) -> DataFrame:
    """Normalised rows with ``errors``; every row of a repeated id is marked.

    Counts are made per id before they meet the rows, so that an id that holds most rows is no large group.
    """
    counts = df.groupBy("source_id").agg(F.count(F.lit(1)).alias("id_count")).filter("source_id is not null and id_count > 1")
    # ids that are given more than once are the exception; where they are few the rows themselves are not shuffled
    return df.join(maybe_broadcast(counts), "source_id", "left").withColumn("errors", row_errors()).drop("id_count")


def duplicate_ids(df: DataFrame) -> DataFrame:
    """Ids that a catalogue gives more than once, and ``(blank)`` for rows without one, with their row counts."""
    ids = df.groupBy(F.coalesce(F.nullif(trimmed("source_id"), F.lit("")), F.lit("(blank)")).alias("source_id")).agg(F.count(F.lit(1)).alias("n_rows"))
    return ids.filter("n_rows > 1 or source_id = '(blank)'")


def ingest(rows: DataFrame, table: DataFrame, version: Column, now: Column) -> dict[str, DataFrame]:
    """A catalogue's normalised rows taken into the table of sources.

    ``table`` has a row per source_id with the normalised fields, row_hash, catalog_version_id, first_seen_at,
    last_seen_at, retired_at. Gives ``snapshot`` (the rows that are valid, under the version, to be written by version),
    ``errors``, ``table`` after the upsert (first_seen_at is kept, sources that are no longer given are retired) and
    ``version``: the version's row with counts, a digest of the rows, and how many sources are new, updated, unchanged
    and missing. Whoever writes them decides whether errors stop the ingest.
    """
    marked = cut_lineage(checked(rows))
    snapshot = marked.filter(F.size("errors") == 0).drop("errors").withColumn("catalog_version_id", version)
    fresh = snapshot.withColumns({"first_seen_at": now, "last_seen_at": now, "retired_at": F.lit(None).cast("timestamp")}).select(*table.columns)
    after = retire(upsert(table, fresh, ["source_id"], preserve=["first_seen_at"]), fresh, ["source_id"], "active", "retired_at", now)
    given = marked.agg(F.count(F.lit(1)).alias("n_rows_input"), F.count_if(F.size("errors") == 0).alias("n_rows_valid"), F.count_if(F.size("errors") > 0).alias("n_rows_invalid"), digest(F.col("row_hash")).alias("catalog_hash"))
    counts = upsert_counts(table, fresh, ["source_id"], "row_hash")
    row = given.withColumns({c: counts.select(c).scalar() for c in counts.columns}).withColumn("catalog_version_id", version)
    return {"snapshot": snapshot, "errors": marked.filter(F.size("errors") > 0), "table": after, "version": row}


def latest_states(log: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the last in the order, by a maximum that is combined before the shuffle."""
    rest = [c for c in log.columns if c != key and c not in order]
    return log.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("s")).select(key, *(F.col(f"s.{c}").alias(c) for c in log.columns if c != key))


def near_duplicates(df: DataFrame, tolerance_deg: float) -> DataFrame:
    """``id_a, id_b, flat_deg`` of ids whose positions are within a tolerance on the flat sky (RA doesn't wrap here).

    Positions fall into bands of declination as high as the tolerance and, in each band, into cells of right ascension
    as wide as it is there; a position is looked for in the three bands and three cells around it.
    """
    n = math.ceil(180 / tolerance_deg)
    band = lambda d: F.floor((d + 90) / tolerance_deg).cast("int")
    # the widest that the tolerance gets in a band: at its edge nearest to a pole, a tolerance further out
    edge = lambda b: F.least(F.lit(90.0), F.greatest(F.abs(b * tolerance_deg - 90), F.abs((b + 1) * tolerance_deg - 90)) + tolerance_deg)
    width = lambda b: F.least(F.lit(720.0), tolerance_deg / F.greatest(F.cos(F.radians(edge(b))), F.lit(1e-9)))
    p = df.select("source_id", "ra_deg", "dec_deg").dropna().distinct()
    right = p.select(F.col("source_id").alias("id_b"), F.col("ra_deg").alias("ra_b"), F.col("dec_deg").alias("dec_b"), band(F.col("dec_deg")).alias("band"))
    right = right.withColumn("cell", F.floor(F.col("ra_b") / width(F.col("band"))))
    left = p.select("source_id", "ra_deg", "dec_deg", F.explode(F.sequence(F.greatest(band(F.col("dec_deg")) - 1, F.lit(0)), F.least(band(F.col("dec_deg")) + 1, F.lit(n)))).alias("band"))
    mid = F.floor(F.col("ra_deg") / width(F.col("band")))
    left = left.withColumn("cell", F.explode(F.sequence(mid - 1, mid + 1)))
    dra = (F.col("ra_deg") - F.col("ra_b")) * F.cos(F.radians((F.col("dec_deg") + F.col("dec_b")) / 2))
    pairs = left.join(right, ["band", "cell"]).filter("source_id < id_b").withColumn("flat_deg", F.hypot(dra, F.col("dec_deg") - F.col("dec_b"))).filter(F.col("flat_deg") <= tolerance_deg)
    return pairs.groupBy(F.col("source_id").alias("id_a"), "id_b").agg(F.min("flat_deg").alias("flat_deg"))


def first_occurrence(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with ``duplicate``: false for the first of each key in the order, true for the later ones."""
    return df.withColumn("duplicate", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) > 1)
