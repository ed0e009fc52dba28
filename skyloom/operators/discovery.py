"""Product metadata from file names and addresses, and identities of products and cutouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.identity import json_real, json_text, json_whole, stable_hash, texts
from skyloom.functions.scalars import trimmed

# Patterns of the parts of a product's file name; digits are spelt out, since what counts as one differs between engines.
DETECTOR = (r"(?i)(?:^|[_-])(?:D|[0-9]D)([1-6])(?:[_\-.]|$)", r"(?i)D([1-6])")
PERIOD = r"([0-9]{4}W[0-9]{2}[_-][A-Za-z0-9]+)"
VERSION = (r"(?i)(l2[ab]-v[^_\s]+)", r"(?i)(v[0-9]+(?:[.-][0-9]+)*)")
DATE = r"([0-9]{4}[-_][0-9]{3}|[0-9]{8})"
OBSERVATION = r"(?:^|[_-])([0-9]{4,})(?:[_-]|$)"


def first_match(c: Column, *patterns: str) -> Column:
    """The first group of the first pattern that matches, else null."""
    return F.coalesce(*(F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in patterns))


def file_name(url: Column | str) -> Column:
    """The last part of an address's path; null where there is none."""
    path = F.regexp_replace(F.regexp_replace(F.col(url) if isinstance(url, str) else url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.nullif(F.element_at(F.split(path, "/"), -1), F.lit(""))


def stem(name: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def file_metadata(name: Column) -> dict[str, Column]:
    s = stem(name)
    detector = first_match(s, *DETECTOR).cast("int")
    return {
        "detector": detector,
        "band": F.when(detector.isNotNull(), F.concat(F.lit("D"), detector.cast("string"))),
        "period": F.coalesce(first_match(s, PERIOD), F.lit("unknown_period")),
        "version": F.coalesce(first_match(s, *VERSION), F.lit("unknown_version")),
        "date": F.translate(first_match(s, DATE), "_", "-"),
        "observation": first_match(s, OBSERVATION),
    }


def slug(c: Column | str, longest: int = 64) -> Column:
    """A safe name: other signs become underscores; longer ones are cut and end in eight digits of their SHA-1."""
    text = F.btrim(F.regexp_replace(F.regexp_replace(trimmed(c), r"\s+", "_"), r"[^A-Za-z0-9_.:-]+", "_"), F.lit("_"))
    text = F.coalesce(F.nullif(text, F.lit("")), F.lit("unknown"))
    cut = F.concat(F.rtrim(F.substring(text, 1, longest - 9), F.lit("_")), F.lit("_"), F.substring(F.sha1(text), 1, 8))
    return F.when(F.length(text) <= longest, text).otherwise(cut)


def shortest_decimal(c: Column, digits: int = 10) -> Column:
    """A positive number below ten to so many significant digits without trailing zeros, in plain notation."""
    lead = F.greatest(F.lit(0), -F.floor(F.log10(c)).cast("int") - 1)
    text = F.expr("null").cast("string")
    for zeros in range(5, -1, -1):
        text = F.when(lead == zeros, F.format_string(f"%.{digits + zeros}f", c)).otherwise(text)
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def cutout_url(url: Column, ra: Column, dec: Column, size_arcsec: Column) -> Column:
    """An address asked for a part of its image: centre and size in degrees are appended to its query."""
    query = F.format_string("center=%.10f,%.10f&size=%s", ra, dec, shortest_decimal(size_arcsec / 3600))
    return F.when((F.length(url) > 0) & (size_arcsec > 0), F.concat(url, F.when(F.instr(url, "?") > 0, "&").otherwise("?"), query))


# The fields that make a product's identity with and without a publisher's id, a product row's, and a cutout's.
PUBLISHED = ("collection", "obs_publisher_did", "processing_version", "processing_date")
UNPUBLISHED = ("collection", "access_url", "parent_filename", "observation_id", "processing_version", "processing_date")
PRODUCT_ROW = ("collection", "obs_publisher_did", "obs_id", "access_url", "parent_filename", "processing_version", "processing_date")


def product_signature() -> Column:
    """Products with a publisher's id are told apart by it and their version, others by address, file, observation and detector."""
    other = stable_hash(texts(*UNPUBLISHED) | {"detector_id": json_whole("detector_id")})
    return F.when(F.col("obs_publisher_did") != "", stable_hash(texts(*PUBLISHED))).otherwise(other)


def product_row_hash() -> Column:
    return stable_hash(texts(*PRODUCT_ROW))


def cutout_key(source: str, signature: str, ra: str, dec: str, size: str, method: str = "onprem_cutout") -> Column:
    return stable_hash({"source_id": json_text(source), "product_signature": json_text(signature), "ra_deg": json_real(ra, 8), "dec_deg": json_real(dec, 8), "cutout_size_arcsec": json_real(size, 4), "method": json_text(F.lit(method))})


def cutout_file(source: Column, parent: Column, size_arcsec: Column, key: Column) -> Column:
    """A cutout's file name: its source, its parent's name, its size and the first signs of its key."""
    parts = F.concat_ws("__", slug(source), slug(stem(F.coalesce(parent, F.lit("parent"))), 96), F.format_string("sz%.1fas", size_arcsec), F.substring(key, 1, 8))
    return F.concat(parts, F.lit(".fits"))


def cutout_path(root: str, source: Column, collection: Column, period: Column, version: Column, detector: Column, name: Column) -> Column:
    part = lambda c, kind: slug(F.coalesce(F.nullif(c, F.lit("")), F.lit(f"unknown_{kind}")))
    return F.concat_ws("/", F.lit(root), F.lit("cutouts"), slug(source), collection, part(period, "period"), part(version, "version"), F.concat(F.lit("D"), F.coalesce(detector.cast("string"), F.lit("unknown"))), name)


# Names under which services give the fields of a product row, beside the field's own.
ALIASES = {"access_url": ("access_url", "accessUrl", "access_url ")}
# The fields of a product row and their kinds.
PRODUCT_FIELDS = {
    "s_ra": "double", "s_dec": "double", "obs_collection": "string", "obs_id": "string", "obs_publisher_did": "string", "energy_bandpassname": "string", "em_min": "double", "em_max": "double", "em_res_power": "double",
    "t_min": "double", "t_max": "double", "t_exptime": "double", "access_url": "string", "access_format": "string", "access_estsize": "bigint", "cloud_access": "string", "s_region": "string", "s_pixel_scale": "double", "dist_to_point": "double",
}


def field(columns: list[str], *names: str) -> Column:
    """The first of some names that a table has, as it stands or in any letter case; else null."""
    lower = {c.lower(): c for c in columns}
    found = next((n if n in columns else lower[n.lower()] for n in names if n in columns or n.lower() in lower), None)
    return F.col(f"`{found}`") if found is not None else F.lit(None)


def clean(c: Column) -> Column:
    """A cell's text; masked, missing and not-a-number cells are null."""
    text = c.cast("string")
    return F.when(~F.lower(F.trim(text)).isin("", "nan", "<na>", "none", "--"), text)


def cloud_access(c: Column) -> Column:
    """A cell that should hold a JSON object: the object, another JSON value under ``value``, other text under ``raw``, an empty object for nothing."""
    text = F.trim(c)
    parsed = F.try_parse_json(text)
    kind = F.schema_of_variant(parsed)
    return F.when(text.isNull() | (text == ""), "{}").when(parsed.isNull(), F.concat(F.lit('{"raw":'), json_text(text), F.lit("}"))).when(kind.startswith("OBJECT"), F.to_json(parsed)).otherwise(F.concat(F.lit('{"value":'), F.to_json(parsed), F.lit("}")))


def normalize_products(df: DataFrame, source_id: Column, collection: Column) -> DataFrame:
    """Rows of a search service as product rows: fields under fixed names whatever their letter case, metadata from the file name, identities.

    A field the service doesn't give is null, a cell that is not of its field's kind too. All cells are kept as JSON.
    """
    cell = {f: clean(field(df.columns, *ALIASES.get(f, (f,)))) for f in PRODUCT_FIELDS}
    raw = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(df.columns))), {"ignoreNullFields": "false"}) if df.columns else F.lit("{}")
    out = df.select(
        source_id.alias("source_id"), collection.alias("collection"), *(cell[f].try_cast(k).alias(f) for f, k in PRODUCT_FIELDS.items() if f != "cloud_access"),
        cloud_access(cell["cloud_access"]).alias("cloud_access_json"), raw.alias("raw_json"), file_name(cell["access_url"]).alias("parent_filename"),
    )
    m = file_metadata(F.col("parent_filename"))
    out = out.withColumns({"planning_period": m["period"], "observation_id": F.coalesce(F.nullif("obs_id", F.lit("")), m["observation"]), "detector_id": m["detector"], "bandpass": F.coalesce(m["band"], "energy_bandpassname"), "processing_version": m["version"], "processing_date": m["date"]})
    return out.withColumns({"product_signature": product_signature(), "row_hash": product_row_hash()})


def match_rows(products: DataFrame, known: DataFrame, radius_deg: float) -> DataFrame:
    """Product rows found for sources with the known products' ids (null where a signature is not known), and an identity of the match."""
    ids = known.groupBy("product_signature").agg(F.max("product_id").alias("product_id"))
    out = products.select("source_id", "collection", "product_signature", "dist_to_point").join(ids, "product_signature", "left")
    match = stable_hash({"source_id": json_text("source_id"), "product_id": json_whole("product_id"), "search_radius_deg": json_real(F.lit(radius_deg), 12), "collection": json_text("collection")})
    return out.withColumns({"search_radius_deg": F.lit(radius_deg), "coverage_status": F.lit("covered"), "match_hash": match})


def from_fields(df: DataFrame, field_names: list[str]) -> DataFrame:
    """Rows of text cells (``cells array<string>``) under their field names; a later cell is null where a row is short."""
    return df.select(*(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(field_names)))
