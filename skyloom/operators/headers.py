"""Header cards of image files as maps: world-coordinate cards, metadata, and what the headers say of the point-spread function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.functions.identity import json_text

# Which cards belong to alternate or spectral coordinates, to the sky coordinates of the image, and to its distortion.
ALTERNATE = r"^(WCSAXES|CTYPE|CRVAL|CRPIX|CDELT|CUNIT|CNAME|CD|PC|PV|PS|LONPOLE|LATPOLE).*[AW]$"
PRIMARY = r"^(WCSAXES|WCSNAME|RADESYS|EQUINOX|LONPOLE|LATPOLE|NAXIS[12]?|(CTYPE|CRVAL|CRPIX|CDELT|CUNIT)[12]|(CD|PC)[12]_[12]|(PV|PS)[12].*)$"
DISTORTION = r"^((A|B|AP|BP)_ORDER|(A|B|AP|BP)_[0-9]+_[0-9]+)$"
# Units of a file and cards that describe it.
METADATA_UNITS = ("PRIMARY", "IMAGE", "PSF")
METADATA_CARDS = ("OBSID", "OBS_ID", "DETECTOR", "DETID", "VERSION", "PROCVER", "PROCDATE", "DATE-OBS", "MJD", "MJD-AVG", "EXPID", "BAND", "CRPIX1", "CRPIX2", "CRPIX1A", "CRPIX2A")
# The last version whose centres are filed in another order, and the mark of files in which that is mended.
LAST_UNMENDED, MENDED = (6, 5, 5), "psffix1"


def _card(cards: Column | str, *names: str) -> Column:
    """The first of some cards that a header has."""
    m = F.col(cards) if isinstance(cards, str) else cards
    return F.coalesce(*(F.try_element_at(m, F.lit(n)) for n in names))


def is_alternate(key: Column) -> Column:
    return F.upper(key).rlike(ALTERNATE)


def is_spatial(key: Column) -> Column:
    return F.upper(key).rlike(PRIMARY) | F.upper(key).rlike(DISTORTION)


def spatial_cards(cards: Column | str) -> Column:
    """The cards of an image's sky coordinates and distortion on two axes; alternate and spectral ones are dropped."""
    m = F.col(cards) if isinstance(cards, str) else cards
    kept = F.map_filter(m, lambda k, v: ~is_alternate(k) & is_spatial(k) & ~F.upper(k).isin("NAXIS", "WCSAXES"))
    two = F.map_filter(F.map_from_arrays(F.array(F.lit("NAXIS"), F.lit("WCSAXES")), F.array(F.lit("2"), F.lit("2"))), lambda k, v: (k == "WCSAXES") | F.map_contains_key(m, "NAXIS"))
    return F.map_concat(kept, two)


def dropped_cards(cards: Column | str) -> Column:
    """Names of the alternate cards, in their order by name."""
    m = F.col(cards) if isinstance(cards, str) else cards
    return F.array_sort(F.map_keys(F.map_filter(m, lambda k, v: is_alternate(k))))


def metadata(hdus: DataFrame) -> DataFrame:
    """``path, metadata``: the describing cards of each file's units, as ``unit.CARD``; of units of one name the first counts."""
    named = hdus.withColumn("unit", F.when(F.col("hdu") == 0, "PRIMARY").otherwise(F.upper("name"))).filter(F.col("unit").isin(*METADATA_UNITS))
    first = named.groupBy("path", "unit").agg(F.min_by("cards", "hdu").alias("cards"))
    wanted = F.map_filter("cards", lambda k, v: k.isin(*METADATA_CARDS))
    pairs = first.select("path", F.transform(F.map_entries(F.transform_keys(wanted, lambda k, v: F.concat(F.lower("unit"), F.lit("."), k))), lambda e: e).alias("e"))
    return pairs.groupBy("path").agg(F.map_from_entries(F.array_sort(F.flatten(F.collect_list("e")))).alias("metadata"))


def metadata_value(row: Column | str, header: Column | str, names: list[str]) -> Column:
    """The first of some names that has a value, looked for in the row and then in the header."""
    return F.coalesce(*(x for n in names for x in (_card(row, n), _card(header, n))))


def oversampling(cards: Column | str, default: int) -> Column:
    """How finely the function is sampled, at least once a pixel; the default where the header doesn't say."""
    return F.greatest(F.lit(1), F.coalesce(F.rint(F.try_element_at(F.col(cards) if isinstance(cards, str) else cards, F.lit("OVERSAMP")).try_cast("double")).cast("int"), F.lit(default)))


def _centre(cards: Column, prefix: str, i: Column) -> Column:
    text = i.cast("string")
    names = (F.concat(F.lit(f"{prefix}_"), text), F.concat(F.lit(prefix), text), F.concat(F.lit(prefix), F.lpad(text, 2, "0")))
    return F.coalesce(*(F.try_element_at(cards, n) for n in names))


def header_centres(cards: Column | str, planes: Column) -> Column:
    """Centres ``x, y`` in the headers' order; planes without both are left out."""
    m = F.col(cards) if isinstance(cards, str) else cards
    at = F.when(planes > 0, F.sequence(F.lit(1), planes)).otherwise(F.array().cast("array<int>"))
    both = F.transform(at, lambda i: F.struct(_centre(m, "XCTR", i).try_cast("double").alias("x"), _centre(m, "YCTR", i).try_cast("double").alias("y")))
    return F.filter(both, lambda c: c.x.isNotNull() & c.y.isNotNull())


def grid_centres(cards: Column | str, comments: Column | str, planes: Column) -> Column:
    """Centres by the places ``(ix, iy)`` that the cards' comments give, row by row; null where those make no whole grid."""
    m, notes = (F.col(c) if isinstance(c, str) else c for c in (cards, comments))
    at = F.when(planes > 0, F.sequence(F.lit(1), planes)).otherwise(F.array().cast("array<int>"))
    place = lambda i, k: F.regexp_extract(F.coalesce(_centre(notes, "XCTR", i), F.lit("")), r"\((\d+)\s*,\s*(\d+)\)", k).try_cast("int")
    rows = F.transform(at, lambda i: F.struct(place(i, 1).alias("ix"), place(i, 2).alias("iy"), _centre(m, "XCTR", i).try_cast("double").alias("x"), _centre(m, "YCTR", i).try_cast("double").alias("y")))
    whole = F.forall(rows, lambda r: r.ix.isNotNull() & r.iy.isNotNull() & r.x.isNotNull() & r.y.isNotNull())
    xs, ys = F.array_distinct(F.transform(rows, lambda r: r.ix)), F.array_distinct(F.transform(rows, lambda r: r.iy))
    nx, ny = F.array_max(xs) + 1, F.array_max(ys) + 1
    # of several values for one place the last counts
    value = lambda k, v, want: F.element_at(F.transform(F.filter(rows, lambda r: r[k] == want), lambda r: r[v]), -1)
    centres = F.flatten(F.transform(F.sequence(F.lit(0), ny - 1), lambda j: F.transform(F.sequence(F.lit(0), nx - 1), lambda i: F.struct(value("ix", "x", i).alias("x"), value("iy", "y", j).alias("y")))))
    return F.when((planes > 0) & whole & (nx * ny == planes) & (F.size(xs) == nx) & (F.size(ys) == ny), centres)


def needs_mending(primary: Column | str, image: Column | str) -> Column:
    """Whether a file's version files its centres in another order than its planes."""
    version = F.coalesce(F.nullif(_card(primary, "VERSION"), F.lit("")), F.nullif(_card(image, "VERSION"), F.lit("")), _card(image, "PROCVER"))
    number = F.split(F.nullif(F.regexp_extract(version, r"(\d+(?:\.\d+){1,2})", 1), F.lit("")), r"\.")
    part = lambda k: F.coalesce(F.get(number, F.lit(k)).cast("int"), F.lit(0))
    old = F.struct(part(0), part(1), part(2)) <= F.struct(*map(F.lit, LAST_UNMENDED))
    return F.coalesce(number.isNotNull() & ~F.contains(F.lower(version), F.lit(MENDED)) & old, F.lit(False))


def psf_centres(cards: str, comments: str, primary: str, image: str, planes: Column) -> dict[str, Column]:
    """``centres`` of the planes and a ``warning``: none for another number of centres, mended ones for old versions."""
    direct, grid = header_centres(cards, planes), grid_centres(cards, comments, planes)
    count, mend = F.size(direct) == planes, grid.isNotNull() & needs_mending(primary, image)
    mismatch = F.concat(F.lit("PSF_CENTER_COUNT_MISMATCH:"), F.size(direct).cast("string"), F.lit("/"), planes.cast("string"))
    none = F.filter(direct, lambda c: F.lit(False))
    return {"centres": F.when(~count, none).when(mend, grid).otherwise(direct), "warning": F.when(~count, mismatch).when(mend, "PSF_HEADER_CORRECTION_APPLIED")}


def psf_metadata(cards: str, shape: str) -> dict[str, Column]:
    """Planes, a digest of the header, counts of centres, and whether those disagree with the planes."""
    m = F.col(cards)
    planes = F.when(F.size(shape) == 3, F.get(shape, F.lit(0))).otherwise(F.lit(1))
    count = lambda prefix: F.size(F.filter(F.map_keys(m), lambda k: k.rlike(f"^{prefix}_?[0-9]+$")))
    text = F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e.key, F.lit("="), json_text(e.value))), "\n")
    return {"planes": planes, "header_sha256": F.sha2(text, 256), "n_x": count("XCTR"), "n_y": count("YCTR"), "issue": (count("XCTR") != planes) | (count("YCTR") != planes)}


def spatial_status(cards: str, shape: str) -> Column:
    """Whether an image's coordinates are usable: both axes on the sky, a place and a scale, and a finite position at its middle."""
    number = lambda *n: _card(cards, *n).try_cast("double")
    axes = _card(cards, "CTYPE1").rlike("^(RA|GLON|ELON)") & _card(cards, "CTYPE2").rlike("^(DEC|GLAT|ELAT)")
    scale = F.coalesce(F.nullif(number("CD2_2"), F.lit(0.0)), number("CDELT2"))
    x, y = F.get(shape, F.lit(1)) / 2.0, F.get(shape, F.lit(0)) / 2.0
    ra, dec = sky.to_sky(x, y, number("CRVAL1"), number("CRVAL2"), 1.0, 0.0, 0.0)
    placed = number("CRVAL1").isNotNull() & number("CRVAL2").isNotNull() & number("CRPIX1").isNotNull() & number("CRPIX2").isNotNull()
    finite = ra.isNotNull() & dec.isNotNull() & ~F.isnan(ra) & ~F.isnan(dec)
    return F.when(~F.coalesce(axes, F.lit(False)), "not_celestial").when(~F.coalesce(placed & scale.isNotNull() & (scale != 0), F.lit(False)), "incomplete").when(~finite, "not_finite").otherwise("passed")


def spectral_status(hdus: DataFrame, table: str = "WCS-WAVE") -> DataFrame:
    """``path, status, n_rows, n_columns`` of the table that gives wavelengths: missing, no table, empty, or passed."""
    mine = F.upper("name") == table
    card = lambda n: F.max(F.when(mine, F.try_element_at("cards", F.lit(n)))).try_cast("int")
    per = hdus.groupBy("path").agg(F.count_if(mine).alias("n"), F.max(F.when(mine, F.col("kind"))).alias("kind"), card("NAXIS2").alias("n_rows"), card("TFIELDS").alias("n_columns"))
    status = F.when(F.col("n") == 0, "missing").when(F.col("kind") != "BINTABLE", "no_table").when(F.coalesce("n_rows", F.lit(0)) == 0, "empty").otherwise("passed")
    return per.select("path", status.alias("status"), "n_rows", "n_columns")
