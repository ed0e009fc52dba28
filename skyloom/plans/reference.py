"""Queries of the catalogue, discovery, calibration, reporting and photometry operators, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.scalars import digest_text
from skyloom.operators import background, calibration, catalog, components, discovery, fit, images, measure, ordering, pixels, psf, reports, selection, upsert
from skyloom.session import load
from skyloom.streaming import events

QUERIES: dict = {}
SQL: dict[str, str] = {}
_TRIM = "lower(trim({}, chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)))"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _states(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """The last row of each source; of the given columns, which are all that is read, or whole."""
    t = load(spark, d, "sources")
    return catalog.latest_states(t.select("source_id", *cols, "last_seen_at", "source_pk") if cols else t, "source_id", ["last_seen_at", "source_pk"])


_STATES = "select * from (select *, row_number() over (partition by source_id order by last_seen_at desc nulls last, source_pk desc) as rn from sources where source_id is not null) where rn = 1"


def _products(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """The last row of each product in all snapshots, of the given columns."""
    return upsert.last_per_key(load(spark, d, "discovery_products").select("product_id", *cols, "last_seen_at", "snapshot_row_id"), ["product_id"], ["last_seen_at", "snapshot_row_id"]).select("product_id", *cols)


_PRODUCTS = "select * from (select *, row_number() over (partition by product_id order by last_seen_at desc nulls last, snapshot_row_id desc) as rn from discovery_products) where rn = 1"
_MEASURED = "select distinct * from measurements"


def _measured(spark: SparkSession, d: str) -> DataFrame:
    """Distinct measurements; second deliveries are exact copies."""
    return load(spark, d, "measurements").dropDuplicates(["measurement_id"])


# ---- catalogue

# a number as JSON: rounded, small ones with an exponent
_NUMBER = lambda c, digits: f"coalesce(case when abs({c}) < 1e-4 and round({c}, {digits}) <> 0 then printf('%.10g', round({c}, {digits})) else cast(round({c}, {digits}) as varchar) end, 'null')"


@query(f"""
select source_id, nullif(trim(regexp_replace(regexp_replace(trim(source_name), '\\s+', '_', 'g'), '[^A-Za-z0-9_.:-]+', '_', 'g'), '_'), '') as name_id,
  sha256('{{"active":' || case when coalesce(active, 1) <> 0 then 'true' else 'false' end || ',"cutout_size_arcsec":' || {_NUMBER('cutout_size_arcsec', 4)} || ',"dec_deg":' || {_NUMBER('dec_deg', 10)}
    || ',"extra_json":' || to_json(coalesce(nullif(extra_json, ''), '{{}}')) || ',"priority":' || coalesce(cast(priority as varchar), 'null') || ',"ra_deg":' || {_NUMBER('ra_deg', 10)}
    || ',"source_id":' || to_json(source_id) || ',"source_name":' || coalesce(cast(to_json(source_name) as varchar), 'null') || ',"source_type":' || coalesce(cast(to_json(source_type) as varchar), 'null') || '}}') as row_key
from ({_STATES})""")
def catalog_states(spark: SparkSession, d: str) -> DataFrame:
    """Normalised names and row identities of each source's last state."""
    s = _states(spark, d).withColumn("active", catalog.flag(F.col("active").cast("string")))
    return s.select("source_id", catalog.normal_id("source_name").alias("name_id"), catalog.row_hash(s).alias("row_key"))


@query("""
with s as (select source_pk, source_id, source_name, ra_deg, dec_deg, cutout_size_arcsec from sources),
c as (select source_name, count(*) as n from sources where source_name is not null group by 1)
select source_pk, concat_ws(';', case when s.source_name is null then 'missing_id' end, case when s.source_name is null then 'missing_name' end,
  case when not coalesce(ra_deg >= 0 and ra_deg < 360, false) then 'bad_ra' end, case when not coalesce(dec_deg between -90 and 90, false) then 'bad_dec' end,
  case when cutout_size_arcsec is not null and not cutout_size_arcsec between 6 and 3600 then 'bad_size' end, case when c.n > 1 then 'duplicate_id' end) as errors
from s left join c using (source_name)""")
def catalog_row_errors(spark: SparkSession, d: str) -> DataFrame:
    """All that is wrong with each written row, names taken as ids."""
    rows = load(spark, d, "sources").select("source_pk", F.col("source_name").alias("source_id"), "source_name", "ra_deg", "dec_deg", "cutout_size_arcsec")
    return catalog.checked(rows).select("source_pk", F.array_join("errors", ";").alias("errors"))


@query(f"""
with p as (select source_id, ra_deg, dec_deg from ({_STATES}) where ra_deg is not null and dec_deg is not null)
select id_a, id_b, round(min(g), 9) as flat_deg from (select a.source_id as id_a, b.source_id as id_b, sqrt(power((a.ra_deg - b.ra_deg) * cos(radians((a.dec_deg + b.dec_deg) / 2)), 2) + power(a.dec_deg - b.dec_deg, 2)) as g
  from p a join p b on a.source_id < b.source_id and abs(a.dec_deg - b.dec_deg) <= 0.02) where g <= 0.02 group by 1, 2""")
def catalog_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose last positions lie within 72 arcseconds on the flat sky."""
    return catalog.near_duplicates(_states(spark, d, "ra_deg", "dec_deg"), 0.02).withColumn("flat_deg", F.round("flat_deg", 9))


@query("select catalog_version_id, count(*) as n_rows, cast(sum(cast('0x' || substr(" + _TRIM.format("row_hash") + ", 1, 12) as bigint)) as varchar) as digest from sources group by 1")
def catalog_version_digests(spark: SparkSession, d: str) -> DataFrame:
    """Rows and an order-free digest of each catalogue version."""
    return load(spark, d, "sources").groupBy("catalog_version_id").agg(F.count(F.lit(1)).alias("n_rows"), reports.digest(digest_text("row_hash")).alias("digest"))


@query("""
select source_id, source_pk, row_number() over (partition by source_id, row_h order by last_seen_at, source_pk) > 1 as duplicate
from (select *, """ + _TRIM.format("row_hash") + """ as row_h, first_value(source_pk) over (partition by source_pk order by last_seen_at) as x from (select distinct source_id, source_pk, row_hash, last_seen_at from sources))""")
def catalog_repeated_states(spark: SparkSession, d: str) -> DataFrame:
    """Which writes only repeat a state that the source had before; the first one counts."""
    rows = load(spark, d, "sources").select("source_id", "source_pk", "row_hash", "last_seen_at").distinct().withColumn("h", digest_text("row_hash"))
    first = rows.groupBy("source_id", "h").agg(F.min(F.struct("last_seen_at", "source_pk")).alias("first"))
    return rows.join(first, ["source_id", "h"]).select("source_id", "source_pk", (F.struct("last_seen_at", "source_pk") > F.col("first")).alias("duplicate"))


# ---- discovery


@query(r"""
with f as (select distinct access_url, regexp_extract(regexp_replace(access_url, '[?#].*$', ''), '([^/]+)$', 1) as file_name from discovery_products where access_url is not null),
s as (select *, regexp_replace(file_name, '\.[^.]*$', '') as stem from f)
select access_url, file_name, try_cast(coalesce(nullif(regexp_extract(stem, '(?i)(?:^|[_-])(?:D|[0-9]D)([1-6])(?:[_\-.]|$)', 1), ''), nullif(regexp_extract(stem, '(?i)D([1-6])', 1), '')) as integer) as detector,
  coalesce(nullif(regexp_extract(stem, '([0-9]{4}W[0-9]{2}[_-][A-Za-z0-9]+)', 1), ''), 'unknown_period') as period,
  coalesce(nullif(regexp_extract(stem, '(?i)(l2[ab]-v[^_\s]+)', 1), ''), nullif(regexp_extract(stem, '(?i)(v[0-9]+(?:[.-][0-9]+)*)', 1), ''), 'unknown_version') as version,
  replace(nullif(regexp_extract(stem, '([0-9]{4}[-_][0-9]{3}|[0-9]{8})', 1), ''), '_', '-') as date, nullif(regexp_extract(stem, '(?:^|[_-])([0-9]{4,})(?:[_-]|$)', 1), '') as observation
from s""")
def discovery_file_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Detector, period, version, date and observation from the file names of all addresses."""
    urls = load(spark, d, "discovery_products").select("access_url").filter("access_url is not null").distinct().withColumn("file_name", discovery.file_name("access_url"))
    m = discovery.file_metadata(F.col("file_name"))
    return urls.select("access_url", "file_name", *(m[k].alias(k) for k in ("detector", "period", "version", "date", "observation")))


_ID = lambda *c: "sha256(cast(json_object(" + ", ".join(f"'{x}', {x}" for x in sorted(c)) + ") as varchar))"


@query(f"""select snapshot_row_id, case when obs_publisher_did <> '' then {_ID('collection', 'obs_publisher_did', 'processing_version', 'processing_date')}
  else {_ID('collection', 'access_url', 'parent_filename', 'observation_id', 'detector_id', 'processing_version', 'processing_date')} end as signature,
  {_ID('collection', 'obs_publisher_did', 'obs_id', 'access_url', 'parent_filename', 'processing_version', 'processing_date')} as row_key from discovery_products""")
def discovery_signatures(spark: SparkSession, d: str) -> DataFrame:
    """Content-addressed identity of every listed product and of its row."""
    t = load(spark, d, "discovery_products")
    return t.select("snapshot_row_id", discovery.product_signature().alias("signature"), discovery.product_row_hash().alias("row_key"))


@query("""select snapshot_row_id, access_url || '?center=' || printf('%.10f', s_ra) || ',' || printf('%.10f', s_dec) || '&size=0.05' as url from discovery_products where s_ra is not null and s_dec is not null and access_url is not null""")
def discovery_cutout_urls(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of 180-arcsecond cutouts at every product's pointing."""
    t = load(spark, d, "discovery_products").filter("s_ra is not null and s_dec is not null and access_url is not null")
    return t.select("snapshot_row_id", discovery.cutout_url(F.col("access_url"), F.col("s_ra"), F.col("s_dec"), F.lit(180.0)).alias("url"))


@query(r"""
with t as (select doc_id, coalesce(nullif(trim(regexp_replace(regexp_replace(trim(title, chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)), '\s+', '_', 'g'), '[^A-Za-z0-9_.:-]+', '_', 'g'), '_'), ''), 'unknown') as v from documents)
select doc_id, case when length(v) <= 24 then v else rtrim(substr(v, 1, 15), '_') || '_' || substr(sha1(v), 1, 8) end as slug from t""")
def discovery_slugs(spark: SparkSession, d: str) -> DataFrame:
    """Titles as safe names of at most 24 signs."""
    return load(spark, d, "documents").select("doc_id", discovery.slug("title", 24).alias("slug"))


@query("""
select product_id, min(first_discovered_at) as first_seen, max(last_seen_at) as last_seen, count(distinct snapshot_no) as n_snapshots, count(*) as n_listings from discovery_products group by 1""")
def discovery_lifetimes(spark: SparkSession, d: str) -> DataFrame:
    """First and last sighting of each product."""
    t = load(spark, d, "discovery_products").groupBy("product_id", "snapshot_no").agg(F.min("first_discovered_at").alias("f"), F.max("last_seen_at").alias("l"), F.count(F.lit(1)).alias("n"))
    return t.groupBy("product_id").agg(F.min("f").alias("first_seen"), F.max("l").alias("last_seen"), F.count("snapshot_no").alias("n_snapshots"), F.sum("n").alias("n_listings"))


# ---- upserts


_SNAP = "select product_id, h, v, first_discovered_at, last_seen_at, did from (select product_id, " + _TRIM.format("row_hash") + """ as h, processing_version as v, first_discovered_at, last_seen_at, obs_publisher_did as did, snapshot_no,
  row_number() over (partition by product_id order by last_seen_at desc, snapshot_row_id desc) as rn from discovery_products where snapshot_no {}) where rn = 1"""


def _snapshot(spark: SparkSession, d: str, last: bool) -> DataFrame:
    """The last row of each product in the snapshot delivered last, or in those before it."""
    t = load(spark, d, "discovery_products")
    number = t.agg(F.max("snapshot_no").alias("n")).select("n").scalar()
    t = t.filter(F.col("snapshot_no") == number if last else F.col("snapshot_no") < number)
    rows = t.select("product_id", digest_text("row_hash").alias("h"), F.col("processing_version").alias("v"), "first_discovered_at", "last_seen_at", F.col("obs_publisher_did").alias("did"), "snapshot_row_id")
    return upsert.last_per_key(rows, ["product_id"], ["last_seen_at", "snapshot_row_id"]).drop("snapshot_row_id")


@query(f"""
with a as ({_SNAP.format('< (select max(snapshot_no) from discovery_products)')}), b as ({_SNAP.format('= (select max(snapshot_no) from discovery_products)')})
select coalesce(b.product_id, a.product_id) as product_id, case when b.product_id is not null then b.h else a.h end as h, case when b.product_id is not null then b.v else a.v end as v,
  coalesce(a.first_discovered_at, b.first_discovered_at) as first_discovered_at, coalesce(b.last_seen_at, a.last_seen_at) as last_seen_at, coalesce(b.did, a.did) as did, b.product_id is not null as active
from a full join b using (product_id)""")
def upsert_products(spark: SparkSession, d: str) -> DataFrame:
    """The last snapshot upserted into all before it: discovery time kept, publisher's id never lost, products no longer listed inactive."""
    old, new = _snapshot(spark, d, False), _snapshot(spark, d, True)
    table = upsert.upsert(old, new, ["product_id"], preserve=["first_discovered_at"], coalesce=["did"]).withColumn("active", F.lit(True)).withColumn("retired_at", F.lit(None).cast("timestamp_ntz"))
    return upsert.retire(table, new, ["product_id"], "active", "retired_at", F.localtimestamp()).drop("retired_at")


@query(f"""
with a as ({_SNAP.format('< (select max(snapshot_no) from discovery_products)')}), b as ({_SNAP.format('= (select max(snapshot_no) from discovery_products)')})
select count(*) filter (where a.product_id is null) as n_new, count(*) filter (where a.product_id is not null and b.product_id is not null and a.h is distinct from b.h) as n_updated,
  count(*) filter (where a.product_id is not null and b.product_id is not null and a.h is not distinct from b.h) as n_unchanged, count(*) filter (where b.product_id is null) as n_missing
from a full join b on a.product_id = b.product_id""")
def upsert_statistics(spark: SparkSession, d: str) -> DataFrame:
    return upsert.upsert_counts(_snapshot(spark, d, False), _snapshot(spark, d, True), ["product_id"], "h")


@query("select product_id as key, count(*) as n_rows from (select distinct measurement_id, product_id from measurements) m where product_id is not null and not exists (select 1 from discovery_products p where p.product_id = m.product_id) group by 1")
def orphan_products(spark: SparkSession, d: str) -> DataFrame:
    """Products of measurements that no snapshot lists."""
    return upsert.missing_parents(load(spark, d, "measurements").select("measurement_id", "product_id").distinct(), load(spark, d, "discovery_products"), "product_id", "product_id")


@query("select source_pk, count(*) as n_rows from sources group by 1 having count(*) > 1")
def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    return upsert.unique_violations(load(spark, d, "sources"), ["source_pk"])


# ---- calibration

_BEST = """select * exclude (rn) from (select release, calibration_type, detector_id, validated_at, calibration_id, local_path,
  row_number() over (partition by release, calibration_type, detector_id order by validated_at desc, calibration_id) as rn from calibration_products where validated_at is not null) where rn = 1"""


@query(_BEST)
def calibration_best(spark: SparkSession, d: str) -> DataFrame:
    """The product to use per release, type and detector."""
    return calibration.best_products(load(spark, d, "calibration_products"))


@query(f"""
with need as (select distinct p.detector_id, c.release, c.calibration_type from (select distinct detector_id from discovery_products) p, (select distinct release, calibration_type from calibration_products) c),
best as ({_BEST}), x as (select n.*, b.calibration_id from need n left join best b using (release, calibration_type, detector_id))
select release, detector_id, bool_and(calibration_id is not null) as complete, string_agg(coalesce(calibration_id, '-'), ';' order by calibration_type) as calibration_ids,
  coalesce(string_agg(case when calibration_id is null then calibration_type end, ';' order by calibration_type), '') as missing from x group by 1, 2""")
def calibration_resolution(spark: SparkSession, d: str) -> DataFrame:
    """For each release and detector in use: whether all calibration types are there, which they are and which are missing."""
    table = load(spark, d, "calibration_products")
    best = calibration.best_products(table)
    kinds = table.groupBy().agg(F.collect_set(F.struct("release", "calibration_type")).alias("k"))
    detectors = load(spark, d, "discovery_products").select("detector_id").distinct()
    need = detectors.withColumn("k", F.explode(kinds.scalar())).select("detector_id", "k.*")
    return calibration.resolve(need, best)


@query("select release, calibration_type, detector_id, validated_at is not null as valid, count(*) as n from calibration_products group by all")
def calibration_status(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "calibration_products").groupBy("release", "calibration_type", "detector_id", F.col("validated_at").isNotNull().alias("valid")).agg(F.count(F.lit(1)).alias("n"))


# ---- reports


@query(f"""
with s as ({_STATES}), m as ({_MEASURED}), p as ({_PRODUCTS}),
l as (select distinct source_id, product_id from m where product_id is not null),
c as (select l.source_id, count(distinct p.product_id) as n_products, count(distinct detector_id) as n_detectors, string_agg(distinct 'D' || detector_id, ',' order by 'D' || detector_id) as detectors, count(distinct planning_period) as n_periods,
  count(distinct processing_version) as n_versions, min(em_min) as em_min, max(em_max) as em_max, min(t_min) as t_min, max(t_max) as t_max from l join p using (product_id) group by 1),
q as (select source_id, count(*) as n_measured, count(*) filter (where science_recommended = 1) as n_science, count(*) filter (where detection_status like 'invalid%') as n_invalid from m group by 1)
select s.source_id, s.source_name, coalesce(n_products, 0) as n_products, coalesce(n_detectors, 0) as n_detectors, detectors, coalesce(n_periods, 0) as n_periods, coalesce(n_versions, 0) as n_versions, em_min, em_max, t_min, t_max,
  coalesce(n_measured, 0) as n_measured, coalesce(n_science, 0) as n_science, coalesce(n_invalid, 0) as n_invalid, case when coalesce(n_products, 0) > 0 then 'covered' else 'not_covered' end as coverage_status
from s left join c using (source_id) left join q using (source_id)""")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    """What covers each source, and what was measured of it."""
    m = _measured(spark, d).select("measurement_id", "source_id", "product_id", "science_recommended", "detection_status")
    links = m.filter("product_id is not null").select("source_id", "product_id").distinct()
    products = _products(spark, d, "detector_id", "planning_period", "processing_version", "em_min", "em_max", "t_min", "t_max").select("product_id", "detector_id", "planning_period", "processing_version", "em_min", "em_max", "t_min", "t_max")
    return reports.coverage(_states(spark, d, "source_name").select("source_id", "source_name"), links, products, m)


@query(f"""select photometry_run_id, count(*) as n_measurements, count(distinct source_id) as n_sources, count(*) filter (where detection_status = 'detected') as n_detected, count(*) filter (where science_recommended = 1) as n_science,
  cast(sum(n_valid_pixels) as bigint) as n_pixels, cast(bit_or(image_flags) as bigint) as flags from ({_MEASURED}) group by 1""")
def run_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counters of each photometry run."""
    return _measured(spark, d).groupBy("photometry_run_id").agg(
        F.count(F.lit(1)).alias("n_measurements"), F.count_distinct("source_id").alias("n_sources"), F.count_if(F.col("detection_status") == "detected").alias("n_detected"), F.count_if(F.col("science_recommended") == 1).alias("n_science"),
        F.sum("n_valid_pixels").alias("n_pixels"), F.bit_or("image_flags").alias("flags"),
    )


@query(f"""select source_id, string_agg(coalesce(detection_status, '-') || ':' || n, ',' order by coalesce(detection_status, '-') || ':' || n) as counts from (select source_id, detection_status, count(*) as n from ({_MEASURED}) group by 1, 2) group by 1""")
def status_histograms(spark: SparkSession, d: str) -> DataFrame:
    return reports.histogram_map(_measured(spark, d), "source_id", "detection_status")


@query("""select 'sources' as table_name, count(*) as n_rows from sources union all select 'discovery_products', count(*) from discovery_products union all select 'measurements', count(*) from measurements
union all select 'input_catalog', count(*) from input_catalog union all select 'documents', count(*) from documents""")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.table_counts({t: load(spark, d, t) for t in ("sources", "discovery_products", "measurements", "input_catalog", "documents")})


@query(f"""
select measurement_id, row_number() over (partition by source_id order by wavelength_um nulls last, spectral_wcs_calibration_id nulls last, measurement_id) - 1 as place from ({_MEASURED})""")
def spectrum_order(spark: SparkSession, d: str) -> DataFrame:
    """Place of each measurement in its source's spectrum: by wavelength (not-a-number after numbers, null last), calibration and id."""
    rows = _measured(spark, d).select("measurement_id", "source_id", "wavelength_um", "spectral_wcs_calibration_id")
    w = F.col("wavelength_um")
    slices = F.when(w.isNull(), 1 << 20).when(F.isnan(w), (1 << 20) - 1).otherwise(F.floor(F.greatest(F.lit(-1e4), F.least(F.lit(1e4), w)) * 50)).cast("int")
    return ordering.places(rows, "source_id", slices, [w, F.asc_nulls_last("spectral_wcs_calibration_id"), F.col("measurement_id")]).select("measurement_id", "place")


@query(f"""select product_id, case when access_estsize >= 1073741824 then printf('%.1f GiB', access_estsize / 1073741824.0) when access_estsize >= 1048576 then printf('%.1f MiB', access_estsize / 1048576.0)
  when access_estsize >= 1024 then printf('%.1f KiB', access_estsize / 1024.0) else printf('%d B', access_estsize) end as size_text from ({_PRODUCTS}) where access_estsize is not null""")
def product_sizes(spark: SparkSession, d: str) -> DataFrame:
    p = _products(spark, d, "access_estsize").filter("access_estsize is not null")
    return p.select("product_id", reports.human_bytes(F.col("access_estsize")).alias("size_text"))


# ---- photometry on images: every embedding is an image of 8 x 8 pixels

_BITS = {k: 1 << pixels.FLAG_BITS[k] for k in ("NONFUNC", "SOURCE", "OVERFLOW", "HOT")}


def _pixels(spark: SparkSession, d: str) -> DataFrame:
    p = pixels.explode_images(load(spark, d, "embeddings"), "vec_id", "embedding", 8)
    key = lambda a, b: F.col("image_id") * a + F.col("i") * b
    p = p.withColumn("variance", (5 + key(7, 3) % 11) / 1000.0)
    flag = F.when(key(31, 17) % 23 == 0, _BITS["SOURCE"]).otherwise(0) + F.when(key(13, 7) % 29 == 0, _BITS["NONFUNC"]).otherwise(0) + F.when(key(5, 11) % 37 == 0, _BITS["OVERFLOW"]).otherwise(0)
    return p.withColumn("flag", flag.cast("bigint")).withColumn("template", pixels.gaussian_template(3.3, 3.6)).withColumn("second", pixels.gaussian_template(5.2, 2.1))


def _images(spark: SparkSession, d: str) -> DataFrame:
    """The same images as rows with arrays."""
    e = load(spark, d, "embeddings").select(F.col("vec_id").alias("image_id"), F.lit(8).alias("width"), F.col("embedding").cast("array<double>").alias("value"))
    key = lambda i, a, b: F.col("image_id") * a + i * b
    at = F.sequence(F.lit(0), F.size("value") - 1)
    bit = lambda i, a, b, n, name: F.when(key(i, a, b) % n == 0, _BITS[name]).otherwise(0).cast("bigint")
    bump = F.transform(at, lambda i: F.exp(-0.5 * (F.pow((i % 8 - 3.3) / 1.2, 2) + F.pow((F.floor(i / 8) - 3.6) / 1.2, 2))))
    return e.withColumns({
        "variance": F.transform(at, lambda i: (5 + key(i, 7, 3) % 11) / 1000.0),
        "flag": F.transform(at, lambda i: bit(i, 31, 17, 23, "SOURCE") + bit(i, 13, 7, 29, "NONFUNC") + bit(i, 5, 11, 37, "OVERFLOW")), "template": bump,
    })


_PIX = f"""
e as (select vec_id as image_id, unnest(embedding) as value, generate_subscripts(embedding, 1) - 1 as i from embeddings),
r as (select image_id, i, i // 8 as y, i % 8 as x, cast(value as double) as value, (5 + (image_id * 7 + i * 3) % 11) / 1000.0 as variance,
  (case when (image_id * 31 + i * 17) % 23 = 0 then {_BITS['SOURCE']} else 0 end) + (case when (image_id * 13 + i * 7) % 29 = 0 then {_BITS['NONFUNC']} else 0 end) + (case when (image_id * 5 + i * 11) % 37 = 0 then {_BITS['OVERFLOW']} else 0 end) as flag,
  exp(-0.5 * (power((x - 3.3) / 1.2, 2) + power((y - 3.6) / 1.2, 2))) as t0, exp(-0.5 * (power((x - 5.2) / 1.2, 2) + power((y - 2.1) / 1.2, 2))) as u0 from e),
p as (select *, t0 / sum(t0) over (partition by image_id) as template, u0 / sum(u0) over (partition by image_id) as second from r),
k as (select *, power(x - 3.3, 2) + power(y - 3.6, 2) <= 4 as central, template >= 0.01 * max(template) over (partition by image_id) as footprint, template >= 0.2 * max(template) over (partition by image_id) as core,
  (flag & {_BITS['NONFUNC']}) <> 0 as hard_bad, (flag & {_BITS['NONFUNC'] | _BITS['SOURCE'] | _BITS['OVERFLOW']}) <> 0 as background_bad, (flag & {_BITS['NONFUNC'] | _BITS['OVERFLOW']}) <> 0 as science_bad, (flag & {_BITS['SOURCE']}) <> 0 as source_flag from p),
wide as (select distinct a.image_id, a.y, a.x from k a join k b on a.image_id = b.image_id and abs(a.y - b.y) <= 1 and abs(a.x - b.x) <= 1 where b.core),
m as (select k.*, (central or wide.x is not null) as protected, not hard_bad as fit, not background_bad and not (central or wide.x is not null) as background, footprint or central as fit_region,
  not hard_bad and not (central or wide.x is not null) and k.x between 1 and 6 and k.y between 1 and 6 as source_finding from k left join wide using (image_id, y, x))"""


def _masked(spark: SparkSession, d: str) -> DataFrame:
    return pixels.with_masks(_pixels(spark, d), 3.3, 3.6)


_ROUND = lambda df, skip=(): df.select(*(F.round(c, 8).alias(c) if t == "double" and c not in skip else c for c, t in df.dtypes))


@query("with " + _PIX + """
select image_id, count(*) filter (where fit) as n_fit, count(*) filter (where background) as n_background, count(*) filter (where source_finding) as n_source_finding, count(*) filter (where protected) as n_protected,
  count(*) filter (where hard_bad) as n_hard_bad, count(*) filter (where science_bad and fit_region) as n_science_bad_fit, cast(bit_or(flag) as bigint) as flags_all, coalesce(cast(bit_or(flag) filter (where fit_region) as bigint), 0) as flags_fit,
  coalesce(cast(bit_or(flag) filter (where central) as bigint), 0) as flags_central, coalesce(cast(bit_or(flag) filter (where footprint) as bigint), 0) as flags_footprint,
  round(count(*) filter (where fit) / count(*), 8) as fit_share, round(count(*) filter (where background) / count(*), 8) as background_share, round(count(*) filter (where protected) / count(*), 8) as protected_share,
  round(count(*) filter (where hard_bad and central) / count(*) filter (where central), 8) as hard_bad_core_share, round(count(*) filter (where source_flag and fit_region) / count(*) filter (where fit_region), 8) as source_fit_share,
  round(count(*) filter (where fit and central) / count(*) filter (where central), 8) as central_fit_share, round(coalesce(sum(template) filter (where fit), 0) / sum(template), 8) as template_unmasked,
  round(coalesce(sum(template) filter (where hard_bad), 0) / sum(template), 8) as template_hard_bad, cast(0 as double) as template_bad_variance from m group by 1""")
def image_masks(spark: SparkSession, d: str) -> DataFrame:
    """Counts, shares and flag unions of every image's masks."""
    return _ROUND(images.image_masks(_images(spark, d), 3.3, 3.6))


@query("with " + _PIX + " select image_id, name as flag_name, count(*) as n_pixels from p, (values " + ", ".join(f"('{k}', {v})" for k, v in _BITS.items()) + ") b(name, bit) where (flag & bit) <> 0 group by 1, 2")
def image_flag_counts(spark: SparkSession, d: str) -> DataFrame:
    return pixels.flag_counts(_pixels(spark, d))


@query("select measurement_id, image_flags, concat_ws(';', " + ", ".join(f"case when (image_flags & {1 << b}) <> 0 then '{n}' end" for n, b in pixels.FLAG_BITS.items()) + f") as names from ({_MEASURED})")
def measurement_flag_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of the flag bits of every measurement."""
    return _measured(spark, d).select("measurement_id", "image_flags", F.coalesce(F.array_join(pixels.flag_names(F.col("image_flags")), ";"), F.lit("")).alias("names"))


def _plane_sql(rounds: int, start: str = "m where background") -> str:
    parts, last = [f"s0 as (select image_id, y, x, value, variance, x - 3.5 as xc, y - 3.5 as yc, true as kept from {start})"], "s0"
    for r in range(1, rounds + 2):
        parts.append(f"""n{r} as (select image_id, count(*) as n, sum(1 / variance) as s, sum(xc / variance) as sx, sum(yc / variance) as sy, sum(xc * xc / variance) as sxx, sum(xc * yc / variance) as sxy, sum(yc * yc / variance) as syy,
  sum(value / variance) as sz, sum(xc * value / variance) as sxz, sum(yc * value / variance) as syz from {last} where kept group by 1),
c{r} as (select image_id, n, s * (sxx * syy - sxy * sxy) - sx * (sx * syy - sxy * sy) + sy * (sx * sxy - sxx * sy) as det, (sz * (sxx * syy - sxy * sxy) - sx * (sxz * syy - sxy * syz) + sy * (sxz * sxy - sxx * syz)) / det as b0,
  (s * (sxz * syy - sxy * syz) - sz * (sx * syy - sxy * sy) + sy * (sx * syz - sxz * sy)) / det as bx, (s * (sxx * syz - sxz * sxy) - sx * (sx * syz - sxz * sy) + sz * (sx * sxy - sxx * sy)) / det as by_ from n{r}),
d{r} as (select a.image_id, a.y, a.x, a.value, a.variance, a.xc, a.yc, a.kept, a.value - (c.b0 + c.bx * a.xc + c.by_ * a.yc) as r, c.b0, c.bx, c.by_, c.n from {last} a join c{r} c using (image_id)),
e{r} as (select image_id, median(r) filter (where kept) as mid, stddev_pop(r) filter (where kept) as sd, median(sqrt(variance)) filter (where kept) as noise from d{r} group by 1),
f{r} as (select d{r}.image_id, case when median(abs(r - mid)) filter (where kept) > 0 then 1.4826 * median(abs(r - mid)) filter (where kept) else any_value(sd) end as sigma, any_value(noise) as noise from d{r} join e{r} using (image_id) group by 1),
s{r} as (select image_id, y, x, value, variance, xc, yc, r, b0, bx, by_, kept and abs(r) <= 3 * greatest(sigma, noise) as kept from d{r} join f{r} using (image_id))""")
        last = f"s{r}"
    parts.append(f"""g as (select image_id, median(r) filter (where kept) as mid, stddev_pop(r) filter (where kept) as sd, median(sqrt(variance)) filter (where kept) as noise, count(*) as n0, count(*) filter (where kept) as n_pixels, any_value(b0) as b0, any_value(bx) as bx, any_value(by_) as by_ from {last} group by 1),
h as (select {last}.image_id, median(abs(r - mid)) filter (where kept) as mad from {last} join g using (image_id) group by 1)""")
    return ",\n".join(parts)


_PLANE = """
select image_id, n_pixels, n_pixels >= 12 as ok, case when n_pixels >= 12 then round(b0, 8) end as b0, case when n_pixels >= 12 then round(bx, 8) end as bx, case when n_pixels >= 12 then round(by_, 8) end as "by",
  case when n_pixels >= 12 then round(greatest(case when mad > 0 then 1.4826 * mad else sd end, noise), 8) end as rms, case when n_pixels >= 12 then round(greatest(case when mad > 0 then 1.4826 * mad else sd end, noise) / sqrt(n_pixels), 8) end as uncertainty,
  round(1 - n_pixels / n0, 8) as clipped_share from g join h using (image_id)"""


@query("with " + _PIX + ",\n" + _plane_sql(background.ROUNDS) + _PLANE)
def image_background(spark: SparkSession, d: str) -> DataFrame:
    """The clipped plane under every image."""
    return _ROUND(images.backgrounds(_images(spark, d), 3.3, 3.6, (3.5, 3.5), "plane"))


_CALM = """w0 as (select *, true as calm from m where fit and not protected),
v1 as (select image_id, median(value) as mid, stddev_pop(value) as sd from w0 group by 1), v2 as (select w0.image_id, any_value(mid) as mid, case when median(abs(value - mid)) > 0 then 1.4826 * median(abs(value - mid)) else any_value(sd) end as sigma from w0 join v1 using (image_id) group by 1),
w1 as (select w0.* exclude (calm), abs(value - mid) <= 3 * sigma as calm from w0 join v2 using (image_id)),
v3 as (select image_id, median(value) as mid, stddev_pop(value) as sd from w1 where calm group by 1), v4 as (select w1.image_id, any_value(mid) as mid, case when median(abs(value - mid)) > 0 then 1.4826 * median(abs(value - mid)) else any_value(sd) end as sigma from w1 join v3 using (image_id) where calm group by 1),
w2 as (select w1.* exclude (calm), abs(value - mid) <= 3 * sigma as calm from w1 join v4 using (image_id))"""


@query("with " + _PIX + ",\n" + _CALM + ",\n" + _plane_sql(background.ROUNDS, "w2 where calm") + _PLANE)
def image_calm_background(spark: SparkSession, d: str) -> DataFrame:
    """The plane through the sound pixels of every image that aren't bright, whatever their flags."""
    return _ROUND(images.backgrounds(_images(spark, d), 3.3, 3.6, (3.5, 3.5), "calm"))


@query("with " + _PIX + """,
a1 as (select image_id, median(value) as mid, count(*) as n from m where fit group by 1), a2 as (select m.image_id, any_value(mid) as mid, any_value(n) as n, 1.4826 * median(abs(value - mid)) as sigma from m join a1 using (image_id) where fit group by 1),
b0 as (select m.image_id, value from m join a2 using (image_id) where fit and (n < 10 or abs(value - mid) <= 3 * sigma)),
b1 as (select image_id, median(value) as mid, count(*) as n from b0 group by 1), b2 as (select b0.image_id, any_value(mid) as mid, any_value(n) as n, 1.4826 * median(abs(value - mid)) as sigma from b0 join b1 using (image_id) group by 1),
c0 as (select b0.image_id, value from b0 join b2 using (image_id) where n < 10 or abs(value - mid) <= 3 * sigma),
c1 as (select image_id, median(value) as mid, count(*) as n from c0 group by 1)
select c0.image_id, any_value(n) as n_pixels, round(any_value(mid), 8) as value, round(1.4826 * median(abs(value - mid)), 8) as sigma from c0 join c1 using (image_id) group by 1""")
def image_constant_background(spark: SparkSession, d: str) -> DataFrame:
    """The clipped median of every image."""
    return _ROUND(images.backgrounds(_images(spark, d), 3.3, 3.6, (3.5, 3.5), "constant"))


_POINT = """q as (select image_id, count(*) as n, sum(template * value / variance) as td, sum(template * template / variance) as tt, sum(value * value / variance) as dd, sum(template / variance) as t1 from m where fit group by 1)"""


@query("with " + _PIX + ", " + _POINT + " select image_id, n as n_pixels, round(td / tt, 8) as flux, round(sqrt(1 / tt + 0.0001 * power(t1 / tt, 2)), 8) as flux_err, round((dd - td * td / tt) / greatest(n - 1, 1), 8) as chi2_reduced from q")
def image_point_fit(spark: SparkSession, d: str) -> DataFrame:
    """Forced flux of every image by a matched filter."""
    return _ROUND(fit.point_fit(_masked(spark, d), "template", "fit", 0.01))


_JOINT = """j as (select image_id, count(*) as n, sum(template * template / variance) as aa, sum(template * second / variance) as ab, sum(second * second / variance) as bb, sum(value * template / variance) as da, sum(value * second / variance) as db, sum(value * value / variance) as dd from m where fit group by 1),
jj as (select image_id, n, aa * bb - ab * ab as det, (bb * da - ab * db) / det as fa, (aa * db - ab * da) / det as fb, sqrt(bb / det) as ea, sqrt(aa / det) as eb, -ab / sqrt(aa * bb) as corr, (dd - fa * da - fb * db) / greatest(n - 2, 1) as chi2 from j)"""


@query("with " + _PIX + ", " + _JOINT + " select image_id, n as n_pixels, round(fa, 8) as flux_a, round(fb, 8) as flux_b, round(ea, 8) as err_a, round(eb, 8) as err_b, round(corr, 8) as correlation, round(chi2, 8) as chi2_reduced from jj")
def image_joint_fit(spark: SparkSession, d: str) -> DataFrame:
    """Fluxes of a target and a neighbour fitted together."""
    return _ROUND(fit.joint_fit(_masked(spark, d), "template", "second", "fit"))


@query("with " + _PIX + ", " + _POINT + ", " + _JOINT + """ select image_id, round(ea / sqrt(1 / tt), 8) as inflation, abs(corr) <= 0.9 and ea / sqrt(1 / tt) <= 3 and chi2 <= 1.05 * (dd - td * td / tt) / greatest(q.n - 1, 1) as stable from q join jj using (image_id)""")
def image_joint_stability(spark: SparkSession, d: str) -> DataFrame:
    m = _masked(spark, d)
    return _ROUND(fit.stable_joint(fit.point_fit(m, "template", "fit"), fit.joint_fit(m, "template", "second", "fit")))


@query("with " + _PIX + ", " + _POINT + """, z as (select m.*, (value - td / tt * template) / sqrt(variance) as z from m join q using (image_id) where fit)
select image_id, round(median(abs(z)) filter (where central), 8) as central_median_abs, round(max(z) filter (where central), 8) as central_peak, round(avg(z) filter (where central), 8) as central_mean,
  round(avg(abs(z)) filter (where power(x - 3.3, 2) + power(y - 3.6, 2) <= 6.25), 8) as mean_abs_2p5 from z group by 1""")
def image_residuals(spark: SparkSession, d: str) -> DataFrame:
    """How well the point fit leaves the centre of every image."""
    m = _masked(spark, d)
    return _ROUND(fit.residual_metrics(m, fit.point_fit(m, "template", "fit"), "template", "fit", "central", F.pow(F.col("x") - 3.3, 2) + F.pow(F.col("y") - 3.6, 2)))


@query("with " + _PIX + """, w as (select *, template * template / variance as w, 1 + 0.01 * x + 0.002 * y as wave from m where fit)
select image_id, round(sum(w * wave) / sum(w), 8) as weighted, round(arg_max(wave, struct_pack(a := w, b := -y, c := -x)), 8) as at_peak from w group by 1""")
def image_wavelength(spark: SparkSession, d: str) -> DataFrame:
    """The response-weighted wavelength of every image, and that at the strongest response."""
    m = _masked(spark, d).withColumn("wave", 1 + 0.01 * F.col("x") + 0.002 * F.col("y"))
    return _ROUND(fit.weighted_mean(m, "wave", "template", "fit"))


@query("with " + _PIX + " select image_id, round(sum(template * second) / sqrt(sum(template * template) * sum(second * second)), 8) as overlap from p group by 1")
def image_template_overlap(spark: SparkSession, d: str) -> DataFrame:
    return _ROUND(fit.overlap(_pixels(spark, d), "template", "second"))


_COMP = "with recursive " + _PIX + """,
b as (select image_id, y, x, y * 8 + x as id, value, variance from p where value > 0.1),
l as (select image_id, id, id as seed from b union select l.image_id, n.id, l.seed from l join b o on o.image_id = l.image_id and o.id = l.id join b n on n.image_id = o.image_id and abs(n.y - o.y) <= 1 and abs(n.x - o.x) <= 1),
cc as (select b.image_id, b.y, b.x, value, variance, seed as component from b join (select image_id, id, min(seed) as seed from l group by 1, 2) z on z.image_id = b.image_id and z.id = b.id)"""


def _members(spark: SparkSession, d: str) -> DataFrame:
    return images.bright_areas(_images(spark, d), 0.1)


@query(_COMP + " select image_id, y, x, component from cc")
def image_components(spark: SparkSession, d: str) -> DataFrame:
    """The connected bright areas of every image."""
    return _members(spark, d).select("image_id", "y", "x", "component")


_SUMMARY = _COMP + """,
ss as (select *, value / sqrt(variance) as snr from cc),
su as (select image_id, component, count(*) as area, arg_max(x, struct_pack(a := snr, b := -y, c := -x)) as peak_x, arg_max(y, struct_pack(a := snr, b := -y, c := -x)) as peak_y, max(snr) as peak_snr, sum(x * snr) / sum(snr) as centroid_x, sum(y * snr) / sum(snr) as centroid_y,
  sum(value) / sqrt(sum(variance)) as total_snr, sqrt(power(sum(x * snr) / sum(snr) - 3.3, 2) + power(sum(y * snr) / sum(snr) - 3.6, 2)) as distance, row_number() over (partition by image_id order by max(snr) desc, component) as rank from ss group by 1, 2)"""


@query(_SUMMARY + " select image_id, component, area, peak_x, peak_y, round(peak_snr, 8) as peak_snr, round(centroid_x, 8) as centroid_x, round(centroid_y, 8) as centroid_y, round(total_snr, 8) as total_snr, round(distance, 8) as distance, rank from su where rank <= 3")
def image_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The three strongest areas of every image with their summaries."""
    return _ROUND(components.strongest(components.summarize(_members(spark, d), 3.3, 3.6), 3))


def image_merged_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Areas of every image, those near an earlier kept one marked; the fold depends on order, so there is no SQL."""
    return components.merge_nearby(components.summarize(_members(spark, d), 3.3, 3.6), 2.0).select("image_id", "component", "kept")


QUERIES["image_merged_neighbours"] = image_merged_neighbours


def image_measurements(spark: SparkSession, d: str) -> DataFrame:
    """Forced photometry of every image with neighbours fitted along; solved in small systems, so there is no SQL."""
    return measure.measure(_pixels(spark, d).select("image_id", "y", "x", "value", "variance", "flag", "template"), 3.3, 3.6, 8)


QUERIES["image_measurements"] = image_measurements


_ZONES = [(det, zy * 4 + zx, 256.0 + 512 * zx + 3 * det, 256.0 + 512 * zy - 2 * det) for det in range(1, 7) for zy in range(4) for zx in range(4)]


@query("with z as (select * from (values " + ", ".join(map(str, _ZONES)) + f""") t(detector_id, zone, zx, zy)), p as (select product_id, detector_id, cast((product_id * 37) % 2040 as double) as x, cast((product_id * 53) % 2040 as double) as y from ({_PRODUCTS}))
select product_id, zone, d2 from (select product_id, zone, power(x - zx, 2) + power(y - zy, 2) as d2, row_number() over (partition by product_id order by power(x - zx, 2) + power(y - zy, 2), zone) as rn from p join z using (detector_id)) where rn = 1""")
def psf_zones(spark: SparkSession, d: str) -> DataFrame:
    """The nearest point-spread zone of a place on each product's detector."""
    zones = spark.createDataFrame(_ZONES, "detector_id int, zone int, zx double, zy double")
    places = _products(spark, d, "detector_id").select("product_id", "detector_id", ((F.col("product_id") * 37) % 2040).cast("double").alias("x"), ((F.col("product_id") * 53) % 2040).cast("double").alias("y"))
    return psf.nearest_zone(places, zones, "product_id")


@query("with " + _PIX + """, n as (select *, greatest(value, 0) / sum(greatest(value, 0)) over (partition by image_id) as q from p)
select image_id, cast(floor(2.3 + (y - 3.5) / 2 + 0.5) as integer) as y, cast(floor(1.9 + (x - 3.5) / 2 + 0.5) as integer) as x, round(sum(q), 8) as weight from n
where floor(2.3 + (y - 3.5) / 2 + 0.5) between 0 and 4 and floor(1.9 + (x - 3.5) / 2 + 0.5) between 0 and 4 and abs(floor(1.9 + (x - 3.5) / 2 + 0.5) - 1.9) <= 2.5 and abs(floor(2.3 + (y - 3.5) / 2 + 0.5) - 2.3) <= 2.5 group by 1, 2, 3""")
def psf_binned(spark: SparkSession, d: str) -> DataFrame:
    """Every image taken as an oversampled plane and summed into pixels."""
    from pyspark.sql.window import Window

    p = _pixels(spark, d)
    total = F.sum(F.greatest("value", F.lit(0.0))).over(Window.partitionBy("image_id"))
    cells = p.select("image_id", F.col("y").alias("py"), F.col("x").alias("px"), psf.normalized(F.col("value"), total).alias("p"))
    return _ROUND(psf.bin_plane(cells, 8, 1.9, 2.3, 2, 2, 5, 5))


@query(f"""
select measurement_id, case when point_flux_uJy is null or point_flux_err_uJy is null or isnan(point_flux_uJy) or isnan(point_flux_err_uJy) or isinf(point_flux_uJy) or isinf(point_flux_err_uJy) or point_flux_err_uJy <= 0 then 'invalid_fit'
  when point_flux_uJy < 0 then 'negative_flux' when point_flux_uJy / point_flux_err_uJy < 3 then 'non_detection' else 'detected' end as status,
  case when point_flux_err_uJy is null or isnan(point_flux_err_uJy) or isinf(point_flux_err_uJy) then cast('nan' as double) else 3 * point_flux_err_uJy end as upper_limit from ({_MEASURED})""")
def measurement_detection(spark: SparkSession, d: str) -> DataFrame:
    """Detection status and upper limit of every measurement."""
    m = _measured(spark, d)
    return m.select("measurement_id", selection.detection_status(F.col("point_flux_uJy"), F.col("point_flux_err_uJy")).alias("status"), selection.upper_limit(F.col("point_flux_err_uJy")).alias("upper_limit"))


# ---- streams


def _events(spark: SparkSession, d: str) -> DataFrame:
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    return events.event_stream(spark, f"{d}/events.parquet", schema)


@query("select event_type, time_bucket(interval '6 hours', ts) as w_start, count(*) as n_events, round(sum(value), 6) as total from events group by 1, 2")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events per type and six hours, counted by a stream."""
    stream = events.windowed_counts(_events(spark, d), "6 hours").select("event_type", F.col("w.start").alias("w_start"), "n_events", "total")
    out = events.run_to_table(stream, "complete")
    return out.select("event_type", F.col("w_start").cast("timestamp_ntz").alias("w_start"), "n_events", F.round("total", 6).alias("total"))


@query("select user_id, last(event_type order by ts, event_id) as event_type, last(event_id order by ts, event_id) as event_id from events group by 1")
def stream_latest_states(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each user, kept by upserting micro-batches."""
    out = events.upsert_stream(_events(spark, d).select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_type", "event_id")
