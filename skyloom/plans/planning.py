"""Queries of the relational readers, of identities, and of a catalogue's ingest, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.identity import stable_hash, texts
from skyloom.operators import calibration, catalog, discovery, ordering, planning, rejects, selection, upsert
from skyloom.plans.reference import _ID, _MEASURED, _PRODUCTS, _STATES, _events, _measured, _products, _states
from skyloom.session import load
from skyloom.streaming import events

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_LINKS = f"select distinct source_id, product_id from ({_MEASURED}) where product_id is not null"


def _links(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of source and product."""
    return load(spark, d, "measurements").filter("product_id is not null").select("source_id", "product_id").distinct()


@query(f"""select l.source_id, l.product_id, p.collection, coalesce(s.priority, 999999) as priority_rank, coalesce(s.cutout_size_arcsec, 180.0) as size_arcsec
from ({_LINKS}) l join ({_STATES}) s using (source_id) join ({_PRODUCTS}) p using (product_id) where s.active = 1 and coalesce(s.cutout_size_arcsec, 180.0) between 6 and 3600""")
def plan_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of an active source and a product that covers it, with the order of priorities and the size to cut."""
    s = _states(spark, d, "active", "priority", "cutout_size_arcsec").select("source_id", "active", "priority", "cutout_size_arcsec").filter("cutout_size_arcsec is null or cutout_size_arcsec between 6 and 3600")
    found = planning.candidates(_links(spark, d), s, _products(spark, d, "collection").select("product_id", "collection"))
    return found.select("source_id", "product_id", "collection", planning.priority_rank().alias("priority_rank"), planning.effective_size("cutout_size_arcsec", 180.0).alias("size_arcsec"))


@query(f"""select source_id, row_number() over (order by coalesce(priority, 999999), source_id) - 1 as place from ({_STATES}) where active = 1""")
def plan_order(spark: SparkSession, d: str) -> DataFrame:
    """Place of each active source in the order of priorities, null priorities last."""
    s = planning.active_sources(_states(spark, d, "active", "priority").select("source_id", "active", "priority")).select("source_id", F.lit("all").alias("key"), planning.priority_rank().alias("rank"))
    # priorities are few; within one, ids are cut by their first signs
    slices = F.concat(F.format_string("%010d", F.col("rank") + 1_000_000_000), F.rpad(F.substring("source_id", 1, 6), 6, " "))
    return ordering.places(s, "key", slices, [F.col("rank"), F.col("source_id")]).select("source_id", "place")


_BEST = """select detector_id, max(case when calibration_type = 'spectral_wcs' then calibration_id end) as spectral_wcs_id, max(case when calibration_type = 'solid_angle' then calibration_id end) as solid_angle_id
from (select *, row_number() over (partition by release, calibration_type, detector_id order by validated_at desc, calibration_id) as rn from calibration_products where validated_at is not null and release = 'r1') where rn = 1 group by 1"""


def _by_detector(spark: SparkSession, d: str) -> DataFrame:
    best = calibration.best_products(load(spark, d, "calibration_products").filter("release = 'r1'"))
    return planning.calibrations_by_detector(best, ["spectral_wcs", "solid_angle"])


@query(f"""with m as (select source_id, product_id, count(*) as n_measurements, max(created_at) as last_measured from ({_MEASURED}) where product_id is not null and science_recommended = 1 group by 1, 2)
select l.source_id, l.product_id, s.source_type, p.detector_id, c.spectral_wcs_id, c.solid_angle_id, m.n_measurements, m.last_measured, m.source_id is not null as measured
from ({_LINKS}) l left join ({_STATES}) s using (source_id) left join ({_PRODUCTS}) p using (product_id) left join ({_BEST}) c using (detector_id) left join m on m.source_id = l.source_id and m.product_id = l.product_id""")
def plan_work_items(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of source and product with its calibrations, and whether there is a measurement of it that is fit for science."""
    m = _measured(spark, d).filter("product_id is not null and science_recommended = 1").groupBy("source_id", "product_id").agg(F.count(F.lit(1)).alias("n_measurements"), F.max("created_at").alias("last_measured"))
    items = planning.work_items(_links(spark, d), _states(spark, d, "source_type").select("source_id", "source_type"), _products(spark, d, "detector_id").select("product_id", "detector_id"), _by_detector(spark, d), m)
    return items.select("source_id", "product_id", "source_type", "detector_id", "spectral_wcs_id", "solid_angle_id", "n_measurements", "last_measured", "measured")


@query(f"""select l.source_id, l.product_id, s.source_name, p.collection, p.obs_id, p.detector_id from ({_LINKS}) l join ({_STATES}) s using (source_id) join ({_PRODUCTS}) p using (product_id)""")
def discovery_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of source and product with what names them."""
    return _links(spark, d).join(_states(spark, d, "source_name").select("source_id", "source_name"), "source_id").join(_products(spark, d, "collection", "obs_id", "detector_id").select("product_id", "collection", "obs_id", "detector_id"), "product_id")


@query(f"""select s.source_id, s.active, coalesce(n, 0) as n_measurements, coalesce(n_science, 0) as n_science, coalesce(last_run, '-') as last_run
from ({_STATES}) s left join (select source_id, count(*) as n, count(*) filter (where science_recommended = 1) as n_science, max(photometry_run_id) as last_run from ({_MEASURED}) group by 1) m using (source_id)""")
def source_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Every source, measured or not, with counts of its measurements."""
    m = _measured(spark, d).groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("science_recommended") == 1).alias("s"), F.max("photometry_run_id").alias("r"))
    return _states(spark, d, "active").select("source_id", "active").join(m, "source_id", "left").select("source_id", "active", F.coalesce("n", F.lit(0)).alias("n_measurements"), F.coalesce("s", F.lit(0)).alias("n_science"), F.coalesce("r", F.lit("-")).alias("last_run"))


@query(f"select product_id, detector_id from ({_PRODUCTS}) where product_id not in (select product_id from measurements where product_id is not null)")
def unmeasured_products(spark: SparkSession, d: str) -> DataFrame:
    """Products that no measurement was made of."""
    return planning.left_over(_products(spark, d, "detector_id").select("product_id", "detector_id"), load(spark, d, "measurements").filter("product_id is not null"), ["product_id"])


@query(f"""with f as (select source_id, product_id, created_at, measurement_id, detection_status from ({_MEASURED}) where science_recommended = 0 and source_id is not null and product_id is not null),
o as (select distinct source_id, product_id from ({_MEASURED}) where science_recommended = 1)
select * from (select distinct on (source_id, product_id) * from f order by source_id, product_id, created_at, measurement_id) x where not exists (select 1 from o where o.source_id = x.source_id and o.product_id = x.product_id)""")
def first_failures(spark: SparkSession, d: str) -> DataFrame:
    """The first measurement not fit for science of each source and product that has none that is."""
    m = _measured(spark, d).filter("source_id is not null and product_id is not null").select("source_id", "product_id", "created_at", "measurement_id", "detection_status", "science_recommended")
    failed = m.filter("science_recommended = 0").drop("science_recommended")
    return planning.first_failures(failed, m.filter("science_recommended = 1"), ["source_id", "product_id"], ["created_at", "measurement_id"])


@query(f"select source_id, source_name from ({_STATES}) s where exists (select 1 from measurements m where m.source_id = s.source_id and m.science_recommended = 1)")
def measured_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources with a measurement fit for science."""
    return _states(spark, d, "source_name").select("source_id", "source_name").join(load(spark, d, "measurements").filter("science_recommended = 1"), "source_id", "left_semi")


@query(f"""select measurement_id, source_id, detection_status from ({_MEASURED}) where photometry_run_id = (select max_by(photometry_run_id, (created_at, photometry_run_id)) from measurements where photometry_run_id is not null)""")
def latest_run_rows(spark: SparkSession, d: str) -> DataFrame:
    """Measurements of the run that was measured last."""
    m = _measured(spark, d).select("measurement_id", "source_id", "detection_status", "photometry_run_id")
    run = planning.latest_run(load(spark, d, "measurements").filter("photometry_run_id is not null"), "photometry_run_id", "created_at")
    return planning.of_run(m, run).drop("photometry_run_id")


@query(f"""select detection_status, count(*) as n from ({_MEASURED}) where detection_status in ('detected', 'non_detection') group by 1""")
def run_status_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of some statuses over all runs: a null run is every run."""
    m = _measured(spark, d).select("photometry_run_id", "detection_status")
    return planning.of_run(m, F.lit(None).cast("string"), ["detected", "non_detection"]).groupBy("detection_status").agg(F.count(F.lit(1)).alias("n"))


@query(f"""select measurement_id, array_to_string(list_filter(x, lambda f, i: list_position(x, f) = i)[1:8], ';') as key_flags
from (select measurement_id, list_filter(list_transform(string_split(coalesce(photometry_flags, ''), ';'), lambda f: trim(f)), lambda f: f <> '') as x from ({_MEASURED}))""")
def measurement_key_flags(spark: SparkSession, d: str) -> DataFrame:
    """The first eight distinct flags of each measurement."""
    m = _measured(spark, d).select("measurement_id", "photometry_flags")
    return m.select("measurement_id", F.array_join(planning.key_flags(selection.flag_list(F.col("photometry_flags"))), ";").alias("key_flags"))


@query(f"""select cast(sum(n) as bigint) as n_measurements, cast(sum(n_science) as bigint) as n_science, max(seconds) as seconds from
(select source_id, count(*) as n, count(*) filter (where science_recommended = 1) as n_science, epoch(max(created_at)) - epoch(min(created_at)) as seconds from ({_MEASURED}) group by 1)""")
def merged_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of all sources as one row: sums of counts, the longest time."""
    micros = lambda c: F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({c} as timestamp_ntz))")
    parts = _measured(spark, d).groupBy("source_id").agg(F.count(F.lit(1)).alias("n_measurements"), F.count_if(F.col("science_recommended") == 1).alias("n_science"), F.max("created_at").alias("b"), F.min("created_at").alias("a"))
    return planning.merged_counters(parts.withColumn("seconds", micros("b") / 1e6 - micros("a") / 1e6), ["n_measurements", "n_science"], ["seconds"])


@query("select detector_id from (select distinct detector_id from discovery_products union select detector_id from calibration_products) where detector_id is not null")
def needed_detectors(spark: SparkSession, d: str) -> DataFrame:
    """Detectors of products and calibrations."""
    a, b = (load(spark, d, t).select("detector_id").distinct() for t in ("discovery_products", "calibration_products"))
    return a.union(b).filter("detector_id is not null").distinct()


@query(f"""select obs_id, array_to_string(list_sort(list_filter(c, lambda x: x not like '%deep%')), ',') as allowed, array_to_string(list_sort(list_filter(c, lambda x: x like '%deep%')), ',') as excluded
from (select obs_id, list(distinct collection) as c from discovery_products where obs_id is not null and collection is not null group by 1)""")
def collection_sets(spark: SparkSession, d: str) -> DataFrame:
    """Collections that list each observation, those wanted and those left out, by set difference and intersection."""
    t = load(spark, d, "discovery_products").filter("obs_id is not null and collection is not null")
    held = t.groupBy("obs_id").agg(F.collect_set("collection").alias("c"))
    left_out = t.select("collection").distinct().filter("collection like '%deep%'").agg(F.collect_set("collection").alias("x")).select("x").scalar()
    text = lambda c: F.array_join(F.array_sort(c), ",")
    sets = held.withColumn("x", left_out).select("obs_id", F.array_except("c", "x").alias("allowed"), F.array_intersect("c", "x").alias("excluded"))
    return sets.select("obs_id", text("allowed").alias("allowed"), text("excluded").alias("excluded"))


@query(r"""select calibration_type, detector_id, max_by(calibration_id, (regexp_extract(local_path, '(\d{4}-\d{3})', 1), coalesce(try_cast(regexp_extract(local_path, '-v(\d+)', 1) as bigint), 0), local_path)) as calibration_id, max(local_path) is not null as has_path
from calibration_products group by 1, 2""")
def latest_calibrations(spark: SparkSession, d: str) -> DataFrame:
    """The file of the latest version of each kind and detector, by date, number and name."""
    t = load(spark, d, "calibration_products").select("calibration_type", "detector_id", "calibration_id", "local_path")
    return planning.latest_versions(t, "local_path", ["calibration_type", "detector_id"]).select("calibration_type", "detector_id", "calibration_id", F.col("local_path").isNotNull().alias("has_path"))


@query(f"""with r as (select distinct reference from (select spectral_wcs_calibration_id as reference from ({_MEASURED}) union all select left(solid_angle_calibration_id, 12) from ({_MEASURED})) where reference <> '')
select r.reference, c.calibration_id from r join calibration_products c on c.calibration_id = r.reference or contains(c.calibration_id, r.reference) or contains(c.local_path, r.reference)""")
def calibration_references(spark: SparkSession, d: str) -> DataFrame:
    """Calibrations that measurements name, by their whole id or a part of it."""
    m = _measured(spark, d).select("spectral_wcs_calibration_id", F.substring("solid_angle_calibration_id", 1, 12).alias("SAPM_CALID"))
    named = m.select(F.explode(F.array_compact(F.array(*planning.references(m.columns).values()))).alias("reference"))
    return planning.referenced_calibrations(named, load(spark, d, "calibration_products"), ["calibration_id", "local_path"])


@query(f"""select measurement_id, row_number() over (partition by source_id order by wavelength_um nulls first, measurement_id) - 1 as place from ({_MEASURED})""")
def reload_order(spark: SparkSession, d: str) -> DataFrame:
    """Place of each measurement in its source by wavelength, null first, and id."""
    rows = _measured(spark, d).select("measurement_id", "source_id", "wavelength_um")
    w = F.col("wavelength_um")
    slices = F.when(w.isNull(), -(1 << 20)).when(F.isnan(w), 1 << 20).otherwise(F.floor(F.greatest(F.lit(-1e4), F.least(F.lit(1e4), w)) * 50)).cast("int")
    return ordering.places(rows, "source_id", slices, [F.asc_nulls_first("wavelength_um"), F.col("measurement_id")]).select("measurement_id", "place")


@query(f"select s.source_id from ({_STATES}) s left join (select distinct source_id from ({_MEASURED}) where product_id is not null) l using (source_id) group by s.source_id having count(l.source_id) = 0")
def not_covered(spark: SparkSession, d: str) -> DataFrame:
    """Sources that no product covers, filtered after the count."""
    n = _states(spark, d).select("source_id").join(_links(spark, d).groupBy("source_id").agg(F.count(F.lit(1)).alias("n")), "source_id", "left")
    return n.filter(F.coalesce("n", F.lit(0)) == 0).select("source_id")


@query(f"""select m.source_id, count(*) as n_rows from ({_MEASURED}) m join (select distinct source_id from sources where retired_at is not null) r using (source_id) group by 1""")
def rows_to_clean(spark: SparkSession, d: str) -> DataFrame:
    """Measurements held for sources that were ever retired."""
    gone = load(spark, d, "sources").filter("retired_at is not null").select("source_id").distinct()
    return _measured(spark, d).select("source_id").join(gone, "source_id", "left_semi").groupBy("source_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""select calibration_id, {_ID('calibration_version', 'detector_id', 'processing_date', 'product_type', 'relative_path', 'release', 'sha256')} as identity
from (select calibration_id, null as calibration_version, detector_id, null as processing_date, calibration_type as product_type, local_path as relative_path, lower(release) as release, null as sha256 from calibration_products)""")
def calibration_identities(spark: SparkSession, d: str) -> DataFrame:
    """Identity of every calibration file."""
    t = load(spark, d, "calibration_products").select("calibration_id", "release", "detector_id", F.col("calibration_type").alias("product_type"), F.col("local_path").alias("relative_path"))
    return t.select("calibration_id", planning.calibration_id(t.columns).alias("identity"))


@query(f"""select measurement_id, {_ID('code_version', 'cutout_key', 'cutout_sha256', 'output_schema_version', 'photometry_config_hash', 'solid_angle_calibration_id', 'source_id', 'spectral_wcs_calibration_id')} as identity
from (select measurement_id, '1' as code_version, cast(product_id as varchar) as cutout_key, null as cutout_sha256, '2' as output_schema_version, 'c' as photometry_config_hash, solid_angle_calibration_id, source_id, spectral_wcs_calibration_id from ({_MEASURED}))""")
def measurement_identities(spark: SparkSession, d: str) -> DataFrame:
    """Identity of every measurement, its product standing for the cutout."""
    m = _measured(spark, d).select("measurement_id", "source_id", F.col("product_id").cast("string").alias("cutout_key"), F.lit(None).cast("string").alias("cutout_sha256"), "spectral_wcs_calibration_id", "solid_angle_calibration_id")
    return m.select("measurement_id", planning.measurement_id("c", "1", "2").alias("identity"))


_SLUG = lambda c, n: f"case when length({c}) <= {n} then {c} else rtrim(substr({c}, 1, {n - 9}), '_') || '_' || substr(sha1({c}), 1, 8) end"


@query(f"""with p as (select snapshot_row_id, coalesce(obs_id, 'unknown') as s, coalesce(regexp_replace(parent_filename, '\\.[^.]*$', ''), 'parent') as f, row_hash as k, coalesce(planning_period, 'unknown_period') as per, coalesce(processing_version, 'unknown_version') as ver, collection, detector_id from discovery_products)
select snapshot_row_id, 'data/cutouts/' || {_SLUG('s', 64)} || '/' || collection || '/' || {_SLUG('per', 64)} || '/' || {_SLUG('ver', 64)} || '/D' || coalesce(cast(detector_id as varchar), 'unknown') || '/'
  || {_SLUG('s', 64)} || '__' || {_SLUG('f', 96)} || '__sz180.0as__' || substr({_ID('collection', 'f')}, 1, 8) || '.fits' as path from p""")
def cutout_paths(spark: SparkSession, d: str) -> DataFrame:
    """Where the cutout of every listed product would be filed."""
    t = load(spark, d, "discovery_products").withColumn("f", F.coalesce(discovery.stem(F.col("parent_filename")), F.lit("parent")))
    name = discovery.cutout_file(F.col("obs_id"), F.col("parent_filename"), F.lit(180.0), stable_hash(texts("collection", "f")))
    return t.select("snapshot_row_id", discovery.cutout_path("data", F.col("obs_id"), F.col("collection"), F.col("planning_period"), F.col("processing_version"), F.col("detector_id"), name).alias("path"))


@query(r"""with f as (select snapshot_row_id, access_url, regexp_extract(regexp_replace(access_url, '[?#].*$', ''), '([^/]+)$', 1) as file_name, nullif(obs_id, '') as obs_id, try_cast(s_ra as double) as s_ra from discovery_products),
s as (select *, regexp_replace(file_name, '\.[^.]*$', '') as stem from f)
select snapshot_row_id, nullif(file_name, '') as parent_filename, coalesce(obs_id, nullif(regexp_extract(stem, '(?:^|[_-])([0-9]{4,})(?:[_-]|$)', 1), '')) as observation_id,
  try_cast(coalesce(nullif(regexp_extract(stem, '(?i)(?:^|[_-])(?:D|[0-9]D)([1-6])(?:[_\-.]|$)', 1), ''), nullif(regexp_extract(stem, '(?i)D([1-6])', 1), '')) as integer) as detector_id, s_ra from s""")
def service_rows(spark: SparkSession, d: str) -> DataFrame:
    """Listed products as rows of a search service, read by field names in other letters."""
    t = load(spark, d, "discovery_products").select("snapshot_row_id", F.col("access_url").alias("accessURL"), F.col("obs_id").alias("OBS_ID"), F.col("s_ra").cast("string").alias("S_RA"), "collection")
    out = discovery.normalize_products(t.withColumnRenamed("accessURL", "Access_Url"), F.col("snapshot_row_id"), F.col("collection"))
    return out.select(F.col("source_id").alias("snapshot_row_id"), "parent_filename", "observation_id", "detector_id", "s_ra")


@query(f"""with m as (select source_id, product_id, created_at, science_recommended = 1 as good from ({_MEASURED}) where source_id is not null and product_id is not null),
old as (select source_id, product_id, min(created_at) as first_seen_at, max(created_at) as last_seen_at from m where not good group by 1, 2), new as (select source_id, product_id, max(created_at) as last_seen_at from m where good group by 1, 2)
select source_id, product_id, coalesce(old.first_seen_at, new.last_seen_at) as first_seen_at, coalesce(new.last_seen_at, old.last_seen_at) as last_seen_at, new.last_seen_at is not null as active from old full join new using (source_id, product_id)""")
def match_states(spark: SparkSession, d: str) -> DataFrame:
    """Matches after those found again are taken in: pairs first known by poor measurements, then by good ones."""
    m = load(spark, d, "measurements").filter("source_id is not null and product_id is not null").select("source_id", "product_id", "created_at", "science_recommended")
    old = m.filter("science_recommended != 1").groupBy("source_id", "product_id").agg(F.min("created_at").alias("first_seen_at"), F.max("created_at").alias("last_seen_at")).withColumn("active", F.lit(False))
    return planning.upsert_matches(old, m.filter("science_recommended = 1").select("source_id", "product_id", F.col("created_at").alias("last_seen_at")))


@query("""with c as (select *, strftime(validated_at, '%Y%m%d') as calibration_date from calibration_products where validated_at is not null),
need as (select distinct d.detector_id, d.processing_date, k.release, k.calibration_type from (select distinct detector_id, replace(processing_date, '-', '') as processing_date from discovery_products) d, (select distinct release, calibration_type from calibration_products) k)
select release, calibration_type, detector_id, processing_date, calibration_id from (select need.*, c.calibration_id,
  row_number() over (partition by need.release, need.calibration_type, need.detector_id, need.processing_date order by (calibration_date is distinct from need.processing_date), validated_at desc, c.calibration_id) as rn
from need left join c on c.release = need.release and c.calibration_type = need.calibration_type and c.detector_id = need.detector_id) where rn = 1""")
def calibrations_for_dates(spark: SparkSession, d: str) -> DataFrame:
    """The calibration of every kind for each detector and processing date."""
    t = load(spark, d, "calibration_products")
    kinds = t.agg(F.collect_set(F.struct("release", "calibration_type")).alias("k")).select("k").scalar()  # a short list from the settings
    dates = load(spark, d, "discovery_products").select("detector_id", F.replace("processing_date", F.lit("-"), F.lit("")).alias("processing_date")).distinct()
    needed = dates.withColumn("k", F.explode(kinds)).select("detector_id", "processing_date", "k.*")
    return calibration.best_for_dates(needed, t.withColumn("calibration_date", F.date_format("validated_at", "yyyyMMdd")))


@query("""with b as (select distinct release, calibration_type, detector_id from calibration_products where validated_at is not null)
select n.release, n.calibration_type, n.detector_id from (select distinct 'r9' as release, calibration_type, detector_id from calibration_products union select distinct release, calibration_type, detector_id from calibration_products) n
where not exists (select 1 from b where b.release = n.release and b.calibration_type = n.calibration_type and b.detector_id = n.detector_id)""")
def missing_calibrations(spark: SparkSession, d: str) -> DataFrame:
    """Combinations of release, kind and detector without a valid product, those of a release to come included."""
    t = load(spark, d, "calibration_products").select("release", "calibration_type", "detector_id")
    needed = t.unionByName(t.withColumn("release", F.lit("r9"))).distinct()
    return calibration.missing(needed, calibration.best_products(load(spark, d, "calibration_products")))


@query("select source_id as key, count(*) as n_rows from (select distinct measurement_id, source_id from measurements) m where source_id is not null and not exists (select 1 from (" + _STATES + ") s where s.source_id = m.source_id and s.retired_at is null) group by 1")
def orphan_measurements(spark: SparkSession, d: str) -> DataFrame:
    """Sources of measurements that are not, or no longer, in the catalogue."""
    m = load(spark, d, "measurements").select("measurement_id", "source_id").distinct()
    return upsert.missing_parents(m, _states(spark, d, "retired_at").filter("retired_at is null"), "source_id", "source_id")


@query("select event_id, user_id, event_type from events")
def stream_without_repeats(spark: SparkSession, d: str) -> DataFrame:
    """Events of a stream that delivers its file twice, each once."""
    stream = _events(spark, d).select("event_id", "user_id", "event_type", "ts")
    once = events.without_repeats(stream.union(stream), "event_id", "400 days")
    return events.run_to_table(once.select("event_id", "user_id", "event_type"), "append")


# ---- records of catalogue drops: reading them and taking them into the table of sources

_FIELD = '("(?:[^"]|"")*"|[^",]*),'
_CELLS = lambda c: f"list_transform(regexp_extract_all({c} || ',', '{_FIELD}', 1), lambda x: case when x like '\"%' then replace(substr(x, 2, length(x) - 2), '\"\"', '\"') else x end)"
_BLANK = "chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)"
_VALUE = lambda name: f"coalesce(x[list_position(h, '{name}')], '')"
_AS_NUMBER = lambda name: f"case when regexp_full_match(trim({_VALUE(name)}, {_BLANK}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then cast(trim({_VALUE(name)}, {_BLANK}) as double) end"
_RECORDS = f"""
with recursive hd as (select coalesce(file_id, '') as file, arg_min(coalesce(raw_line, ''), record_id) as header from input_catalog where line_no = 1 group by 1),
rec as (select record_id, file_id, line_no, coalesce(raw_line, '') as raw, header from input_catalog left join hd on hd.file = coalesce(file_id, '') where line_no is distinct from 1),
cut as (select *, regexp_full_match(raw, '(?s)("(?:[^"]|"")*"|[^",]*)(,("(?:[^"]|"")*"|[^",]*))*') as ok, {_CELLS('raw')} as x, list_transform({_CELLS('header')}, lambda n: trim(n, {_BLANK})) as h from rec),
val as (select *, trim({_VALUE('Name')}, {_BLANK}) as name, {_AS_NUMBER('RA_deg')} as ra, {_AS_NUMBER('DEC_deg')} as dec, trim({_VALUE('cutout_size_arcsec')}, {_BLANK}) as size_text, {_AS_NUMBER('cutout_size_arcsec')} as size, {_VALUE('notes')} as note from cut),
read as (select record_id, file_id, line_no, case when not ok then 'quoting' when header is null or len(x) <> len(h) then 'column_count' when name = '' then 'bad_name' when not coalesce(ra >= 0 and ra < 360, false) then 'bad_ra'
  when not coalesce(dec between -90 and 90, false) then 'bad_dec' when size_text <> '' and not coalesce(size between 6 and 3600, false) then 'bad_size' end as reason, name, ra, dec, size, case when trim(note, {_BLANK}) <> '' then note end as notes from val)"""
# for the queries of problem 5
RECORDS_SQL = {
    "p5_found": _RECORDS + " select record_id, reason from read where reason is not null",
    "p5_rows": _RECORDS + " select record_id, file_id, name, ra as ra_deg, dec as dec_deg, size as cutout_size_arcsec, notes, line_no from read where reason is null",
}

_TAKEN = _RECORDS + f""",
rows as (select coalesce(nullif(trim(regexp_replace(regexp_replace(name, '\\s+', '_', 'g'), '[^A-Za-z0-9_.:-]+', '_', 'g'), '_'), ''), format('SRC_{{:06d}}', line_no - 1)) as source_id, name, ra, dec, size from read where reason is null),
marked as (select *, count(*) over (partition by source_id) as n from rows),
old as (select source_id, ra_deg, dec_deg, coalesce(active, 1) <> 0 as active from ({_STATES})),
new as (select source_id, ra, dec from marked where n = 1)"""


def _ingest(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    read = rejects.load_records(load(spark, d, "input_catalog")).filter("reason is null").select(F.col("name").alias("Name"), F.col("ra_deg").alias("RA_deg"), F.col("dec_deg").alias("DEC_deg"), "cutout_size_arcsec", "line_no")
    # a record's place in its file is no attribute of the source
    rows = catalog.normalize(read, position=F.col("line_no") - 1).drop("extra_json", "row_hash")
    rows = rows.withColumn("row_hash", catalog.row_hash(rows))
    now = F.lit("2026-02-01 00:00:00").cast("timestamp_ntz")
    cols = ["source_id", "source_name", "ra_deg", "dec_deg", "cutout_size_arcsec", "source_type", "priority", "active", "row_hash", "catalog_version_id", "first_seen_at", "last_seen_at", "retired_at"]
    table = _states(spark, d, *(c for c in cols if c not in ("source_id", "last_seen_at"))).withColumn("active", catalog.flag(F.col("active").cast("string"))).select(*cols)
    return catalog.ingest(rows, table, F.lit("cat_next"), now)


@query(_TAKEN + """
select coalesce(new.source_id, old.source_id) as source_id, case when new.source_id is not null then new.ra else old.ra_deg end as ra_deg, case when new.source_id is not null then new.dec else old.dec_deg end as dec_deg,
  new.source_id is not null as active from old full join new using (source_id)""")
def ingest_states(spark: SparkSession, d: str) -> DataFrame:
    """The table of sources after all catalogue drops were read, normalised and taken in."""
    return _ingest(spark, d)["table"].select("source_id", "ra_deg", "dec_deg", "active")


@query(_TAKEN + """
select (select count(*) from marked) as n_rows_input, (select count(*) from marked where n = 1) as n_rows_valid, (select count(*) from marked where n > 1) as n_rows_invalid,
  (select count(*) from new where source_id not in (select source_id from old)) as n_new, (select count(*) from old where source_id not in (select source_id from new)) as n_missing""")
def ingest_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The row of the catalogue's version: what came in, and what it changed."""
    return _ingest(spark, d)["version"].select("n_rows_input", "n_rows_valid", "n_rows_invalid", "n_new", "n_missing")
