"""Queries of the general data problems, each over its whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.scalars import digest_text, epoch_micros
from skyloom.operators import history, rejects, skyjoin, snapshots, spikes, treeagg
from skyloom.session import load

HEAVY_SHARE = 0.04
NEAR_DEG = 3 / 3600


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Observations and targets that hold more than 4 % of their table's rows."""
    parts = [treeagg.heavy_keys(load(spark, d, t), k, HEAVY_SHARE).select(F.lit(t).alias("table_name"), F.col(k).alias("key_value")) for t, k in (("discovery_products", "obs_id"), ("sources", "source_id"))]
    return parts[0].unionByName(parts[1])


def p1_observations(spark: SparkSession, d: str) -> DataFrame:
    """Counts and latest state of every observation, crowded ones included."""
    t = load(spark, d, "discovery_products")
    merges = {
        "n_rows": treeagg.rows(),
        "n_bytes": treeagg.total(F.col("access_estsize")),
        "first_snapshot": treeagg.smallest(F.col("snapshot_no")),
        "latest": treeagg.latest([F.col("last_seen_at"), F.col("snapshot_row_id")], {"row_hash": digest_text("row_hash"), "processing_version": F.col("processing_version")}),
    }
    out = treeagg.tree_aggregate(t, ["obs_id"], merges)
    return out.select("obs_id", "n_rows", "n_bytes", "first_snapshot", F.col("latest.o1").alias("latest_row_id"), F.col("latest.row_hash").alias("latest_hash"), F.col("latest.processing_version").alias("latest_version"))


def p1_targets(spark: SparkSession, d: str) -> DataFrame:
    """Counts and latest state of every target."""
    t = load(spark, d, "sources")
    merges = {
        "n_rows": treeagg.rows(),
        "n_retirements": treeagg.count_of(F.col("retired_at")),
        "latest": treeagg.latest([F.col("last_seen_at"), F.col("source_pk")], {"row_hash": digest_text("row_hash"), "active": F.col("active")}),
    }
    out = treeagg.tree_aggregate(t, ["source_id"], merges)
    return out.select("source_id", "n_rows", "n_retirements", F.col("latest.o1").alias("latest_pk"), F.col("latest.row_hash").alias("latest_hash"), F.col("latest.active").alias("latest_active"))


def _measurements(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "measurements")
    return t.withColumn("created_us", epoch_micros(t, "created_at"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.score_readings(_measurements(spark, d), flagged_only=True).select("measurement_id", "field_name").distinct()


def p2_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every reading with its score, and the reason for the wrong ones."""
    return spikes.score_readings(_measurements(spark, d))


def p2_rules(spark: SparkSession, d: str) -> DataFrame:
    """The readings that are wrong by a rule alone: impossible or frozen ones."""
    found = spikes.score_readings(_measurements(spark, d), flagged_only=True).filter("reason in ('limit', 'frozen')")
    return found.select("measurement_id", "field_name", "reason").distinct()


def _product_intervals(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "discovery_products")
    state = {"row_hash": digest_text("row_hash"), "processing_version": F.col("processing_version")}
    return snapshots.validity_intervals(t, digest_text("product_signature"), "snapshot_no", state, [F.col("last_seen_at"), F.col("snapshot_row_id")])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.change_events(_product_intervals(spark, d)).select(F.col("snapshot_no").cast("int").alias("snapshot_no"), F.col("key").alias("product_signature"), "change_type")


def p3_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Each content of each product with the first and last snapshot of an unbroken stretch in which it was listed."""
    at = lambda c: F.element_at("delivered", F.col(c)).cast("int")
    return _product_intervals(spark, d).select(F.col("key").alias("product_signature"), F.col("s_row_hash").alias("row_hash"), F.col("s_processing_version").alias("processing_version"), at("first_ord").alias("first_snapshot"), at("last_ord").alias("last_snapshot"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    s, p = load(spark, d, "sources"), load(spark, d, "discovery_products")
    src = skyjoin.positions(s.select(F.concat(F.lit("src:"), "source_id").alias("loc"), F.col("ra_deg").alias("ra"), F.col("dec_deg").alias("dec")))
    prd = skyjoin.positions(p.select(F.concat(F.lit("prd:"), digest_text("product_signature")).alias("loc"), F.col("s_ra").alias("ra"), F.col("s_dec").alias("dec")))
    return skyjoin.near_pairs(src, prd, NEAR_DEG)


def p4_regions(spark: SparkSession, d: str) -> DataFrame:
    """Sources and the products whose region on the sky holds one of their positions."""
    s, p = load(spark, d, "sources"), load(spark, d, "discovery_products")
    areas = skyjoin.regions(p.select(digest_text("product_signature").alias("loc"), F.col("s_region").alias("region")))
    held = skyjoin.containing_regions(skyjoin.positions(s.select(F.col("source_id").alias("loc"), F.col("ra_deg").alias("ra"), F.col("dec_deg").alias("dec"))), areas)
    return held.select(F.col("loc").alias("source_id"), F.col("region_loc").alias("product_signature"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects.load_records(load(spark, d, "input_catalog")).filter("reason is not null").select("record_id", "reason")


def p5_rows(spark: SparkSession, d: str) -> DataFrame:
    """The records that can be loaded, typed."""
    return rejects.load_records(load(spark, d, "input_catalog")).filter("reason is null").drop("reason")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "sources")
    log = t.select(F.col("source_id").alias("key"), epoch_micros(t, "last_seen_at").alias("t"), F.col("source_pk").alias("tie"), digest_text("row_hash").alias("value"), epoch_micros(t, "retired_at").alias("closed_at"))
    h = history.entity_history(log)
    return h.select(F.col("key").alias("source_id"), F.col("value").alias("row_hash"), history.whole_seconds(F.col("valid_from")).alias("valid_from_s"), F.coalesce(history.whole_seconds(F.col("valid_to")), F.lit(-1)).cast("bigint").alias("valid_to_s"))


QUERIES = {f.__name__: f for f in (p1_found, p1_observations, p1_targets, p2_found, p2_scores, p2_rules, p3_found, p3_intervals, p4_found, p4_regions, p5_found, p5_rows, p6_found)}

_TRIM = "lower(trim({}, chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)))"

_LISTED = f"""
with d as (
  select {_TRIM.format('product_signature')} as sig, snapshot_no, {_TRIM.format('row_hash')} as h, processing_version as v,
    row_number() over (partition by {_TRIM.format('product_signature')}, snapshot_no order by last_seen_at desc nulls last, snapshot_row_id desc) as rn
  from discovery_products where product_signature is not null and snapshot_no is not null),
l as (select sig, snapshot_no, h, v from d where rn = 1),
n as (select snapshot_no, row_number() over (order by snapshot_no) as ord from (select distinct snapshot_no from discovery_products where snapshot_no is not null)),
x as (select l.*, n.ord from l join n using (snapshot_no))"""

SQL = {
    "p1_found": """
select 'discovery_products' as table_name, obs_id as key_value from discovery_products where obs_id is not null group by obs_id
having count(*) > 0.04 * (select count(*) from discovery_products)
union all
select 'sources', source_id from sources where source_id is not null group by source_id having count(*) > 0.04 * (select count(*) from sources)""",
    "p1_observations": f"""
select obs_id, count(*) as n_rows, cast(sum(access_estsize) as bigint) as n_bytes, min(snapshot_no) as first_snapshot,
  last(snapshot_row_id order by last_seen_at nulls first, snapshot_row_id) as latest_row_id,
  last({_TRIM.format('row_hash')} order by last_seen_at nulls first, snapshot_row_id) as latest_hash,
  last(processing_version order by last_seen_at nulls first, snapshot_row_id) as latest_version
from discovery_products group by obs_id""",
    "p1_targets": f"""
select source_id, count(*) as n_rows, count(retired_at) as n_retirements, last(source_pk order by last_seen_at nulls first, source_pk) as latest_pk,
  last({_TRIM.format('row_hash')} order by last_seen_at nulls first, source_pk) as latest_hash,
  last(active order by last_seen_at nulls first, source_pk) as latest_active
from sources group by source_id""",
    # runs of one value are counted on values rounded to six digits, written with an exponent
    "p2_rules": """
with m as (select distinct measurement_id, source_id, photometry_run_id, created_at, point_flux_uJy, wavelength_um, chi2_reduced from measurements),
v as (select measurement_id, source_id, photometry_run_id, created_at, unnest(['point_flux_uJy', 'wavelength_um', 'chi2_reduced']) as field_name, unnest([point_flux_uJy, wavelength_um, chi2_reduced]) as value from m),
h as (select *, printf('%.5e', value) as digits from v where value is not null),
r as (select *, case when digits is not distinct from lag(digits) over w then 0 else 1 end as fresh from h window w as (partition by source_id, photometry_run_id, field_name order by created_at, measurement_id)),
g as (select *, sum(fresh) over (partition by source_id, photometry_run_id, field_name order by created_at, measurement_id) as island from r),
n as (select *, count(*) over (partition by source_id, photometry_run_id, field_name, island) as size from g)
select distinct measurement_id, field_name, case when isnan(value) or isinf(value) or (field_name = 'wavelength_um' and not value between 0.7 and 5.1) or (field_name = 'chi2_reduced' and value < 0) then 'limit' else 'frozen' end as reason
from n where isnan(value) or isinf(value) or (field_name = 'wavelength_um' and not value between 0.7 and 5.1) or (field_name = 'chi2_reduced' and value < 0) or (size >= 5 and source_id is not null)""",
    "p3_found": _LISTED + """
select cast(n.snapshot_no as integer) as snapshot_no, coalesce(a.sig, b.sig) as product_signature,
  case when b.sig is null then 'removed' when a.sig is null then 'added' else 'changed' end as change_type
from x a full join x b on a.sig = b.sig and a.ord + 1 = b.ord
join n on n.ord = coalesce(b.ord, a.ord + 1)
where n.ord > 1 and (a.sig is null or b.sig is null or a.h is distinct from b.h or a.v is distinct from b.v)""",
    "p3_intervals": _LISTED + """,
m as (select *, case when lag(ord) over w = ord - 1 and lag(h) over w is not distinct from h and lag(v) over w is not distinct from v then 0 else 1 end as s from x window w as (partition by sig order by ord)),
g as (select *, sum(s) over (partition by sig order by ord) as island from m)
select sig as product_signature, any_value(h) as row_hash, min(v) as processing_version, cast(min(snapshot_no) as integer) as first_snapshot, cast(max(snapshot_no) as integer) as last_snapshot
from g group by sig, island""",
    "p4_found": f"""
with s as (select distinct 'src:' || source_id as loc, radians(ra_deg) as ra, radians(dec_deg) as dec from sources where source_id is not null and ra_deg is not null and dec_deg is not null),
p as (select distinct 'prd:' || {_TRIM.format('product_signature')} as loc, radians(s_ra) as ra, radians(s_dec) as dec from discovery_products where product_signature is not null and s_ra is not null and s_dec is not null),
b as (select * from s union all select * from p)
select distinct least(s.loc, b.loc) as loc_a, greatest(s.loc, b.loc) as loc_b from s join b on b.dec between s.dec - radians(4.0 / 3600) and s.dec + radians(4.0 / 3600) and s.loc <> b.loc
where degrees(2 * asin(least(1.0, sqrt(power(sin((b.dec - s.dec) / 2), 2) + cos(s.dec) * cos(b.dec) * power(sin((b.ra - s.ra) / 2), 2))))) <= 3.0 / 3600""",
    "p4_regions": f"""
with s as (select distinct source_id, radians(ra_deg) as ra, radians(dec_deg) as dec from sources where source_id is not null and ra_deg is not null and dec_deg is not null),
p as (select distinct {_TRIM.format('product_signature')} as sig, s_region, string_split(s_region, ' ')[3:] as x from discovery_products where product_signature is not null and s_region is not null),
v as (select sig, s_region, k, radians(cast(x[2 * k - 1] as double)) as ra, radians(cast(x[2 * k] as double)) as dec, radians(cast(x[3] as double)) as r from p, range(1, 9) t(k) where 2 * k <= len(x)),
m as (select sig, s_region, atan2(sum(cos(dec) * sin(ra)), sum(cos(dec) * cos(ra))) as ra, atan2(sum(sin(dec)), sqrt(power(sum(cos(dec) * sin(ra)), 2) + power(sum(cos(dec) * cos(ra)), 2))) as dec, max(k) as n from v group by sig, s_region),
q as (select s.source_id, m.sig, m.s_region, m.n, m.ra as ra0, m.dec as dec0, s.ra - m.ra as a, s.dec, sin(m.dec) * sin(s.dec) + cos(m.dec) * cos(s.dec) * cos(s.ra - m.ra) as ahead
  from m join s on s.dec between m.dec - radians(4) and m.dec + radians(4) where m.s_region like 'POLYGON%' and sin(m.dec) * sin(s.dec) + cos(m.dec) * cos(s.dec) * cos(s.ra - m.ra) > cos(radians(4))),
pt as (select *, cos(dec) * sin(a) / ahead as x, (cos(dec0) * sin(dec) - sin(dec0) * cos(dec) * cos(a)) / ahead as y from q),
pv as (select v.sig, v.s_region, v.k, cos(v.dec) * sin(v.ra - m.ra) / (sin(m.dec) * sin(v.dec) + cos(m.dec) * cos(v.dec) * cos(v.ra - m.ra)) as x,
    (cos(m.dec) * sin(v.dec) - sin(m.dec) * cos(v.dec) * cos(v.ra - m.ra)) / (sin(m.dec) * sin(v.dec) + cos(m.dec) * cos(v.dec) * cos(v.ra - m.ra)) as y
  from v join m using (sig, s_region) where s_region like 'POLYGON%'),
inside as (select pt.source_id, pt.sig from pt join pv v1 using (sig, s_region) join pv v2 on v2.sig = pt.sig and v2.s_region = pt.s_region and v2.k = v1.k % pt.n + 1
  group by pt.source_id, pt.sig, pt.s_region, pt.x, pt.y having sum(case when (v1.y > pt.y) <> (v2.y > pt.y) and pt.x < (v2.x - v1.x) * (pt.y - v1.y) / (v2.y - v1.y) + v1.x then 1 else 0 end) % 2 = 1)
select source_id, sig as product_signature from inside
union
select source_id, sig from s join (select * from v where k = 1 and s_region like 'CIRCLE%') c on s.dec between c.dec - c.r * 1.001 and c.dec + c.r * 1.001
where 2 * asin(least(1.0, sqrt(power(sin((c.dec - s.dec) / 2), 2) + cos(s.dec) * cos(c.dec) * power(sin((c.ra - s.ra) / 2), 2)))) <= c.r""",
    "p6_found": f"""
with r as (select source_id, last_seen_at as t, {_TRIM.format('row_hash')} as h, retired_at as c, row_number() over (partition by source_id, last_seen_at order by source_pk desc) as rn
  from sources where source_id is not null and last_seen_at is not null),
o as (select *, case when c is not null then 'closed' when h is null then 'null' else '=' || h end as st from r where rn = 1),
f as (select * from (select *, lag(st) over (partition by source_id order by t) as pst from o) where st is distinct from pst),
e as (select *, lead(coalesce(c, t)) over (partition by source_id order by t) as until from f)
select source_id, h as row_hash, cast(floor(epoch_us(t) / 1000000.0) as bigint) as valid_from_s, coalesce(cast(floor(epoch_us(until) / 1000000.0) as bigint), -1) as valid_to_s
from e where st <> 'closed'""",
}
