"""Queries on records around the survey: paths, payloads, table sets, freshness, rolling rates and keyed stream state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.functions import sky
from skyloom.operators import discovery, reports, upsert
from skyloom.plans.reference import _MEASURED, _PRODUCTS, _STATES, _events, _measured, _products, _states
from skyloom.session import load
from skyloom.streaming import events

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


# Patterns of a calibration's kind, detector and date in its path.
SPECTRAL, SOLID_ANGLE = "spectral_wcs|cwave|cband", "solid_angle|sapm"
PATH_DETECTOR = (r"(?i)(?:^|[/_.-])D([1-6])(?:[/_.-]|$)", r"(?i)det(?:ector)?[_-]?([1-6])")
PATH_DATE = discovery.DATE


@query(f"""
select calibration_id, case when regexp_matches(lower(local_path), '{SPECTRAL}') then 'spectral_wcs' when regexp_matches(lower(local_path), '{SOLID_ANGLE}') then 'solid_angle_pixel_map' end as kind,
  try_cast(coalesce(nullif(regexp_extract(local_path, '{PATH_DETECTOR[0]}', 1), ''), nullif(regexp_extract(local_path, '{PATH_DETECTOR[1]}', 1), '')) as integer) as detector,
  replace(nullif(regexp_extract(local_path, '{PATH_DATE}', 1), ''), '_', '-') as date from calibration_products""")
def calibration_paths(spark: SparkSession, d: str) -> DataFrame:
    """Kind, detector and date of calibration files from their paths."""
    c = F.col("local_path")
    kind = F.when(F.lower(c).rlike(SPECTRAL), "spectral_wcs").when(F.lower(c).rlike(SOLID_ANGLE), "solid_angle_pixel_map")
    detector = discovery.first_match(c, *PATH_DETECTOR).cast("int")
    return load(spark, d, "calibration_products").select("calibration_id", kind.alias("kind"), detector.alias("detector"), F.translate(discovery.first_match(c, discovery.DATE), "_", "-").alias("date"))


@query("""select collection, regexp_extract(access_url, '^[a-z]+://([^/?#]*)', 1) as host, count(*) as n_rows, cast(sum(access_estsize) as bigint) as n_bytes from discovery_products group by 1, 2""")
def hosts(spark: SparkSession, d: str) -> DataFrame:
    """Rows and bytes per collection and host."""
    host = F.when(F.col("access_url").isNotNull(), F.coalesce(F.lower(F.try_parse_url("access_url", F.lit("HOST"))), F.lit("")))
    return load(spark, d, "discovery_products").groupBy("collection", host.alias("host")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("access_estsize").alias("n_bytes"))


@query("select event_type, count(*) as n_events, count(k) as n_valid, cast(min(k) as bigint) as least, cast(max(k) as bigint) as most from (select event_type, try_cast(json_extract_string(props, '$.k') as bigint) as k from events) group by 1")
def event_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Range of a value inside the events' JSON; what is no JSON or lacks it counts as not valid."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return load(spark, d, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.count("k").alias("n_valid"), F.min("k").alias("least"), F.max("k").alias("most"))


@query("""select coalesce(s.source_id, m.source_id) as source_id, s.source_id is not null as in_catalog, m.source_id is not null as is_measured from (select distinct source_id from sources) s full join (select distinct source_id from measurements) m on s.source_id = m.source_id""")
def known_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources of any table, and which tables know them."""
    parts = [load(spark, d, t).select("source_id").distinct().withColumn("t", F.lit(t)) for t in ("sources", "measurements")]
    both = parts[0].unionByName(parts[1]).filter("source_id is not null").groupBy("source_id").agg(F.bool_or(F.col("t") == "sources").alias("in_catalog"), F.bool_or(F.col("t") == "measurements").alias("is_measured"))
    return both


@query(f"select measurement_id, source_id from ({_MEASURED}) m where not exists (select 1 from ({_STATES}) s where s.source_id = m.source_id and s.retired_at is null)")
def measurements_of_retired(spark: SparkSession, d: str) -> DataFrame:
    """Measurements that a deletion of retired and unknown sources would take along."""
    alive = _states(spark, d, "retired_at").filter("retired_at is null").select("source_id")
    return _measured(spark, d).select("measurement_id", "source_id").join(alive, "source_id", "left_anti").select("measurement_id", "source_id")


_DIGEST = "cast(sum(cast('0x' || substr(measurement_id, 1, 12) as bigint)) as varchar)"


@query(f"""with r as (select max(created_at) - interval '30 days' as cut from measurements), a as (select source_id, count(*) as n, {_DIGEST} as digest from ({_MEASURED}) group by 1),
b as (select source_id, {_DIGEST} as digest from ({_MEASURED}), r where created_at <= cut group by 1)
select a.source_id, a.n as n_measurements, a.digest, coalesce(a.digest = b.digest, false) as fresh from a left join b using (source_id)""")
def output_freshness(spark: SparkSession, d: str) -> DataFrame:
    """Whether an output written thirty days before the last measurement still holds each source's set of measurements."""
    m = _measured(spark, d).select("measurement_id", "source_id", "created_at")
    cut = m.agg((F.max("created_at") - F.expr("interval 30 days")).alias("cut")).select("cut").scalar()
    now = m.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_measurements"), reports.digest(F.col("measurement_id")).alias("digest"))
    then = m.filter(F.col("created_at") <= cut).groupBy("source_id").agg(reports.digest(F.col("measurement_id")).alias("then"))
    return now.join(then, "source_id", "left").select("source_id", "n_measurements", "digest", F.coalesce(F.col("digest") == F.col("then"), F.lit(False)).alias("fresh"))


@query(f"""select photometry_run_id, count(*) as n_sources, count(*) filter (where bad = 0) as n_complete, count(*) filter (where bad > 0 and bad < n) as n_partial, count(*) filter (where bad = n) as n_failed
from (select photometry_run_id, source_id, count(*) as n, count(*) filter (where point_flux_uJy is null or isnan(point_flux_uJy) or isinf(point_flux_uJy)) as bad from ({_MEASURED}) group by 1, 2) group by 1""")
def run_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Per run: sources measured wholly, in part and not at all."""
    f = F.col("point_flux_uJy")
    bad = f.isNull() | F.isnan(f) | (F.abs(f) == float("inf"))
    per = _measured(spark, d).groupBy("photometry_run_id", "source_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))
    return per.groupBy("photometry_run_id").agg(F.count(F.lit(1)).alias("n_sources"), F.count_if(F.expr("bad = 0")).alias("n_complete"), F.count_if(F.expr("bad > 0 and bad < n")).alias("n_partial"), F.count_if(F.expr("bad = n")).alias("n_failed"))


@query("select event_id, user_id, count(*) over w as n_recent, round(sum(value) over w, 6) as recent from events window w as (partition by user_id order by ts range between interval '2 hours' preceding and current row)")
def event_rates(spark: SparkSession, d: str) -> DataFrame:
    """Events and value of each user over the two hours up to each event.

    A user's time is cut into slices of two hours; an event needs only its own slice and the one before, so each
    slice's events go to both, and a user with most events makes no large group.
    """
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "value").withColumn("us", F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"))
    width = 7_200_000_000
    own = ((F.col("us") - F.pmod(F.col("us"), F.lit(width))) / width).cast("bigint")
    twice = e.withColumn("own", own).withColumn("slice", F.explode(F.array(F.col("own"), F.col("own") + 1)))
    w = Window.partitionBy("user_id", "slice").orderBy("us").rangeBetween(-width, 0)
    out = twice.withColumn("n_recent", F.count(F.lit(1)).over(w)).withColumn("recent", F.round(F.sum("value").over(w), 6))
    return out.filter("own = slice").select("event_id", "user_id", "n_recent", "recent")


@query(f"""
with p as (select product_id, s_ra as ra, s_dec as dec from (select *, row_number() over (partition by product_id order by last_seen_at desc nulls last, snapshot_row_id desc) as rn from discovery_products where s_ra is not null and s_dec is not null) where rn = 1),
q as (select product_id, ra, dec, radians(dec + 0.02) as d, radians(dec) as d0, radians(0.03) as a from p), h as (select *, sin(d0) * sin(d) + cos(d0) * cos(d) * cos(a) as ahead from q)
select product_id, round(12 - degrees(cos(d) * sin(a) / ahead) * 3600 / 6, 6) as x, round(12 + degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(a)) / ahead) * 3600 / 6, 6) as y from h where ahead > 0""")
def sky_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Where a place beside each product's pointing falls on an image of 6-arcsecond pixels around it."""
    t = load(spark, d, "discovery_products").select("product_id", "s_ra", "s_dec", "last_seen_at", "snapshot_row_id").filter("s_ra is not null and s_dec is not null")
    p = upsert.last_per_key(t, ["product_id"], ["last_seen_at", "snapshot_row_id"])
    x, y = sky.to_pixel(F.col("s_ra") + 0.03, F.col("s_dec") + 0.02, F.col("s_ra"), F.col("s_dec"), 6 / 3600, 12.0, 12.0)
    return p.select("product_id", F.round(x, 6).alias("x"), F.round(y, 6).alias("y")).filter("x is not null")


@query(f"select product_id, epoch_us(make_timestamp(cast(round((t_min - 40587) * 86400) as bigint) * 1000000)) // 1000000 as start_s from ({_PRODUCTS}) where t_min is not null")
def product_times(spark: SparkSession, d: str) -> DataFrame:
    """Start of each product's exposure in whole seconds since 1970."""
    return _products(spark, d, "t_min").filter("t_min is not null").select("product_id", F.unix_seconds(F.timestamp_seconds(F.round((F.col("t_min") - 40587) * 86400).cast("bigint"))).alias("start_s"))


@query("select distinct user_id, event_type from events")
def stream_distinct_pairs(spark: SparkSession, d: str) -> DataFrame:
    """User and type of all events, each once, by a stream that drops repeats."""
    stream = _events(spark, d).select("user_id", "event_type", "ts").withWatermark("ts", "1 hour").select("user_id", "event_type").dropDuplicates()
    return events.run_to_table(stream, "append")


@query("select user_id from events group by 1 having count(*) >= 50")
def stream_completed_users(spark: SparkSession, d: str) -> DataFrame:
    """Users who reached fifty events, by the stream's own counts."""
    return events.run_to_table(events.completed(_events(spark, d), "user_id", 50), "complete").select("user_id")
