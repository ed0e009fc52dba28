"""Queries of physical units, detector maps and point-spread functions, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators import psf, units
from skyloom.plans.reference import _PRODUCTS, _ROUND, _ZONES, _images, _products
from skyloom.session import load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


_AT = """e as (select vec_id as image_id, unnest(embedding) as value, generate_subscripts(embedding, 1) - 1 as i from embeddings),
p as (select image_id, i, i % 8 as x, i // 8 as y, cast(value as double) as value, (5 + (image_id * 7 + i * 3) % 11) / 1000.0 as variance from e)"""


def _grid(f) -> F.Column:
    """An array over an image's pixels from a function of their column and row."""
    return F.transform(F.sequence(F.lit(0), F.size("value") - 1), lambda i: f(i % 8, F.floor(i / 8)).cast("double"))


@query(f"""with {_AT}, s as (select *, (36 + 0.25 * x + 0.1 * y) / (206265.0 * 206265.0) * 1e12 as factor from p)
select image_id, round(sum(value * factor), 8) as total_ujy, round(sum(variance * factor * factor), 8) as variance_ujy2 from s group by 1""")
def image_microjansky(spark: SparkSession, d: str) -> DataFrame:
    """Every image as fluxes per pixel by a map of solid angles, summed."""
    i = _images(spark, d).withColumn("omega", units.to_steradian(_grid(lambda x, y: 36 + 0.25 * x + 0.1 * y)))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    return _ROUND(i.select("image_id", total(units.to_microjansky(F.col("value"), F.col("omega"))).alias("total_ujy"), total(units.variance_to_microjansky(F.col("variance"), F.col("omega"))).alias("variance_ujy2")))


@query(f"""with {_AT}, w as (select *, cast(1 + 0.01 * x + 0.002 * y as double) as wave, cast(0.02 + 0.001 * x as double) as band from p),
c as (select image_id, case when max(value) > 0 then arg_max(i, struct_pack(a := value, b := -i)) else 36 end as centre from w group by 1)
select w.image_id, round(coalesce(sum(value * wave) filter (where value > 0) / sum(value) filter (where value > 0), max(wave) filter (where i = centre)), 8) as wavelength_um,
  round(coalesce(sum(value * band) filter (where value > 0) / sum(value) filter (where value > 0), max(band) filter (where i = centre)), 8) as bandwidth_um,
  round(max(wave) filter (where i = centre), 8) as wavelength_center_um, round(max(band) filter (where i = centre), 8) as bandwidth_center_um,
  case when count(*) filter (where value > 0) > 0 then 'spectral_wcs_psf_weighted' else 'spectral_wcs_center' end as method from w join c using (image_id) group by 1""")
def image_bandwidth(spark: SparkSession, d: str) -> DataFrame:
    """Wavelength and bandwidth of every image, weighted by its own brightness, and those at its centre."""
    maps = _images(spark, d).withColumns({"wave": _grid(lambda x, y: 1 + 0.01 * x + 0.002 * y), "band": _grid(lambda x, y: 0.02 + 0.001 * x)})
    w = units.wavelength(F.col("wave"), F.col("band"), F.col("value"), 8, 8)
    return _ROUND(maps.select("image_id", *(c.alias(k) for k, c in w.items())))


@query(f"""with {_AT} select image_id, case when value > 0.2 then 4 when variance > 0.014 then 9 when x = 0 then 8 when power(x - 3.3, 2) + power(y - 3.6, 2) <= 4 then 3 when y > 5 then 2 else 1 end as code, count(*) as n_pixels from p group by 1, 2""")
def image_mask_codes(spark: SparkSession, d: str) -> DataFrame:
    """How many pixels of every image show each code of its mask map."""
    i = _images(spark, d)
    each = lambda f: F.transform(F.arrays_zip("value", "variance", F.sequence(F.lit(0), F.size("value") - 1).alias("i")), f)
    masks = {
        "fit_mask": each(lambda p: F.lit(True)), "background_mask": each(lambda p: F.floor(p["i"] / 8) > 5), "target_mask": each(lambda p: F.pow(p["i"] % 8 - 3.3, 2) + F.pow(F.floor(p["i"] / 8) - 3.6, 2) <= 4),
        "fit_exclude": each(lambda p: p["i"] % 8 == 0), "invalid_variance": each(lambda p: p["variance"] > 0.014), "neighbour": each(lambda p: p["value"] > 0.2),
    }
    return i.select("image_id", F.explode(units.mask_map(masks)).alias("code")).groupBy("image_id", "code").agg(F.count(F.lit(1)).alias("n_pixels"))


_PLACED = f"(select product_id, detector_id, cast((product_id * 37) % 2040 as double) as x, cast((product_id * 53) % 2040 as double) as y from ({_PRODUCTS}))"


def _placed(spark: SparkSession, d: str) -> DataFrame:
    return _products(spark, d, "detector_id").select("product_id", "detector_id", ((F.col("product_id") * 37) % 2040).cast("double").alias("x"), ((F.col("product_id") * 53) % 2040).cast("double").alias("y"))


@query(f"""with {_AT} select product_id, value from (select product_id, detector_id, cast(least(7, greatest(0, round_even(x / 250, 0))) as integer) as gx, cast(least(7, greatest(0, round_even(y / 250, 0))) as integer) as gy from {_PLACED}) q
left join p on p.image_id = q.detector_id and p.x = gx and p.y = gy""")
def detector_samples(spark: SparkSession, d: str) -> DataFrame:
    """A value of its detector's map at every product's place, rounded and kept within the map."""
    maps = _images(spark, d).select(F.col("image_id").alias("detector_id"), F.posexplode("value").alias("i", "value"))
    grid = maps.select("detector_id", F.floor(F.col("i") / 8).cast("int").alias("gy"), (F.col("i") % 8).cast("int").alias("gx"), "value")
    return psf.sample_map(_placed(spark, d).withColumns({"x": F.col("x") / 250, "y": F.col("y") / 250}), grid, 8, 8).select("product_id", "value")


@query(f"""with {_AT}, z as (select * from (values {", ".join(map(str, _ZONES))}) t(detector_id, zone, zx, zy)),
best as (select product_id, detector_id, zone from (select product_id, q.detector_id, zone, row_number() over (partition by product_id order by power(x - zx, 2) + power(y - zy, 2), zone) as rn from {_PLACED} q join z using (detector_id)) where rn = 1),
n as (select image_id, x, y, greatest(value, 0) / sum(greatest(value, 0)) over (partition by image_id) as q from p),
b as (select product_id, cast(floor(2.3 + (y - 3.5) / 2 + 0.5) as integer) as y, cast(floor(1.9 + (x - 3.5) / 2 + 0.5) as integer) as x, q from best join n on n.image_id = best.detector_id * 16 + best.zone),
w as (select product_id, y, x, sum(q) as weight from b where y between 0 and 4 and x between 0 and 4 and abs(x - 1.9) <= 2.5 and abs(y - 2.3) <= 2.5 group by 1, 2, 3)
select product_id, count(*) as n_pixels, round(sum(weight), 8) as total, round(max(weight), 8) as peak, sum(weight) < 0.98 as truncated from w group by 1""")
def psf_render(spark: SparkSession, d: str) -> DataFrame:
    """The point-spread function of every product's place, from the plane of its zone, summed into pixels."""
    zones = spark.createDataFrame(_ZONES, "detector_id int, zone int, zx double, zy double")
    cells = _images(spark, d).select("image_id", F.posexplode("value").alias("i", "p"))
    planes = cells.join(zones.select("detector_id", "zone", (F.col("detector_id") * 16 + F.col("zone")).cast("bigint").alias("image_id")), "image_id")
    planes = planes.select("detector_id", "zone", F.floor(F.col("i") / 8).cast("int").alias("py"), (F.col("i") % 8).cast("int").alias("px"), "p")
    places = _placed(spark, d).withColumnRenamed("product_id", "image_id").withColumns({"cutout_x": F.lit(1.9), "cutout_y": F.lit(2.3)})
    out = psf.render(places, zones, planes, 8, 2, 2, 5, 5)
    per = out.groupBy(F.col("image_id").alias("product_id")).agg(F.count(F.lit(1)).alias("n_pixels"), F.sum("weight").alias("total"), F.max("weight").alias("peak"))
    return _ROUND(per).withColumn("truncated", F.col("total") < psf.WHOLE)
