"""Coverage of sources, counts of runs and tables, and digests of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage(sources: DataFrame, links: DataFrame, products: DataFrame, measurements: DataFrame) -> DataFrame:
    """One row per source: how many products cover it, in which detectors, periods and versions, over which wavelengths and times, and its measurements.

    ``links`` is distinct ``source_id, product_id``. Products and measurements are aggregated per source each on its
    own before they meet the source, so that one side's rows never multiply the other's.
    """
    seen = links.join(products, "product_id").groupBy("source_id").agg(
        F.count_distinct("product_id").alias("n_products"), F.count_distinct("detector_id").alias("n_detectors"), F.array_join(F.array_sort(F.collect_set(F.concat(F.lit("D"), "detector_id"))), ",").alias("detectors"),
        F.count_distinct("planning_period").alias("n_periods"), F.count_distinct("processing_version").alias("n_versions"), F.min("em_min").alias("em_min"), F.max("em_max").alias("em_max"), F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max"),
    )
    done = measurements.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_measured"), F.count_if(F.col("science_recommended") == 1).alias("n_science"), F.count_if(F.col("detection_status").startswith("invalid")).alias("n_invalid"))
    out = sources.join(seen, "source_id", "left").join(done, "source_id", "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("n_products", "n_detectors", "n_periods", "n_versions", "n_measured", "n_science", "n_invalid")}
    out = out.withColumns(counts)
    return out.withColumn("coverage_status", F.when(F.col("n_products") > 0, "covered").otherwise("not_covered"))


def histogram_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """``key, counts``: a text of value:count pairs in the values' order."""
    pairs = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.coalesce(value, F.lit("-")), "n"))), ",").alias("counts"))


def digest(row_hash: Column) -> Column:
    """An order-free digest of many rows: the sum of the first 48 bits of each row's hash. It merges like any sum, so no task gathers the rows."""
    return F.sum(F.conv(F.substring(row_hash, 1, 12), 16, 10).cast("decimal(30,0)")).cast("string")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def human_bytes(n: Column) -> Column:
    """A size in B, KiB, MiB, GiB or TiB with one decimal from KiB on."""
    out = F.format_string("%d B", n)
    for power, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), 1):
        out = F.when(n >= 1024**power, F.format_string(f"%.1f {unit}", n / 1024.0**power)).otherwise(out)
    return out
