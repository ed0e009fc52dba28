"""Catalogue files of several formats in, manifests of several formats out."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.session import cut_lineage

ECSV_TYPES = {"bigint": "int64", "int": "int32", "double": "float64", "float": "float32", "boolean": "bool"}


def read_catalog(spark: SparkSession, path: str, breaks_in_fields: bool = False) -> DataFrame:
    """A catalogue by its suffix: CSV, ECSV (comment lines, then a header, fields between blanks), Parquet, or a FITS table.

    Fields are text but in Parquet. A CSV file is split among tasks unless its fields may hold line breaks.
    """
    kind = os.path.splitext(path.rstrip("/"))[1].lower()
    if kind == ".csv":
        return spark.read.csv(path, header=True, multiLine=breaks_in_fields, escape='"')
    if kind == ".ecsv":
        return spark.read.csv(path, header=True, sep=" ", comment="#", escape='"')
    if kind == ".parquet":
        return spark.read.parquet(path)
    if kind in (".fits", ".fit", ".fts"):
        from skyloom.sources.fits import read_fits_table

        return read_fits_table(spark, path)
    raise ValueError(f"no reader for catalogues in {kind or 'files without a suffix'}")


def catalog_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header alone; none where it can't be read."""
    try:
        return read_catalog(spark, path).columns
    except (AnalysisException, ValueError):
        return []


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """``name, size`` of a directory listing with one JSON object a line; lines that are none are skipped, sizes that are none are null."""
    rows = spark.read.schema("name string, size string").option("mode", "DROPMALFORMED").json(path).filter("name is not null")
    size = F.col("size").try_cast("bigint")
    return rows.select("name", F.when(size >= 0, size).alias("size"))


def files_under(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, length, modified, sha256`` of files, hashed where they are read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return raw.select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def export(df: DataFrame, path: str, kind: str) -> None:
    """Write a manifest as csv, parquet, json or ecsv; another kind is an error. Files are committed as a whole."""
    if kind == "csv":
        df.write.mode("overwrite").csv(path, header=True, escape='"')
    elif kind == "parquet":
        df.write.mode("overwrite").parquet(path)
    elif kind == "json":
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    elif kind == "ecsv":
        # every part file is an ECSV file of its own: its comment lines are rows of the text written before the cells
        head = ["# %ECSV 1.0", "# ---", "# datatype:", *(f"# - {{name: {n}, datatype: {ECSV_TYPES.get(t, 'string')}}}" for n, t in df.dtypes), " ".join(df.columns)]
        cell = lambda n: F.concat(F.lit('"'), F.replace(F.coalesce(F.col(n).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
        lines = df.select(F.concat_ws(" ", *(cell(n) for n in df.columns)).alias("value"))

        def parts(batches):
            first = True
            for b in batches:
                yield b.assign(value=b["value"]) if not first else _with_head(b, head)
                first = False

        lines.mapInPandas(parts, "value string").write.mode("overwrite").text(path)
    else:
        raise ValueError(f"no writer for {kind}")


def _with_head(batch, head: list[str]):
    import pandas as pd

    return pd.concat([pd.DataFrame({"value": head}), batch], ignore_index=True)


def digest_of(spark: SparkSession, path: str) -> str | None:
    """One SHA-256 over those of a written table's part files, in the order of these."""
    parts = files_under(spark, path, "part-*").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ""), 256).alias("d"))
    return parts.first().d


def export_all(tables: dict[str, DataFrame], folder: str, kinds: list[str], run_id: str) -> list[dict]:
    """Write every table in every kind under a run's name and as the latest; a failure is recorded and the rest goes on.

    Each table is computed and counted once. Gives a row per file written, with its rows and digest.
    """
    audit = []
    for name, df in tables.items():
        row = {"table_name": name, "n_rows": None, "sha256": None, "error": None}
        try:
            once = cut_lineage(df)
            row["n_rows"] = once.count()
        except PySparkException as e:
            audit.append(row | {"kind": None, "path": None, "error": str(e)[:200]})
            continue
        for kind in kinds:
            for stamp in (run_id, "latest"):
                one = row | {"kind": kind, "path": f"{folder}/{stamp}_{name}.{kind}"}
                try:
                    export(once, one["path"], kind)
                    one["sha256"] = digest_of(df.sparkSession, one["path"])
                except (PySparkException, ValueError) as e:
                    one |= {"error": str(e)[:200], "n_rows": None}
                audit.append(one)
    return audit


def refreshed(table: DataFrame, files: DataFrame, path: str = "local_path") -> DataFrame:
    """A table of files with what is there now: ``file_exists`` and ``file_size``, null where there is none."""
    there = files.select(F.col("path").alias(path), F.col("length").alias("file_size")).distinct()
    return table.drop("file_exists", "file_size").join(there, path, "left").withColumn("file_exists", F.col("file_size").isNotNull())


def storage(files: DataFrame) -> DataFrame:
    """One row: how many files and bytes there are."""
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))


def status_counts(checked: DataFrame) -> DataFrame:
    """Files per status of their checks."""
    return checked.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))


def write_snapshot(snapshot: DataFrame, folder: str) -> None:
    """A catalogue's valid rows under their version, and as the latest; a version written again takes its own place."""
    once = cut_lineage(snapshot)
    once.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("catalog_version_id").parquet(f"{folder}/versions")
    once.write.mode("overwrite").parquet(f"{folder}/latest")


def write_spectra(measurements: DataFrame, folder: str, slices: int = 1) -> DataFrame:
    """A spectrum file per source, and a manifest of their rows and wavelengths.

    Rows are in order of wavelength, detector, observation and id, nulls last. A source of many rows may be given
    several files, each a slice of the wavelengths.
    """
    order = [F.asc_nulls_last(c) for c in ("wavelength_um", "detector_id", "obs_id", "measurement_id") if c in measurements.columns]
    part = F.pmod(F.floor(F.coalesce("wavelength_um", F.lit(0.0)) * 100), F.lit(slices))
    rows = measurements.withColumn("__part", part).repartition("source_id", "__part").sortWithinPartitions("source_id", *order)
    rows.drop("__part").write.mode("overwrite").partitionBy("source_id").csv(f"{folder}/spectra", header=True)
    manifest = measurements.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("wavelength_um").alias("from_um"), F.max("wavelength_um").alias("to_um"))
    export(manifest, f"{folder}/manifest.json", "json")
    return manifest


def summary(coverage: DataFrame, failures: DataFrame, counts: DataFrame, n: int = 50) -> DataFrame:
    """One row of JSON: the first n sources of a coverage, the last n failures, and a row of counts. It is a preview; n is its size."""
    first = coverage.orderBy("source_id").limit(n).agg(F.sort_array(F.collect_list(F.struct("source_id", *(c for c in coverage.columns if c != "source_id")))).alias("coverage"))
    last = failures.orderBy(F.desc("created_at")).limit(n).agg(F.sort_array(F.collect_list(F.struct("created_at", *(c for c in failures.columns if c != "created_at"))), asc=False).alias("failures"))
    whole = counts.select(F.struct(*counts.columns).alias("counts"))
    return whole.withColumns({"coverage": first.scalar(), "failures": last.scalar()}).select(F.to_json(F.struct("counts", "coverage", "failures")).alias("summary"))
