"""Tables in VOTable XML by Spark's XML source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators.discovery import from_fields


def field_names(spark: SparkSession, path: str) -> list[str]:
    """The names of a table's fields in order: a field's name, else its ID. A table's header is short and read on its own."""
    rows = spark.read.format("xml").option("rowTag", "TABLE").schema("FIELD array<struct<_name:string,_ID:string>>").load(path).select("FIELD").limit(1).collect()
    return [f["_name"] or f["_ID"] for f in (rows[0]["FIELD"] if rows and rows[0]["FIELD"] else [])]


def read_votable(spark: SparkSession, path: str) -> DataFrame:
    """A table's rows under its fields' names, cells as trimmed text, empty cells null."""
    names = field_names(spark, path)
    rows = spark.read.format("xml").option("rowTag", "TR").option("nullValue", "").schema("TD array<string>").load(path)
    cells = F.transform("TD", lambda c: F.nullif(F.trim(c), F.lit("")))
    return from_fields(rows.select(cells.alias("cells")), names)
