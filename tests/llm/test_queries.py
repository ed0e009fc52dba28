"""The registered text queries against their SQL and what must hold of them, on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skyloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, small, name):
    c = duckdb.connect()
    for f in os.listdir(small):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{small}/{f}')")
    cursor = c.execute(entry.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    df = entry.queries()[name](spark, small)
    assert sorted(df.columns) == sorted(names)
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == Counter(cursor.fetchall())


def test_containers_of_the_corpus(spark, small):
    out = entry.queries()["p8_containers"](spark, small)
    fill = out.groupBy("container_id").agg(F.sum("n_tokens").alias("n"), F.count("doc_id").alias("k")).collect()
    total = sum(r.n for r in fill)
    assert max(r.n for r in fill) <= queries.CAPACITY and len(fill) <= -(-total // queries.CAPACITY) + 1
    assert out.select("doc_id").distinct().count() == spark.read.parquet(f"{small}/documents.parquet").count()
    counts = queries.tokens.token_counts(spark.read.parquet(f"{small}/documents.parquet"))
    assert total == counts.agg(F.sum("n_tokens")).first()[0]
