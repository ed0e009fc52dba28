"""Every registered query with SQL is compared with it on the smallest tables, whole results as multisets."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

# the queries of an optional subpackage are tested beside it
CORE = {n for n, f in entry.queries().items() if ".plans." in f.__module__}
NAMES = sorted(set(entry.oracle_sql()) & CORE)


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for f in os.listdir(small):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{small}/{f}')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return "null" if v is None else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, small, duck, name):
    df = entry.queries()[name](spark, small)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = Counter(tuple(map(plain, r)) for r in cursor.fetchall())
    got = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    assert got == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_names_without_sql_are_registered_for_a_reason():
    assert CORE - set(entry.oracle_sql()) <= {"p2_found", "p2_scores", "image_merged_neighbours", "image_measurements"}
