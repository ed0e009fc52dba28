"""Identities against Python's own JSON."""

import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.functions import identity as i

TEXTS = ["a|b", "~", "a\"b\\c\n\t\x01/", "é👍\x7f", "", None, "plain", "x" * 70_000]
NUMBERS = [0.0, -0.0, 1.0, 12.5, 1e-5, -2.5e-7, 1e-10, 0.0001, 0.00012345, 359.9999999999, 123.4567890123, 1 / 3, -89.5, None, float("nan"), float("inf")]


def test_values_are_those_of_json(spark):
    df = spark.createDataFrame([(x,) for x in TEXTS], "x string")
    assert [r.j for r in df.select(i.json_text("x").alias("j")).collect()] == [None if x is None else json.dumps(x) for x in TEXTS]
    df = spark.createDataFrame([(x,) for x in NUMBERS], "x double")
    want = [None if x is None or x != x or abs(x) == float("inf") else json.dumps(round(x, 10)) for x in NUMBERS]
    assert [r.j for r in df.select(i.json_real("x", 10).alias("j")).collect()] == want


def test_identity_is_the_hash_of_canonical_json(spark):
    rows = [(a, b, n) for a in TEXTS for b in ("b|c", None) for n in (3, None)]
    df = spark.createDataFrame(rows, "b string, a string, n int")
    got = [r.h for r in df.select(i.stable_hash(i.texts("b", "a") | {"n": i.json_whole("n"), "ok": i.json_truth(F.lit(True))}).alias("h")).collect()]
    want = [hashlib.sha256(json.dumps({"a": b, "b": a, "n": n, "ok": True}, sort_keys=True, separators=(",", ":")).encode()).hexdigest() for a, b, n in rows]
    assert got == want and len(set(got)) == len(rows)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-400, 400).map(lambda x: round(x, 7)), min_size=1, max_size=40))
def test_any_number(spark, numbers):
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    assert [r.j for r in df.select(i.json_real("x", 10).alias("j")).collect()] == [json.dumps(round(x, 10)) for x in numbers]
