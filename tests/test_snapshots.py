import itertools
import random

from pyspark.sql import functions as F

from skyloom.operators.snapshots import change_events, validity_intervals

SCHEMA = "k string, snap int, h string, v string, seen int, rid int, key string, ord int"


def events(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows], SCHEMA)
    i = validity_intervals(df, F.col("k"), "snap", {"h": F.col("h"), "v": F.col("v")}, [F.col("seen"), F.col("rid")])
    return {tuple(r) for r in change_events(i).collect()}


def brute(rows):
    numbers = sorted({r[1] for r in rows if r[1] is not None})
    state = {}
    for k, s, h, v, seen, rid in rows:
        if k is not None and s is not None:
            rank = (seen is not None, seen or 0, rid)
            if (k, s) not in state or rank > state[k, s][0]:
                state[k, s] = (rank, (h, v))
    out = set()
    for a, b in itertools.pairwise(numbers):
        for k in {k for k, _ in state}:
            x, y = state.get((k, a)), state.get((k, b))
            if x and not y:
                out.add((b, k, "removed"))
            elif y and not x:
                out.add((b, k, "added"))
            elif x and y and x[1] != y[1]:
                out.add((b, k, "changed"))
    return out


def test_random_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abcdefgh"), rng.choice([1, 2, 3, 5, 8]), rng.choice(["x", "y", None]), rng.choice(["1", None]), rng.choice([1, 2, None]), i) for i in range(150)]
    assert events(spark, rows) == brute(rows)


def test_gap_return_null_key_repeats(spark):
    rows = [("a", 1, "x", None, 1, 1), ("a", 3, "x", None, 1, 2), ("a", 3, "x", None, 1, 2), ("b", 2, "x", None, 1, 3), (None, 2, "x", None, 1, 4), ("c", None, "x", None, 1, 5)]
    assert events(spark, rows) == {(2, "a", "removed"), (3, "a", "added"), (2, "b", "added"), (3, "b", "removed")}


def test_only_last_seen_changes_nothing_and_empty(spark):
    assert events(spark, [("a", 1, "x", "1", 1, 1), ("a", 2, "x", "1", 9, 2)]) == set()
    assert events(spark, []) == set()
    assert events(spark, [("a", 4, "x", "1", 1, 1)]) == set()
