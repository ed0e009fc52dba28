import pytest
from pyspark.sql import functions as F

from skyloom.operators import treeagg as t

SCHEMA = "k string, v int, at int, __tree_node string"


def frame(spark, rows, parts=7):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_counts_and_latest_of_a_crowded_key(spark):
    rows = [("hot", i, i % 50, "x") for i in range(3000)] + [(f"k{i % 40}", i, i, None) for i in range(400)] + [(None, 1, 1, None)] * 5 + [("null at", None, None, None)] * 2
    merges = {"n": t.rows(), "s": t.total(F.col("v")), "lo": t.smallest(F.col("v")), "hi": t.largest(F.col("v")), "held": t.count_of(F.col("v")), "last": t.latest([F.col("at")], {"v": F.col("v")})}
    got = {r.k: r for r in t.tree_aggregate(frame(spark, rows), ["k"], merges, fan_in=2, chunk_rows=100).collect()}
    assert len(got) == 43 and got["hot"].n == 3000 and got["hot"].s == sum(range(3000))
    assert (got["hot"].lo, got["hot"].hi) == (0, 2999)
    assert got["hot"]["last"].v == 2999  # ties go to the largest value
    assert got[None].n == 5
    assert got["null at"].n == 2 and got["null at"].held == 0 and got["null at"].s is None


def test_any_shape_of_tree_gives_the_same(spark):
    rows = [(f"k{i % 3}", i, i, None) for i in range(100)]
    merges = {"n": t.rows(), "s": t.total(F.col("v"))}
    results = [sorted(map(tuple, t.tree_aggregate(frame(spark, rows, p), ["k"], merges, fan_in=f, chunk_rows=v).collect())) for p, f, v in ((1, 2, 1000), (9, 2, 3), (20, 3, 1))]
    assert results[0] == results[1] == results[2]


def test_no_keys_and_empty(spark):
    empty = frame(spark, [])
    assert t.tree_aggregate(empty, ["k"], {"n": t.rows()}).collect() == []
    assert [r.n for r in t.tree_aggregate(frame(spark, [("a", 1, 1, None)] * 9), [], {"n": t.rows()}).collect()] == [9]
    assert t.heavy_keys(empty, "k", 0.04).collect() == []


def test_heavy_keys_leave_out_null_but_count_it(spark):
    rows = [("a", 1, 1, None)] * 5 + [("b", 1, 1, None)] * 4 + [(None, 1, 1, None)] * 91
    assert {(r.k, r.n_rows) for r in t.heavy_keys(frame(spark, rows), "k", 0.04).collect()} == {("a", 5)}


@pytest.mark.parametrize(("parts", "fan_in", "chunk_rows"), [(1, 4, 1000), (4, 4, 1000), (5, 4, 1000), (16, 4, 1000), (17, 4, 1000), (3, 2, 7), (9, 3, 5)])
def test_no_node_gets_more_states_of_a_key_than_the_fan_in(spark, parts, fan_in, chunk_rows):
    rounds, node = t.tree_rounds(frame(spark, [("hot", i, i, "x") for i in range(200)], parts), ["k"], {"n": t.rows()}, fan_in, chunk_rows)
    assert rounds[0].agg(F.max("n")).first()[0] <= chunk_rows
    for states in rounds[:-1]:
        assert states.groupBy("k", F.floor(F.col(node) / fan_in)).count().agg(F.max("count")).first()[0] <= fan_in
    assert [r.n for r in rounds[-1].collect()] == [200]
