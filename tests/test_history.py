import random

from skyloom.operators import history as h
from skyloom.operators.history import entity_history

SCHEMA = "key string, t bigint, tie bigint, value string, closed_at bigint, cut string, run int"


def history(spark, rows, **k):
    return {tuple(r) for r in entity_history(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA), **k).collect()}


def brute(rows):
    per = {}
    for key, t, tie, value, closed in rows:
        if key is not None and t is not None and ((key, t) not in per or (tie, value or "", closed or 0) > per[key, t][:1] + (per[key, t][1] or "", per[key, t][2] or 0)):
            per[key, t] = (tie, value, closed)
    out, open_ = set(), {}
    for (key, t), (_, value, closed) in sorted(per.items(), key=lambda x: (x[0][0], x[0][1])):
        now = open_.get(key)
        if closed is not None:
            if now:
                out.add((key, now[0], now[1], closed))
                del open_[key]
        elif now is None or now[0] != value:
            if now:
                out.add((key, now[0], now[1], t))
            open_[key] = (value, t)
    return out | {(k, v, t, None) for k, (v, t) in open_.items()}


def test_random_against_brute_force(spark):
    rng = random.Random(11)
    for period in (5, 40, 10_000):
        rows = [(rng.choice("abcdefghij"), rng.randrange(-50, 200), i, rng.choice(["x", "y", "z", None]), rng.choice([None] * 6 + [rng.randrange(0, 250)])) for i in range(400)]
        assert history(spark, rows + rows[:30], period_us=period, fanout=3) == brute(rows)


def test_returning_value_retirement_and_repeats(spark):
    rows = [("a", 1, 1, "x", None), ("a", 2, 2, "x", None), ("a", 3, 3, "y", None), ("a", 3, 4, "x", None), ("a", 9, 5, "x", 7), ("a", 10, 6, "x", 8), ("a", 20, 7, "x", None), ("b", 5, 8, None, None), ("b", 6, 9, None, 6)]
    assert history(spark, rows, period_us=4) == {("a", "x", 1, 7), ("a", "x", 20, None), ("b", None, 5, 6)}


def test_empty_and_null_keys(spark):
    assert history(spark, []) == set()
    assert history(spark, [(None, 1, 1, "x", None), ("a", None, 1, "x", None)]) == set()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "", 1) for r in rows], SCHEMA).drop("cut", "run")


def test_only_differing_leaves_are_read(spark):
    rows = [(f"k{i}", t, t, "same", None) for i in range(400) for t in (0, 10, 20)] + [("k7", 21, 99, "new", None), ("k8", 25, 100, "x", None), ("k8", 26, 101, "same", None)]
    read = h.changed_rows(frame(spark, rows), 10, fanout=3).collect()
    assert sum(r.cut == 0 for r in read) == 400  # all is new in the first delivery
    assert not [r for r in read if r.cut == 1]  # the second repeats the first: no entity row is read
    later = {r.key for r in read if r.cut == 2}
    assert {"k7", "k8"} <= later and len(later) < 40  # of the third only the leaves of the changed ones


def test_without_the_descent_nothing_is_found(spark, monkeypatch):
    rows = [("a", 1, 1, "x", None), ("a", 30, 2, "y", None)]
    monkeypatch.setattr(h, "differing_leaves", lambda leaves, *_: leaves.filter("false").select("cut", "node"))
    assert history(spark, rows, period_us=10) == set()


def test_unchanged_deliveries_change_no_root(spark):
    rows = [(f"k{i}", t, t, "v", None) for i in range(50) for t in (0, 10)]
    leaves = h.merkle_leaves(h.entity_digests(h.delivered_rows(frame(spark, rows), 10)), 9)
    roots = h.merkle_parents(h.merkle_parents(leaves, 3), 3).collect()
    assert {(r.cut, r.was == r.became) for r in roots} == {(0, False), (1, True)}


def test_a_state_that_comes_and_goes_within_a_period_is_found(spark):
    rows = [("a", t, t, "x", None) for t in (0, 10, 20)] + [("a", 12, 50, "y", None), ("a", 13, 51, "x", None)]
    assert history(spark, rows, period_us=10) == {("a", "x", 0, 12), ("a", "y", 12, 13), ("a", "x", 13, None)}
