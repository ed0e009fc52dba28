import math
import random

import numpy as np
import pyarrow as pa
import pytest

from skyloom.functions.forest import average_path, forest_scores
from skyloom.operators import spikes

SCHEMA = "measurement_id string, source_id string, photometry_run_id string, created_us bigint, wavelength_um double, point_flux_uJy double, chi2_reduced double, block string, seed int"


def readings(rng, source, n, level, scatter, runs=3):
    out = []
    for i in range(n):
        w = rng.uniform(0.75, 5.0)
        out.append([f"{source}-{i}", source, f"{source}r{i * runs // n}", i, w, level * (w / 2) ** -0.3 + rng.gauss(0, scatter), 1 + rng.gauss(0, 0.1), "b", 1])
    return out


def found(spark, rows, **k):
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
    return {(r.measurement_id, r.field_name): r.reason for r in spikes.score_readings(df, flagged_only=True, **k).collect()}


def planted(rng):
    """Sources of very different levels with readings that jump, freeze or cannot be."""
    rows, cases = [], {}
    for name, n, level, scatter in (("big", 400, 5000.0, 40.0), ("mid", 90, 50.0, 3.0), ("faint", 40, 0.5, 2.0), ("small", 19, 10.0, 0.1)):
        mine = readings(rng, name, n, level, scatter)
        for k, i in enumerate(rng.sample(range(n), 6)):
            field, j = (("point_flux_uJy", 5), ("chi2_reduced", 6))[k % 2]
            mine[i][j] += rng.choice([-1, 1]) * (30 * scatter if j == 5 else 8)
            if j == 6 and mine[i][6] < 0:
                cases[mine[i][0], field] = "limit"
            elif n >= 20:
                cases[mine[i][0], field] = "outlier"
        rows += mine
    rows[3][4], rows[8][5], rows[9][6] = 5.2, float("inf"), float("nan")
    cases |= {(rows[3][0], "wavelength_um"): "limit", (rows[8][0], "point_flux_uJy"): "limit", (rows[9][0], "chi2_reduced"): "limit"}
    cases.pop((rows[3][0], "point_flux_uJy"), None)  # flux isn't judged where the wavelength is wrong
    rows[12][4], rows[12][5] = None, 1e9
    cases.pop((rows[12][0], "point_flux_uJy"), None)
    for i in range(20, 26):
        rows[i][6] = 1.2345678 + i * 1e-9
        cases[rows[i][0], "chi2_reduced"] = "frozen"
    rows[23][6] = None  # a null doesn't end the five
    cases.pop((rows[23][0], "chi2_reduced"))
    for i in range(30, 34):
        rows[i][6] = 1.1  # four in a row are no case
        cases.pop((rows[i][0], "chi2_reduced"), None)
    return rows, cases


def test_planted_cases_come_out(spark):
    rows, cases = planted(random.Random(4))
    assert found(spark, rows + rows[:25]) == cases


def test_large_sources_in_blocks_give_the_same(spark):
    rng = random.Random(9)
    rows, _ = planted(rng)
    more = readings(rng, "huge", 3000, 800.0, 10.0, runs=60)
    for i in range(0, 3000, 100):
        more[i][5] += 500
    one = found(spark, rows + more)
    assert found(spark, rows + more, block_rows=250) == one
    assert sum(k[0].startswith("huge") for k in one) == 30


def test_long_runs_in_slices_give_the_same(spark):
    """One source with one run of most readings, frozen stretches across the ends of slices, nulls among them, repeats and ties in time."""
    rng = random.Random(21)
    rows, _ = planted(rng)
    more = readings(rng, "long", 900, 800.0, 10.0, runs=1)
    for i in range(0, 900, 60):
        more[i][5] += 500
    for start in range(30, 880, 47):
        for i in range(start, start + 5):
            more[i][6] = 1.3 + start * 1e-4
        more[start + 2][6] = None if start % 2 else more[start + 2][6]
    for i in range(400, 440):
        more[i][4] = 2.5
    for r in more[100:110]:
        r[3] = more[100][3]
    more[300][3] = more[301][3] = None
    null_run = [[*r[:2], None, *r[3:]] for r in readings(rng, "norun", 300, 5.0, 0.1)]
    everything = rows + more + null_run + more[50:80]
    one = found(spark, everything)
    assert sum(v == "frozen" for v in one.values()) > 60
    by_rule = lambda d: {k: v for k, v in d.items() if v != "outlier"}
    for run_rows in (13, 64):
        assert by_rule(found(spark, everything, block_rows=10, run_rows=run_rows)) == by_rule(one)
    assert found(spark, everything, block_rows=250, run_rows=250) == one


def test_empty_null_source_and_constant_source(spark):
    assert found(spark, []) == {}
    rows = [[f"n{i}", None, None, None, 9.0 if i == 1 else 2.0, 1e9, -1.0 if i == 2 else 1.0, "", 1] for i in range(30)]
    assert found(spark, rows) == {("n1", "wavelength_um"): "limit", ("n2", "chi2_reduced"): "limit"}


def test_every_reading_has_a_score(spark):
    rows, _ = planted(random.Random(4))
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
    got = spikes.score_readings(df).collect()
    assert len(got) == 3 * len(rows) - sum(v is None for r in rows for v in r[4:7])
    assert all(0 < r.score < 1 for r in got)
    out = [r.score for r in got if r.reason == "outlier"]
    rest = [r.score for r in got if r.reason is None]
    assert np.mean(out) > np.mean(rest) + 0.1


@pytest.mark.parametrize("score", [0.1, 0.9])
def test_without_the_forest_outliers_are_lost(spark, monkeypatch, score):
    """The same readings with one score for all: none are set aside, or none are ordinary."""
    rows, cases = planted(random.Random(4))
    table = pa.table({**{k: [r[i] for r in rows] for i, k in enumerate(["measurement_id", "source_id", "photometry_run_id", "created_us", "wavelength_um", "point_flux_uJy", "chi2_reduced"])}, "block": [0] * len(rows), "seed": [1] * len(rows)})
    c = spikes.Chunk(table.sort_by([(k, "ascending") for k in ("source_id", "photometry_run_id", "created_us")]))

    def outliers():
        parts = pa.Table.from_batches(spikes._judge(c, True)).to_pylist()
        sums = [p for p in parts if p["sums"]]
        coef, scatter = spikes.solve(np.array([p["n"] for p in sums]), np.array([p["sums"] for p in sums]), np.array([p["field_name"] == "point_flux_uJy" for p in sums]))
        fits = {(p["source_id"], p["field_name"]): (c, s) for p, c, s in zip(sums, coef, scatter, strict=True)}
        out = set()
        for p in parts:
            if p["reason"] == "candidate":
                (c0, s0), x = fits[p["source_id"], p["field_name"]], spikes._place(p["wavelength"]) if p["field_name"] == "point_flux_uJy" else 0.0
                if abs(p["value"] - np.polyval(c0[::-1], x)) > 10 * s0:
                    out.add((p["measurement_id"], p["field_name"]))
        return out

    want = {k for k, reason in cases.items() if reason == "outlier"}
    assert want <= outliers()
    monkeypatch.setattr(spikes, "_field_scores", lambda c, f, usable: np.where(c.null[f], np.nan, score))
    assert not want <= outliers()


def test_candidates_hold_every_reading_beyond_ten_scatters(spark):
    """Recall of the forest's candidates, by the distance of every reading from the curve of its source."""
    rng = random.Random(12)
    rows = [r for k in range(12) for r in readings(rng, f"s{k}", rng.randrange(20, 300), 10.0 ** rng.randrange(-1, 5), 10.0 ** rng.randrange(-2, 2))]
    for r in rng.sample(rows, 60):
        r[rng.choice([5, 6])] += rng.choice([-1, 1]) * 10 ** rng.uniform(2.5, 6)
    got = spikes.score_readings(spark.createDataFrame([tuple(r) for r in rows], SCHEMA)).filter("scatters > 10 and reason is null").collect()
    assert got == []


def test_sums_of_blocks_are_the_fit_of_the_whole():
    rng = np.random.default_rng(3)
    w, y = rng.uniform(-1, 1, 500), rng.normal(5, 2, 500)
    powers = lambda w, y: np.concatenate([np.vander(w, spikes.POWERS, increasing=True).sum(0), (np.vander(w, spikes.TERMS, increasing=True) * y[:, None]).sum(0), [(y * y).sum()]])
    whole = spikes.solve(np.array([500]), powers(w, y)[None], np.array([True]))
    parts = spikes.solve(np.array([500]), sum(powers(w[a : a + 60], y[a : a + 60]) for a in range(0, 500, 60))[None], np.array([True]))
    rest = y - np.polyval(np.polyfit(w, y, 4), w)
    assert np.allclose(whole[0], parts[0]) and np.allclose(whole[1], parts[1]) and np.isclose(whole[1][0], np.sqrt(rest @ rest / 495))


def test_six_digits_and_run_lengths():
    v = np.array([1.0, 1.0000001, 1.00001, 0.0, -0.0, 123456.4, 123456.0, 9.9999996, 10.0])
    m, e = spikes.six_digits(v)
    same = lambda i, j: m[i] == m[j] and e[i] == e[j]
    assert same(0, 1) and not same(1, 2) and same(3, 4) and same(5, 6) and same(7, 8)
    assert spikes.run_lengths(np.array([1, 1, np.nan, 1, 2, 2]), np.array([0, 0, 0, 0, 0, 1])).tolist() == [3, 3, 0, 3, 1, 1]


def test_forest_isolates_what_lies_apart():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    x[17], x[400] = 9, -9
    s = forest_scores(x, np.array([0, 300]), np.array([1, 2], np.uint64))
    assert {int(np.argmax(s[:300])), 300 + int(np.argmax(s[300:]))} == {17, 400}
    assert math.isclose(average_path(np.array([2]))[0], 1) and average_path(np.array([1]))[0] == 0
