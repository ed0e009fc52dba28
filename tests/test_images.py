"""Images as arrays against their pixel rows and plain loops."""

import numpy as np
from pyspark.sql import functions as F

from skyloom.operators import background, images, pixels

SCHEMA = "image_id int, width int, value array<double>, variance array<double>, flag array<bigint>, template array<double>, clash string"


def made(rng, n, h, w, first=0):
    rows = []
    for k in range(n):
        v = rng.normal(0, 1, h * w) + 0.1 * np.arange(h * w)
        v[rng.integers(0, h * w, 4)] += 50
        yy, xx = np.indices((h, w))
        t = np.exp(-((xx - w / 2) ** 2 + (yy - h / 2) ** 2) / 3).ravel()
        rows.append((first + k, w, v.tolist(), rng.uniform(0.5, 2, h * w).tolist(), (rng.random(h * w) < 0.1).astype(int).tolist(), t.tolist(), "c"))
    return rows


def flat(df):
    p = df.select("image_id", "width", F.posexplode(F.arrays_zip("value", "variance", "flag", "template")).alias("i", "p")).select("image_id", F.floor(F.col("i") / F.col("width")).cast("int").alias("y"), (F.col("i") % F.col("width")).cast("int").alias("x"), "p.*")
    return pixels.with_masks(p, 4.0, 4.0)


def same(a, b, keys=("image_id",)):
    a, b = ({tuple(r[k] for k in keys): r for r in x.collect()} for x in (a, b))
    assert set(a) == set(b) and a
    for k, r in a.items():
        for c in r.asDict():
            assert r[c] == b[k][c] or abs(r[c] - b[k][c]) < 1e-9 * max(1, abs(r[c])), (k, c, r[c], b[k][c])


def test_arrays_and_pixel_rows_agree_for_images_of_several_shapes(spark):
    rng = np.random.default_rng(7)
    df = spark.createDataFrame(made(rng, 6, 8, 8) + made(rng, 5, 9, 11, 50), SCHEMA)
    m = flat(df)
    same(images.image_masks(df, 4.0, 4.0), pixels.mask_statistics(m))
    same(images.backgrounds(df, 4.0, 4.0, (4.0, 4.0), "plane"), background.clipped_plane(m, "background", 4.0, 4.0))
    same(images.backgrounds(df, 4.0, 4.0, (4.0, 4.0), "constant"), background.clipped_median(m, "fit"))
    sound = m.withColumn("sound", F.col("fit") & ~F.col("protected"))
    same(images.backgrounds(df, 4.0, 4.0, (4.0, 4.0), "calm"), background.clipped_plane(background.without_bright(sound, "sound", "calm"), "calm", 4.0, 4.0))


def test_nulls_empty_and_odd_arrays(spark):
    v = [1.0, None, float("nan"), float("inf")] * 4
    rows = [(1, 4, v, [1.0] * 16, [0] * 16, [1.0] * 16, ""), (2, 4, [], [], [], [], ""), (3, 4, [1.0] * 5, [1.0] * 5, [0] * 5, [1.0] * 5, ""), (4, 4, None, None, None, None, ""), (5, None, [1.0], [1.0], [0], [1.0], ""), (None, 4, v, [0.0] * 16, [None] * 16, [0.0] * 16, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.image_id: r for r in images.image_masks(df, 1.0, 1.0).collect()}
    assert set(got) == {1, None} and got[1].n_fit == 4 and got[None].n_fit == 0 and got[None].template_unmasked == 0.0
    assert {r.ok for r in images.backgrounds(df, 1.0, 1.0, (1.0, 1.0), "plane").collect()} == {False}
    assert images.image_masks(df.limit(0), 1.0, 1.0).collect() == []


def test_labels_against_a_plain_flood():
    rng = np.random.default_rng(2)
    for density in (0.2, 0.45, 0.7, 1.0):
        mask = rng.random((5, 12, 9)) < density
        got = images.label(mask.reshape(5, -1), 9).reshape(mask.shape)
        for k in range(5):
            want = np.full((12, 9), -1)
            for i in range(108):
                if mask[k].flat[i] and want.flat[i] < 0:
                    todo = [divmod(i, 9)]
                    while todo:
                        y, x = todo.pop()
                        if 0 <= y < 12 and 0 <= x < 9 and mask[k, y, x] and want[y, x] < 0:
                            want[y, x] = i
                            todo += [(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
            assert (got[k] == want).all()


def test_no_image_query_is_shuffled(spark):
    df = spark.createDataFrame(made(np.random.default_rng(1), 2, 8, 8), SCHEMA)
    for out in (images.image_masks(df, 4.0, 4.0), images.backgrounds(df, 4.0, 4.0, (4.0, 4.0), "plane"), images.bright_areas(df, 1.0)):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
