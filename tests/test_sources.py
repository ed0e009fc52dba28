import json

import numpy as np
import pytest

from skyloom.sources import fits, tables, votable


def card(key, value):
    text = f"'{value}'" if isinstance(value, str) else "T" if value is True else str(value)
    return f"{key:<8}= {text:>20}".ljust(80).encode()


def unit(cards, data=b""):
    head = b"".join(card(k, v) for k, v in cards) + b"END".ljust(80)
    return head.ljust(-(-len(head) // 2880) * 2880) + data.ljust(-(-len(data) // 2880) * 2880, b"\0")


def image(name, plane, kind=">f4", bitpix=-32, extra=()):
    axes = [(f"NAXIS{i + 1}", n) for i, n in enumerate(reversed(plane.shape))]
    return unit([("XTENSION", "IMAGE"), ("BITPIX", bitpix), ("NAXIS", plane.ndim), *axes, ("EXTNAME", name), *extra], plane.astype(kind).tobytes())


PRIMARY = unit([("SIMPLE", True), ("BITPIX", 8), ("NAXIS", 0)])


def cutout(drop=(), shape=(4, 5)):
    plane = np.arange(20, dtype=float).reshape(4, 5)
    parts = {"IMAGE": image("IMAGE", plane), "VARIANCE": image("VARIANCE", np.ones(shape)), "FLAGS": image("FLAGS", np.full((4, 5), 3), ">i2", 16), "PSF": image("PSF", np.ones((2, 3, 3)))}
    return PRIMARY + b"".join(v for k, v in parts.items() if k not in drop)


def test_image_units_and_rules(spark, tmp_path):
    for name, content in {"a": cutout(), "b": cutout(drop=("PSF",)), "c": cutout(shape=(4, 4)), "d": b"no fits" * 1000, "e": cutout() + image("PSF", np.ones((2, 3, 3))), "f": b""}.items():
        (tmp_path / f"{name}.fits").write_bytes(content)
    hdus = fits.read_hdus(spark, str(tmp_path))
    row = hdus.filter("path like '%/a.fits' and name = 'IMAGE'").first()
    assert row.shape == [4, 5] and row.data == [float(i) for i in range(20)] and row.cards["BITPIX"] == "-32"
    status = {r.path[-6]: r.status for r in fits.check_hdus(hdus).collect()}
    assert status == {"a": "passed", "b": "failed_missing_unit", "c": "failed_planes", "d": "failed_invalid_file", "e": "failed_repeated_unit"}


def test_scaled_blank_and_cube():
    raw = np.array([[1, 2], [-9, 4]])
    (_, _), (cards, data) = fits.parse_hdus(PRIMARY + image("X", raw, ">i2", 16, [("BSCALE", 2), ("BZERO", 10), ("BLANK", -9)]))
    got = fits.image_of(cards, data)
    assert got[0].tolist() == [12, 14] and np.isnan(got[1, 0]) and got[1, 1] == 18


def test_binary_table_as_catalogue(spark, tmp_path):
    dtype = np.dtype([("n", "S6"), ("r", ">f8"), ("k", ">i4")])
    rows = np.array([(b"alpha", 1.5, 7), (b"b c", -2.25, 8)], dtype)
    table = unit([("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", dtype.itemsize), ("NAXIS2", 2), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", 3), ("TTYPE1", "Name"), ("TFORM1", "6A"), ("TTYPE2", "RA_deg"), ("TFORM2", "D"), ("TTYPE3", "k"), ("TFORM3", "J")], rows.tobytes())
    path = tmp_path / "cat.fits"
    path.write_bytes(PRIMARY + table)
    assert [tuple(r) for r in tables.read_catalog(spark, str(path)).collect()] == [("alpha", "1.5", "7"), ("b c", "-2.25", "8")]
    assert tables.catalog_columns(spark, str(path)) == ["Name", "RA_deg", "k"]


def test_votable_names_and_cells(spark, tmp_path):
    xml = """<VOTABLE><RESOURCE type="results"><TABLE><FIELD name="s_ra" ID="col_0" datatype="double"/><FIELD ID="col_1" datatype="char"/><DATA><TABLEDATA>
    <TR><TD>1.5</TD><TD> u </TD></TR><TR><TD>2.5</TD><TD></TD></TR></TABLEDATA></DATA></TABLE></RESOURCE></VOTABLE>"""
    path = tmp_path / "r.xml"
    path.write_text(xml)
    df = votable.read_votable(spark, str(path))
    assert df.columns == ["s_ra", "col_1"]
    assert {tuple(r) for r in df.collect()} == {("1.5", "u"), ("2.5", None)}


@pytest.mark.parametrize("kind", ["csv", "parquet", "json", "ecsv"])
def test_manifests_come_back(spark, tmp_path, kind):
    rows = [(1, 'a "b", c', 1.5), (2, "plain", 2.0), (3, "x y", -1.0)]
    df = spark.createDataFrame(rows, "k bigint, t string, v double").coalesce(1)
    path = str(tmp_path / f"m.{kind}")
    tables.export(df, path, kind)
    back = spark.read.json(path).select("k", "t", "v") if kind == "json" else tables.read_catalog(spark, path)
    assert sorted((int(r.k), r.t, float(r.v)) for r in back.collect()) == rows


def test_unknown_kinds_and_isolated_failures(spark, tmp_path):
    df = spark.range(3)
    with pytest.raises(ValueError):
        tables.export(df, str(tmp_path / "x"), "xlsx")
    with pytest.raises(ValueError):
        tables.read_catalog(spark, str(tmp_path / "x.txt"))
    audit = tables.export_all({"t": df}, str(tmp_path), ["csv", "xlsx"], "run1")
    assert [(a["kind"], a["n_rows"], a["error"] is None) for a in audit] == [("csv", 3, True)] * 2 + [("xlsx", None, False)] * 2


def test_listing_skips_broken_lines(spark, tmp_path):
    path = tmp_path / "l.json"
    path.write_text("\n".join([json.dumps({"name": "a", "size": "12"}), "{broken", json.dumps({"name": "b", "size": "x"}), json.dumps({"name": "c", "size": "-1"}), json.dumps({"size": "3"})]))
    assert {tuple(r) for r in tables.read_listing(spark, str(path)).collect()} == {("a", 12), ("b", None), ("c", None)}


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    from skyloom.streaming import events

    schema = "k string, at int, v string, ts timestamp"
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    rows = lambda *r: spark.createDataFrame([(*x, None) for x in r], schema).coalesce(1).write.mode("append").parquet(source)

    def run(merge_every):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        return {tuple(r)[:3] for r in events.upsert_stream(stream, ["k"], ["at"], folder, merge_every).collect()}

    rows(("a", 1, "x"), ("b", 1, "y"))
    assert run(2) == {("a", 1, "x"), ("b", 1, "y")}
    for i in range(2, 6):
        rows(("a", i, f"x{i}"))
    assert run(2) == {("a", 5, "x5"), ("b", 1, "y")}  # a second start keeps the table and merges it on the way
    assert events._batches(spark, f"{folder}/merged") == [1, 3] and events._batches(spark, f"{folder}/rows") == [0, 1, 2, 3, 4]
    rows(("b", 0, "late"))
    assert run(2) == {("a", 5, "x5"), ("b", 1, "y")}


def test_a_batch_tried_again_is_written_once(spark, tmp_path):
    from skyloom.streaming import events

    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1,), (2,)], "k int").write.parquet(source)
    read = lambda: spark.readStream.schema("k int").parquet(source)
    assert events.run_to_table(read(), "append", folder).count() == 2
    assert events.run_to_table(read(), "append", folder).count() == 2
    done = events.completed(spark.readStream.schema("k int").parquet(source), "k", 1)
    assert {r.k for r in events.run_to_table(done, "complete").collect()} == {1, 2}


def test_outputs(spark, tmp_path):
    m = spark.createDataFrame([("s", "m2", 2.0, "f"), ("s", "m1", 1.0, "f"), ("s", "m3", None, "f"), ("t", "m4", 3.0, "g")], "source_id string, measurement_id string, wavelength_um double, note string")
    manifest = {r.source_id: (r.n_rows, r.from_um, r.to_um) for r in tables.write_spectra(m, str(tmp_path / "o")).collect()}
    assert manifest == {"s": (3, 1.0, 2.0), "t": (1, 3.0, 3.0)}
    part = sorted((tmp_path / "o" / "spectra" / "source_id=s").glob("part-*"))
    assert len(part) == 1 and [x.split(",")[0] for x in part[0].read_text().splitlines()] == ["measurement_id", "m1", "m2", "m3"]
    snap = spark.createDataFrame([("a", "v1")], "source_id string, catalog_version_id string")
    tables.write_snapshot(snap, str(tmp_path / "s"))
    tables.write_snapshot(snap.selectExpr("'b' as source_id", "'v2' as catalog_version_id"), str(tmp_path / "s"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "s" / "versions")).collect()} == {("a", "v1"), ("b", "v2")} and spark.read.parquet(str(tmp_path / "s" / "latest")).count() == 1
    failures = spark.createDataFrame([(f"2025-01-{i:02d}", f"f{i}") for i in range(1, 20)], "created_at string, reason string")
    import json

    got = json.loads(tables.summary(manifest_frame(spark), failures, spark.createDataFrame([(5,)], "n int"), 3).first()[0])
    assert got["counts"] == {"n": 5} and [c["source_id"] for c in got["coverage"]] == ["a", "b", "c"] and [f["reason"] for f in got["failures"]] == ["f19", "f18", "f17"]
    files = spark.createDataFrame([("p", 5)], "path string, length bigint")
    held = {r.local_path: (r.file_exists, r.file_size) for r in tables.refreshed(spark.createDataFrame([("p",), ("q",)], "local_path string"), files).collect()}
    assert held == {"p": (True, 5), "q": (False, None)} and tuple(tables.storage(files).first()) == (1, 5)
    assert {tuple(r) for r in tables.status_counts(spark.createDataFrame([("x", "passed"), ("y", "passed")], "path string, status string")).collect()} == {("passed", 2)}


def manifest_frame(spark):
    return spark.createDataFrame([(x,) for x in "dacb"], "source_id string")
