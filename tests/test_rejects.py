import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyloom.operators import rejects

HEADER = "Name,RA_deg,DEC_deg,cutout_size_arcsec"
NUMBER = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", re.ASCII)


def split(line):
    """Fields of a record read sign by sign; None where it breaks the quoting rules."""
    out, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            i, cell = i + 1, ""
            while True:
                if i >= len(line):
                    return None
                if line[i] == '"':
                    if line[i + 1 : i + 2] != '"':
                        break
                    i += 1
                cell, i = cell + line[i], i + 1
            i += 1
            if line[i : i + 1] not in ("", ","):
                return None
        else:
            j = line.find(",", i)
            cell, i = (line[i:], len(line)) if j < 0 else (line[i:j], j)
            if '"' in cell:
                return None
        out.append(cell)
        if i >= len(line):
            return out
        i += 1


def number(text):
    return float(text.strip()) if NUMBER.fullmatch(text.strip()) else None


def reason(header, line):
    cells, names = split(line or ""), split(header)
    if cells is None:
        return "quoting"
    if len(cells) != len(names):
        return "column_count"
    row = dict(zip(names, cells, strict=True))
    ra, dec, size = number(row["RA_deg"]), number(row["DEC_deg"]), row["cutout_size_arcsec"]
    if not row["Name"].strip():
        return "bad_name"
    if ra is None or not 0 <= ra < 360:
        return "bad_ra"
    if dec is None or not -90 <= dec <= 90:
        return "bad_dec"
    if size.strip() and (number(size) is None or not 6 <= number(size) <= 3600):
        return "bad_size"
    return None


CASES = [
    ("a,1,2,60", None), ("a,1,2,", None), ('"a, b",1,2,60', None), ('"a ""b""",+1.5e1,-.5,6', None), ('"a\nb",1,2,60', None), ("a\nb,1,2,60", None), (" a , 1 ,\t2 ,  ", None), ("a,1.,2,60\r", None),
    ("", "column_count"), (None, "column_count"), ("a,1,2", "column_count"), ("a,1,2,60,", "column_count"), ("a;1;2;60", "column_count"), ('"a,1,2,60', "quoting"), ('"a" b,1,2,60', "quoting"), ('a"b,1,2,60', "quoting"), ('a,"1"2,3,4', "quoting"),
    (",1,2,60", "bad_name"), ('"  ",x,2,60', "bad_name"), ("a,360,2,60", "bad_ra"), ("a,-1,2,60", "bad_ra"), ("a,NaN,2,60", "bad_ra"), ("a,1_0,2,60", "bad_ra"), ("a,1e999,2,60", "bad_ra"), ("a,.,2,60", "bad_ra"), ("a,,2,60", "bad_ra"), ("a,１,2,60", "bad_ra"),
    ("a,1,91,60", "bad_dec"), ("a,1,−2,60", "bad_dec"), ("a,1,2,5.9", "bad_size"), ("a,1,2,x", "bad_size"), ("a,1,-90,3600", None), ("a,0x1,2,60", "bad_ra"), ("a,1d2,2,60", "bad_ra"),
]


def test_reasons_of_plain_cases():
    got = rejects.parse_records(HEADER, [c for c, _ in CASES]).column("reason").to_pylist()
    assert got == [r for _, r in CASES]
    assert [reason(HEADER, c) for c, _ in CASES] == got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='ab ",\n\r019.e+-', max_size=14) | st.lists(st.sampled_from(["a", '"a"', '"a,b"', "1", " 2 ", "-3", '""', "", '"x""y"', "60", '"6\n0"', 'q"']), min_size=3, max_size=5).map(",".join), max_size=25))
def test_reasons_of_any_records(lines):
    assert rejects.parse_records(HEADER, lines).column("reason").to_pylist() == [reason(HEADER, x) for x in lines]


def test_typed_rows_and_headers_in_other_orders():
    t = rejects.parse_records('"RA_deg","DEC_deg","Name","cutout_size_arcsec",notes', ["1.5,-2,\"x\"\"y\",,n", "1,2,z,30,"]).to_pylist()
    assert (t[0]["name"], t[0]["ra_deg"], t[0]["dec_deg"], t[0]["cutout_size_arcsec"], t[0]["notes"]) == ('x"y', 1.5, -2.0, None, "n")
    assert t[1]["notes"] is None and t[1]["cutout_size_arcsec"] == 30.0
    assert rejects.parse_records(None, ["a,1,2,60", '"']).column("reason").to_pylist() == ["column_count", "quoting"]
    assert rejects.parse_records('"broken,x', ["a,1"]).column("reason").to_pylist() == ["column_count"]
    assert rejects.parse_records("Name,RA_deg", ["a,1"]).column("reason").to_pylist() == ["bad_dec"]
    assert rejects.parse_records(HEADER, []).num_rows == 0


def test_long_record():
    assert rejects.parse_records(HEADER, ['"' + "x" * 3_000_000 + '",1,2,60', "," * 100_000]).column("reason").to_pylist() == [None, "column_count"]


@pytest.mark.parametrize("how", [{}, {"broadcast_rows": 0, "rows_per_task": 2}, {"broadcast_rows": 1, "rows_per_task": 1000}])
def test_files_meet_their_headers(spark, how):
    rows = [(1, "f", 1, HEADER, "h"), (9, "f", 1, "other,header", "h"), (2, "f", 2, "a,1,2,60", "h"), (3, "f", 3, "a,1,2", "h"), (4, "g", 2, "a,1,2,60", "h"), (5, None, 2, "a,1,2,60", "h"), (6, "f", 2, "a,1,2,60", "h"), (7, "f", None, None, "h"), (8, "f", 5, HEADER, "h")]
    df = spark.createDataFrame(rows, "record_id bigint, file_id string, line_no int, raw_line string, header string")
    got = {r.record_id: r.reason for r in rejects.load_records(df, **how).collect()}
    assert got == {2: None, 3: "column_count", 4: "column_count", 5: "column_count", 6: None, 7: "column_count", 8: "bad_ra"}
    assert rejects.load_records(df.limit(0), **how).collect() == []
