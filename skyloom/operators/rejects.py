"""Loading delimited records whose fields, order and number are given by their file's header; rows that fail come out with a reason.

Structure is read by the Arrow CSV reader with its invalid-row callback, all fields as strings; the strings are then
cast as whole vectors and failing cells are labelled. The reader is lenient about quotes (text after a closing quote
is appended, a quote inside an unquoted field is kept, and a quote never closed would swallow the following records),
so records that break the quoting rules are set aside before they reach it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import BROADCAST_ROWS, cut_lineage, maybe_broadcast

SCHEMA = "record_id bigint, file_id string, name string, ra_deg double, dec_deg double, cutout_size_arcsec double, notes string, reason string, line_no int"
FIELDS = ("Name", "RA_deg", "DEC_deg", "cutout_size_arcsec", "notes")
REASONS = ("quoting", "column_count", "bad_name", "bad_ra", "bad_dec", "bad_size")
QUOTED = r'"(?:[^"]|"")*"'
RECORD = rf'^(?:{QUOTED}|[^",]*)(?:,(?:{QUOTED}|[^",]*))*\z'  # of the Arrow engine
FIELD = re.compile(rf'({QUOTED}|[^",]*)(?:,|$)')
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
HEADER_BYTES = 16_000_000  # of all headers, that still are broadcast


def _quote_breaks(line: str) -> str:
    """Quote every unquoted field, so that a line break in one doesn't end the record."""
    out, at = [], 0
    while at <= len(line):
        m = FIELD.match(line, at)
        out.append(m.group(1) if m.group(1).startswith('"') else f'"{m.group(1)}"')
        if m.end() == len(line) and not m.group().endswith(","):
            break
        at = m.end()
    return ",".join(out)


def _whole_records(lines: pa.Array) -> pa.Array:
    """Records as the reader takes them; the few with line breaks get all fields quoted."""
    broken = pc.match_substring_regex(lines, r"[\r\n]")
    if not pc.any(broken).as_py():
        return lines
    at = np.flatnonzero(broken.to_numpy(zero_copy_only=False))
    return pc.replace_with_mask(lines, broken, pa.array([_quote_breaks(x) for x in lines.take(pa.array(at)).to_pylist()], lines.type))


def keeps_quoting(lines: pa.Array) -> np.ndarray:
    """Whether each record keeps the quoting rules, tested on whole vectors."""
    return pc.match_substring_regex(lines, RECORD).to_numpy(zero_copy_only=False)


def _read(lines: pa.Array, n_fields: int) -> tuple[pa.Table, list[int]]:
    """Records that keep the quoting rules, as string columns led by the record's place; the places of those with another number of fields."""
    wrong: list[int] = []

    def invalid(row: csv.InvalidRow) -> str:
        wrong.append(int(row.text.split(",", 1)[0]))
        return "skip"

    names = ["at", *(f"f{i}" for i in range(n_fields))]
    if not len(lines):
        return pa.table({n: pa.array([], pa.string()) for n in names}), wrong
    numbered = pc.binary_join_element_wise(pa.array(np.arange(len(lines))).cast(pa.large_string()), _whole_records(lines), pa.scalar(",", pa.large_string()))
    data = "\n".join(numbered.to_pylist()).encode() + b"\n"
    table = csv.read_csv(
        pa.BufferReader(data),
        read_options=csv.ReadOptions(column_names=names, use_threads=False, block_size=min(len(data) + 1, 2**31 - 1)),
        parse_options=csv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False, invalid_row_handler=invalid),
        convert_options=csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False),
    )
    return table, wrong


def header_fields(header: str | None) -> list[str] | None:
    """The field names of a header; None for no header or one that breaks the quoting rules."""
    line = pa.array([header or ""], pa.large_string())
    if header is None or not keeps_quoting(line)[0]:
        return None
    options = csv.ReadOptions(autogenerate_column_names=True)
    width = len(csv.read_csv(pa.BufferReader((_quote_breaks(header) + "\n").encode()), read_options=options, parse_options=csv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False)).column_names)
    table, _ = _read(line, width)
    return [str(table.column(i)[0]).strip() for i in range(1, table.num_columns)]


def _numbers(text: pa.Array) -> pa.Array:
    """Doubles, null where the text is no number."""
    t = pc.utf8_trim_whitespace(text)
    t = pc.replace_substring_regex(pc.if_else(pc.match_substring_regex(t, NUMBER), t, pa.scalar(None, pa.string())), r"^\+", "")
    try:
        return pc.cast(t, pa.float64())
    except pa.ArrowInvalid:  # an exponent beyond a double's
        return pa.array([None if x is None else float(x) for x in t.to_pylist()], pa.float64())


def _within(x: pa.Array, low: float, high: float, closed: bool) -> pa.Array:
    return pc.fill_null(pc.and_(pc.greater_equal(x, low), (pc.less_equal if closed else pc.less)(x, high)), False)


def parse_records(header: str | None, lines: list[str | None] | pa.Array) -> pa.Table:
    """One row per record in the given order: FIELDS typed, and the first reason that applies, null for a valid record.

    A null record is an empty one. Without a readable header no record has the right number of fields. A field that the
    header lacks is blank. Of two fields with one name the first counts.
    """
    texts = pa.array(lines, pa.large_string()).fill_null("") if isinstance(lines, list) else lines.cast(pa.large_string()).fill_null("")
    fields = header_fields(header)
    # codes of REASONS; -1 is a record that can be loaded
    good = keeps_quoting(texts)
    reason = np.where(good, REASONS.index("column_count"), REASONS.index("quoting"))
    well = np.flatnonzero(good)
    if fields is None:
        table = pa.table({"at": pa.array([], pa.string())})
        fields = []
    else:
        table, _ = _read(texts.take(pa.array(well)), len(fields))
    at = well[table.column("at").cast(pa.int64()).to_numpy()]
    empty = pa.array([""] * table.num_rows, pa.string())
    text = {k: table.column(f"f{fields.index(k)}").combine_chunks() if k in fields else empty for k in FIELDS}
    blank = {k: pc.equal(pc.utf8_trim_whitespace(v), "") for k, v in text.items()}
    ra, dec, size = (_numbers(text[k]) for k in ("RA_deg", "DEC_deg", "cutout_size_arcsec"))
    checks = {
        "bad_name": blank["Name"],
        "bad_ra": pc.invert(_within(ra, 0, 360, False)),
        "bad_dec": pc.invert(_within(dec, -90, 90, True)),
        "bad_size": pc.and_(pc.invert(blank["cutout_size_arcsec"]), pc.invert(_within(size, 6, 3600, True))),
    }
    label = np.full(table.num_rows, -1)
    for name, failed in reversed(list(checks.items())):
        label[(failed.combine_chunks() if isinstance(failed, pa.ChunkedArray) else failed).to_numpy(zero_copy_only=False)] = REASONS.index(name)
    reason[at] = label
    place = np.full(len(texts), -1)
    place[at] = np.arange(table.num_rows)
    take = pa.array(np.where(place < 0, 0, place), mask=place < 0)
    loaded = pa.array(reason < 0)
    names = pa.DictionaryArray.from_arrays(pa.array(np.maximum(reason, 0), pa.int32(), mask=reason < 0), pa.array(REASONS)).cast(pa.string())
    typed = {"name": pc.utf8_trim_whitespace(text["Name"]), "ra_deg": ra, "dec_deg": dec, "cutout_size_arcsec": size, "notes": pc.if_else(blank["notes"], pa.scalar(None, pa.string()), text["notes"])}
    return pa.table({k: pc.if_else(loaded, pc.take(v, take), pa.scalar(None, v.type)) for k, v in typed.items()} | {"reason": names})


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        headers = batch.column("header").dictionary_encode()
        for k in pc.unique(headers.indices).to_pylist() if batch.num_rows else []:
            mine = batch.filter(pc.is_null(headers.indices) if k is None else pc.fill_null(pc.equal(headers.indices, k), False))
            table = parse_records(None if k is None else headers.dictionary[k].as_py(), mine.column("raw_line"))
            out = pa.table({"record_id": mine.column("record_id"), "file_id": mine.column("file_id"), **{n: table.column(n) for n in table.column_names}, "line_no": mine.column("line_no")})
            yield from out.combine_chunks().to_batches()


def load_records(records: DataFrame, rows_per_task: int = 200_000, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every record but the headers as a row of SCHEMA: typed fields, or nulls and the ``reason`` it cannot be loaded.

    ``records`` has ``record_id, file_id, line_no, raw_line``; other columns are ignored. Line 1 of a file is its
    header (of several the one with the lowest record_id). Repeated records each give a row; a null file_id is a file of
    its own; null record_ids are kept. An empty table gives an empty result. Headers are broadcast when there are few and
    they are short; else records meet them in a join on file and part, with a part for every ``rows_per_task`` records
    of a file, so that a file with most of the records is spread.
    """
    rows = records.select("record_id", F.coalesce("file_id", F.lit("")).alias("file"), "file_id", "line_no", "raw_line")
    first = F.min(F.when(F.col("line_no") == 1, F.struct(F.col("record_id").isNull().alias("last"), "record_id", "raw_line")))
    files = cut_lineage(rows.groupBy("file").agg(first["raw_line"].alias("header"), F.ceil(F.count(F.lit(1)) / rows_per_task).alias("parts")))
    body = rows.filter("line_no is null or line_no != 1")
    size = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("header")), F.lit(0)).alias("bytes")).first()
    if size.n <= broadcast_rows and size.bytes <= HEADER_BYTES:
        joined = body.join(F.broadcast(files), "file", "left")
    else:
        large = maybe_broadcast(files.filter("parts > 1").select("file", F.col("parts").alias("of")), broadcast_rows)
        body = body.join(large, "file", "left").withColumn("part", F.pmod(F.xxhash64("record_id", "line_no", "raw_line"), F.coalesce("of", F.lit(1))))
        joined = body.join(files.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))), ["file", "part"], "left")
    return joined.select("record_id", "file_id", "raw_line", "header", F.col("line_no").cast("int").alias("line_no")).mapInArrow(_parse_batches, SCHEMA)
