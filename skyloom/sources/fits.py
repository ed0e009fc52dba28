"""FITS files read in Spark tasks: header cards, image planes and binary tables, each file or its rows a row."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 2880
# Data types of images by BITPIX, and of table columns by their format letter.
IMAGE_TYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
COLUMN_TYPES = {"L": "S1", "B": ">u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8"}
HDUS = "path string, hdu int, name string, kind string, shape array<int>, cards map<string,string>, data array<double>"


def _cards(block: bytes) -> dict[str, str]:
    cards = {}
    for i in range(0, len(block), 80):
        card = block[i : i + 80].decode("ascii", "replace")
        if card[8:10] != "= ":
            continue
        text = card[10:].strip()
        m = re.match(r"'((?:[^']|'')*)'", text)
        cards.setdefault(card[:8].strip(), m.group(1).replace("''", "'").rstrip() if m else text.split("/", 1)[0].strip())
    return cards


def parse_hdus(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header cards and data of each unit of a file."""
    at = 0
    while at + BLOCK <= len(content):
        start = at
        while True:
            block = content[at : at + BLOCK]
            if len(block) < BLOCK:
                raise ValueError("the header has no end")
            at += BLOCK
            if any(block[i : i + 8] == b"END     " for i in range(0, BLOCK, 80)):
                break
        cards = _cards(content[start:at])
        axes = [int(cards[f"NAXIS{i}"]) for i in range(1, int(cards.get("NAXIS", 0)) + 1)]
        size = abs(int(cards.get("BITPIX", 8))) // 8 * (int(np.prod(axes)) if axes else 0) + int(cards.get("PCOUNT", 0))
        if at + size > len(content):
            raise ValueError("the data end too early")
        yield cards, content[at : at + size]
        at += -(-size // BLOCK) * BLOCK


def image_of(cards: dict[str, str], data: bytes) -> np.ndarray:
    """A plane or cube as doubles, scaled, blanks as NaN."""
    axes = [int(cards[f"NAXIS{i}"]) for i in range(int(cards["NAXIS"]), 0, -1)]
    raw = np.frombuffer(data, IMAGE_TYPES[int(cards["BITPIX"])], int(np.prod(axes))).reshape(axes)
    out = raw.astype(np.float64) * float(cards.get("BSCALE", 1)) + float(cards.get("BZERO", 0))
    if "BLANK" in cards and int(cards["BITPIX"]) > 0:
        out[raw == int(cards["BLANK"])] = np.nan
    return out


def table_of(cards: dict[str, str], data: bytes) -> pd.DataFrame:
    """A binary table's scalar columns; arrays become lists, text is trimmed."""
    width, rows = int(cards["NAXIS1"]), int(cards["NAXIS2"])
    fields, names = [], []
    for i in range(1, int(cards["TFIELDS"]) + 1):
        m = re.match(r"(\d*)([A-Z])", cards[f"TFORM{i}"])
        n, letter = int(m.group(1) or 1), m.group(2)
        names.append(cards.get(f"TTYPE{i}", f"col_{i}"))
        fields.append((f"c{i}", f"S{n}") if letter == "A" else (f"c{i}", COLUMN_TYPES[letter]) if n == 1 else (f"c{i}", COLUMN_TYPES[letter], (n,)))
    raw = np.frombuffer(data, np.dtype(fields), rows) if np.dtype(fields).itemsize == width else np.frombuffer(data, np.dtype({"names": [f[0] for f in fields], "formats": [f[1:] if len(f) > 2 else f[1] for f in fields], "itemsize": width}), rows)
    out = {}
    for name, f in zip(names, fields, strict=True):
        v = raw[f[0]]
        out[name] = [x.decode("ascii", "replace").strip() for x in v] if v.dtype.kind == "S" else list(v.astype(v.dtype.newbyteorder("="))) if v.ndim > 1 else v.astype(v.dtype.newbyteorder("="))
    return pd.DataFrame(out)


def read_hdus(spark: SparkSession, path: str, glob: str = "*.fits") -> DataFrame:
    """A row per unit of each file: HDUS, data flat in row-major order for images and null otherwise.

    A file that can't be read gives one row with a null hdu and the reason under the card ``ERROR``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                try:
                    for i, (cards, data) in enumerate(parse_hdus(bytes(content))):
                        kind = cards.get("XTENSION", "IMAGE")
                        plane = image_of(cards, data) if kind == "IMAGE" and int(cards.get("NAXIS", 0)) else None
                        rows.append((p, i, cards.get("EXTNAME", "PRIMARY" if not i else ""), kind, list(plane.shape) if plane is not None else [], cards, plane.ravel() if plane is not None else None))
                except (ValueError, KeyError) as e:
                    rows = [(p, None, None, None, [], {"ERROR": str(e)}, None)]
                yield pd.DataFrame(rows, columns=["path", "hdu", "name", "kind", "shape", "cards", "data"]).astype({"hdu": "Int32"})

    return files.mapInPandas(read, HDUS)


def check_hdus(hdus: DataFrame, needed: tuple[str, ...] = ("IMAGE", "VARIANCE", "FLAGS", "PSF")) -> DataFrame:
    """``path, status`` per file: the first rule that it breaks, of unreadable, repeated unit, missing unit, plane that is no image, planes of different shapes, PSF that is no image; else passed."""
    planes = [n for n in needed if n != "PSF"]
    per = hdus.groupBy("path").agg(
        F.max(F.element_at("cards", "ERROR")).alias("error"), F.count_if(F.col("name").isin(*needed)).alias("n_named"), F.count_distinct(F.when(F.col("name").isin(*needed), F.col("name"))).alias("n_distinct"),
        F.count_if(F.col("name").isin(*planes) & (F.size("shape") != 2)).alias("n_odd"), F.count_distinct(F.when(F.col("name").isin(*planes), F.col("shape"))).alias("n_shapes"), F.count_if((F.col("name") == "PSF") & ~F.size("shape").isin(2, 3)).alias("n_bad_psf"),
    )
    status = F.when(F.col("error").isNotNull(), "failed_invalid_file").when(F.col("n_named") > F.col("n_distinct"), "failed_repeated_unit").when(F.col("n_distinct") < len(needed), "failed_missing_unit")
    status = status.when((F.col("n_odd") > 0) | (F.col("n_shapes") > 1), "failed_planes").when(F.col("n_bad_psf") > 0, "failed_psf").otherwise("passed")
    return per.select("path", status.alias("status"))


def read_fits_table(spark: SparkSession, path: str, hdu: int = 1) -> DataFrame:
    """The rows of a binary table, columns as text (catalogue fields are cast later); the schema comes from the first file's header."""
    head = spark.read.format("binaryFile").load(path).select("content").limit(1).first()
    if head is None:
        raise ValueError(f"no file at {path}")
    cards = [c for c, _ in parse_hdus(bytes(head[0]))][hdu]
    names = [cards.get(f"TTYPE{i}", f"col_{i}") for i in range(1, int(cards["TFIELDS"]) + 1)]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                c, data = list(parse_hdus(bytes(content)))[hdu]
                yield table_of(c, data)[names].map(lambda v: None if v is None else str(v))

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, ", ".join(f"`{n}` string" for n in names))
