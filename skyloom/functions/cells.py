"""Cells of the sphere along a Z-order curve on six cube faces, as Column expressions.

A unit vector lies on the face of its largest component. On a face its place is given by two angles, each within
45 degrees of the face's middle, and each angle is cut into ``2 ** level`` equal steps. A cell's code is the face
followed by the interleaved bits of its two steps. Points have codes of the finest level, FINEST; a coarser cell is a
range of those, and cells that follow each other on the curve join to one range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# face: (axis of the face, its sign, the two axes across it)
FACES = ((0, 1, 1, 2), (0, -1, 1, 2), (1, 1, 0, 2), (1, -1, 0, 2), (2, 1, 0, 1), (2, -1, 0, 1))
QUARTER = math.pi / 4
FINEST = 24


def unit_vector(ra_deg: Column, dec_deg: Column) -> tuple[Column, Column, Column]:
    ra, dec = F.radians(ra_deg), F.radians(dec_deg)
    return F.cos(dec) * F.cos(ra), F.cos(dec) * F.sin(ra), F.sin(dec)


def level_for(radius_deg: float) -> int:
    """The finest level whose cells are wider than any disc of the radius, so that a disc meets at most 2 x 2 cells of a face."""
    widest = 2 * math.degrees(math.asin(min(1.0, math.sin(math.radians(min(radius_deg, 90.0))) / math.sqrt(2 / 3))))
    return max(0, min(FINEST, math.floor(math.log2(90 / max(widest, 1e-6)))))


def level_of(radius_deg: Column) -> Column:
    """level_for() of each row's own radius."""
    widest = 2 * F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.least(radius_deg, F.lit(90.0)))) / math.sqrt(2 / 3))))
    return F.greatest(F.lit(0), F.least(F.lit(FINEST), F.floor(F.log2(90 / F.greatest(widest, F.lit(1e-6)))).cast("int")))


# every byte with a zero bit after each of its bits
_SPREAD = "array({})".format(", ".join(f"{sum(((b >> k) & 1) << (2 * k) for k in range(8))}L" for b in range(256)))


def _spread(c: Column) -> Column:
    """The bits of a number below 2 ** 24, each followed by a zero bit."""
    table = F.expr(_SPREAD)
    byte = lambda k: F.get(table, F.shiftright(c, 8 * k).bitwiseAND(F.lit(255)).cast("int"))
    return byte(0).bitwiseOR(F.shiftleft(byte(1), 16)).bitwiseOR(F.shiftleft(byte(2), 32))


def cell_code(face: Column, i: Column, j: Column, level: Column | int) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.call_function("shiftleft", face.cast("bigint"), 2 * level).bitwiseOR(_spread(i)).bitwiseOR(F.shiftleft(_spread(j), 1))


def _step(angle: Column, level: Column | int) -> Column:
    n = F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level)
    return F.greatest(F.lit(0), F.least((n - 1).cast("int"), F.floor((angle / QUARTER + 1) * (n / 2)).cast("int")))


def _faces(xyz: tuple[Column, Column, Column]) -> Column:
    """The point as every face sees it: how far ahead it lies and where across."""
    return F.array(*(F.struct(F.lit(f).alias("face"), (xyz[axis] * sign).alias("ahead"), xyz[a].alias("a"), xyz[b].alias("b")) for f, (axis, sign, a, b) in enumerate(FACES)))


def point_cell(xyz: tuple[Column, Column, Column], level: int = FINEST) -> Column:
    """The code of the cell that holds a point, on the first face that it lies most ahead of."""
    own = F.filter(_faces(xyz), lambda f: f.ahead >= F.greatest(*(F.abs(c) for c in xyz)))
    steps = F.transform(own, lambda f: F.struct(f.face.alias("face"), _step(F.atan2(f.a, f.ahead), level).alias("i"), _step(F.atan2(f.b, f.ahead), level).alias("j")))
    return F.get(F.transform(F.slice(steps, 1, 1), lambda s: cell_code(s.face, s.i, s.j, level)), F.lit(0))


def _half(across: Column, ahead: Column, r: Column) -> Column:
    return F.asin(F.least(F.lit(1.0), F.sin(r) / F.sqrt(across * across + ahead * ahead)))


def _grid(face: Column, rows: Column, columns: Column, level: Column) -> Column:
    return F.flatten(F.transform(rows, lambda i: F.transform(columns, lambda j: cell_code(face, i, j, level))))


def disc_cells(xyz: tuple[Column, Column, Column], radius_deg: Column | float, level: Column | int) -> Column:
    """The codes of all cells of a level that a disc around the point meets, on every face it reaches.

    On a face the disc lies between two angles along either axis: the point's own angle plus and minus
    asin(sin r / h), h being the length of the point's projection on the plane of that angle. The radius is below 35
    degrees, so that a face that lies behind the point holds no part of the disc.
    """
    level = F.lit(level) if isinstance(level, int) else level
    r = F.radians(F.lit(radius_deg) if isinstance(radius_deg, float | int) else radius_deg) * (1 + 1e-9) + 1e-12
    ahead_of = F.filter(_faces(xyz), lambda f: f.ahead > 0)
    spans = F.transform(ahead_of, lambda f: F.struct(f.face.alias("face"), F.atan2(f.a, f.ahead).alias("a"), _half(f.a, f.ahead, r).alias("da"), F.atan2(f.b, f.ahead).alias("b"), _half(f.b, f.ahead, r).alias("db")))
    met = F.filter(spans, lambda s: (F.abs(s.a) - s.da <= QUARTER) & (F.abs(s.b) - s.db <= QUARTER))
    cells = F.transform(met, lambda s: _grid(s.face, F.sequence(_step(s.a - s.da, level), _step(s.a + s.da, level)), F.sequence(_step(s.b - s.db, level), _step(s.b + s.db, level)), level))
    return F.array_distinct(F.flatten(cells))


def code_ranges(cells: Column, level: Column | int, bucket_level: int) -> Column:
    """Cells of one level as the fewest ranges ``lo, hi`` of FINEST codes; a range ends where a bucket does."""
    level = F.lit(level) if isinstance(level, int) else level
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), 2 * (level - bucket_level))
    below = F.call_function("shiftleft", F.lit(1).cast("bigint"), 2 * (FINEST - level))
    first = F.array_sort(F.filter(cells, lambda c: (F.pmod(c, size) == 0) | ~F.array_contains(cells, c - 1)))
    last = F.array_sort(F.filter(cells, lambda c: (F.pmod(c + 1, size) == 0) | ~F.array_contains(cells, c + 1)))
    return F.zip_with(first, last, lambda a, b: F.struct((a * below).alias("lo"), ((b + 1) * below - 1).alias("hi")))


def bucket_of(code: Column, bucket_level: int) -> Column:
    """The coarse cell that holds a FINEST code."""
    return F.shiftright(code, 2 * (FINEST - bucket_level))


def separation_deg(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance by the haversine, exact for small angles and across RA 0 and the poles."""
    d1, d2 = F.radians(dec1), F.radians(dec2)
    h = F.pow(F.sin((d2 - d1) / 2), 2) + F.cos(d1) * F.cos(d2) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), 2)
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h))))
