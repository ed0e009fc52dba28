"""Tangent-plane projection of sky positions to pixels and back, as Column expressions; positions in degrees, pixels counted from 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_pixel(ra: Column, dec: Column, ra0: Column, dec0: Column, scale_deg: float, x_ref: float, y_ref: float) -> tuple[Column, Column]:
    """Pixel of a position on an image with its reference pixel at (ra0, dec0), RA growing to the left; null for the far half of the sky."""
    d, d0, dra = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    ahead = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(dra)
    xi = F.degrees(F.cos(d) * F.sin(dra) / ahead)
    eta = F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(dra)) / ahead)
    return F.when(ahead > 0, x_ref - xi / scale_deg), F.when(ahead > 0, y_ref + eta / scale_deg)


def to_sky(x: Column, y: Column, ra0: Column, dec0: Column, scale_deg: float, x_ref: float, y_ref: float) -> tuple[Column, Column]:
    xi, eta, d0 = F.radians((x_ref - x) * scale_deg), F.radians((y - y_ref) * scale_deg), F.radians(dec0)
    below = F.cos(d0) - eta * F.sin(d0)
    ra = ra0 + F.degrees(F.atan2(xi, below))
    dec = F.degrees(F.atan2(F.sin(d0) + eta * F.cos(d0), F.hypot(xi, below)))
    return F.pmod(ra, F.lit(360.0)), dec


def detector_pixel(x: Column, y: Column, crpix1: Column, crpix2: Column) -> tuple[Column, Column]:
    """Place on the detector of a cutout's pixel; the cutout's own place where its header lacks the offset."""
    return F.when(crpix1.isNotNull() & crpix2.isNotNull(), 1 + x - crpix1).otherwise(x), F.when(crpix1.isNotNull() & crpix2.isNotNull(), 1 + y - crpix2).otherwise(y)


def mjd_time(mjd: Column) -> Column:
    """UTC time of a modified Julian date."""
    return F.timestamp_seconds((mjd - 40587) * 86400)


def polynomial(u: Column, v: Column, terms: dict[tuple[int, int], float | Column]) -> Column:
    """The sum of coefficients times powers of u and v."""
    out = F.lit(0.0)
    for (p, q), c in sorted(terms.items()):
        out = out + (c if isinstance(c, Column) else F.lit(float(c))) * F.pow(u, F.lit(float(p))) * F.pow(v, F.lit(float(q)))
    return out


def to_image(ra: Column, dec: Column, ra0: Column, dec0: Column, cd: tuple[Column, Column, Column, Column], crpix: tuple[Column, Column], a: dict, b: dict, turns: int = 12) -> tuple[Column, Column]:
    """Pixel, counted from 0, of a position on an image with a matrix of scales and distortion polynomials; null for the far half of the sky.

    ``cd`` are the four entries row by row. The polynomials give the way from pixels to the sky, so the way back is
    found in turns: what is distorted from the place found so far is taken off the place wanted.
    """
    d, d0, dra = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    ahead = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(dra)
    xi = F.degrees(F.cos(d) * F.sin(dra) / ahead)
    eta = F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(dra)) / ahead)
    det = cd[0] * cd[3] - cd[1] * cd[2]
    wanted = F.struct(((cd[3] * xi - cd[1] * eta) / det).alias("u"), ((cd[0] * eta - cd[2] * xi) / det).alias("v"))
    found = F.transform(F.array(wanted), lambda w: F.aggregate(F.sequence(F.lit(1), F.lit(turns)), w, lambda t, _: F.struct((w.u - polynomial(t.u, t.v, a)).alias("u"), (w.v - polynomial(t.u, t.v, b)).alias("v"))))
    at = F.get(found, F.lit(0))
    return F.when(ahead > 0, at["u"] + crpix[0] - 1), F.when(ahead > 0, at["v"] + crpix[1] - 1)
