"""Planar pointy-top hexagonal grid as pure column expressions.

A point is projected around a reference latitude, turned into axial hex
coordinates and cube-rounded.  The cell id is ``hx<res>_<q>_<r>``; the side of
a cell shrinks by sqrt(7) per resolution, 0.53272 km at resolution 8
(0.737 km2).  Cells partition the plane, so grouping by cell id behaves as
grouping by any hexagonal index does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
REF_LAT = -6.2
SIDE_RES8_KM = 0.53272


def side_km(res: int) -> float:
    """Cell side, kept to 5 decimals so that plans and SQL state the same number."""
    return round(SIDE_RES8_KM * math.sqrt(7.0) ** (8 - res), 5)


def _axial(lat: Column, lon: Column, res: int, ref_lat: float) -> tuple[Column, Column]:
    x = F.lit(EARTH_KM) * F.radians(lon) * F.cos(F.radians(F.lit(ref_lat)))
    y = F.lit(EARTH_KM) * F.radians(lat)
    s = F.lit(side_km(res))
    q = (F.sqrt(F.lit(3.0)) / F.lit(3.0) * x - y / F.lit(3.0)) / s
    r = (F.lit(2.0) / F.lit(3.0) * y) / s
    return q, r


def _floor(c: Column) -> Column:
    return F.floor(c).cast("double")


def hex_axial(lat: Column, lon: Column, res: int = 8, ref_lat: float = REF_LAT) -> tuple[Column, Column]:
    """Integer axial coordinates of the cell that holds the point."""
    q, r = _axial(lat, lon, res, ref_lat)
    half = F.lit(0.5)
    rq, rr, rs = _floor(q + half), _floor(r + half), _floor(half - q - r)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs + q + r)
    q_off = (dq > dr) & (dq > ds)
    hq = F.when(q_off, -rr - rs).otherwise(rq)
    hr = F.when(q_off, rr).when(dr > ds, -rq - rs).otherwise(rr)
    return hq.cast("bigint"), hr.cast("bigint")


def hex_cell(lat: Column, lon: Column, res: int = 8, ref_lat: float = REF_LAT) -> Column:
    """Cell id; NULL when a coordinate is missing."""
    hq, hr = hex_axial(lat, lon, res, ref_lat)
    return F.when(lat.isNotNull() & lon.isNotNull(),
                  F.concat(F.lit(f"hx{res}_"), hq.cast("string"), F.lit("_"), hr.cast("string")))


def cell_parts(cell: Column) -> tuple[Column, Column, Column]:
    """(resolution, q, r) read back from a cell id."""
    part = F.split(cell, "_")
    return (F.substring(part.getItem(0), 3, 3).cast("int"),
            part.getItem(1).cast("bigint"), part.getItem(2).cast("bigint"))


def _side_of(res: Column) -> Column:
    return F.element_at(F.array(*[F.lit(side_km(k)) for k in range(16)]), res + 1)


def hex_centre(cell: Column, ref_lat: float = REF_LAT) -> tuple[Column, Column]:
    """(lat, lon) of the centre of a cell."""
    res, q, r = cell_parts(cell)
    s = _side_of(res)
    x = s * F.sqrt(F.lit(3.0)) * (q.cast("double") + r.cast("double") / F.lit(2.0))
    y = s * F.lit(1.5) * r.cast("double")
    lat = F.degrees(y / F.lit(EARTH_KM))
    lon = F.degrees(x / (F.lit(EARTH_KM) * F.cos(F.radians(F.lit(ref_lat)))))
    return lat, lon


def hex_boundary(cell: Column, ref_lat: float = REF_LAT, digits: int = 6) -> Column:
    """Closed ring ``ARRAY<ARRAY<DOUBLE>>`` in (lon, lat) order: six corners and the first again."""
    lat, lon = hex_centre(cell, ref_lat)
    scale = F.lit(float(10**digits))
    shrink = F.lit(EARTH_KM) * F.cos(F.radians(F.lit(ref_lat)))

    def ring(c: Column) -> Column:
        corners = []
        for k in range(7):
            angle = math.radians(30 + 60 * (k % 6))
            x = c["lon"] + F.degrees(c["s"] * F.lit(math.cos(angle)) / shrink)
            y = c["lat"] + F.degrees(c["s"] * F.lit(math.sin(angle)) / F.lit(EARTH_KM))
            corners.append(F.array(F.rint(x * scale) / scale, F.rint(y * scale) / scale))
        return F.array(*corners)

    # the one-element array lets all corners share one evaluation of the centre
    centre = F.struct(lat.alias("lat"), lon.alias("lon"), _side_of(cell_parts(cell)[0]).alias("s"))
    return F.transform(F.array(centre), ring)[0]


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))
