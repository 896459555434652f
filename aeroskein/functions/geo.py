"""Geometry as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
#: GRS80 ellipsoid and the parameters of the European equal-area projection EPSG:3035.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
LAT0, LON0, FALSE_E, FALSE_N = 52.0, 10.0, 4321000.0, 3210000.0


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), F.lit(2.0))
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def _authalic(e: float, sin_lat: float) -> float:
    es = e * sin_lat
    return (1 - e * e) * (sin_lat / (1 - es * es) - math.log((1 - es) / (1 + es)) / (2 * e))


def project_laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres on the ellipsoid (Lambert azimuthal equal-area)."""
    e = math.sqrt(2 * FLATTENING - FLATTENING**2)
    qp, q0 = _authalic(e, 1.0), _authalic(e, math.sin(math.radians(LAT0)))
    beta0 = math.asin(q0 / qp)
    rq = SEMI_MAJOR * math.sqrt(qp / 2)
    s0 = math.sin(math.radians(LAT0))
    d = SEMI_MAJOR * math.cos(math.radians(LAT0)) / math.sqrt(1 - (e * s0) ** 2) / (rq * math.cos(beta0))
    es = e * F.sin(F.radians(lat))
    q = (1 - e * e) * (F.sin(F.radians(lat)) / (1 - es * es) - F.log((1 - es) / (1 + es)) / (2 * e))
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / qp)))
    dlon = F.radians(lon - LON0)
    b = rq * F.sqrt(2 / (1 + math.sin(beta0) * F.sin(beta) + math.cos(beta0) * F.cos(beta) * F.cos(dlon)))
    x = FALSE_E + b * d * F.cos(beta) * F.sin(dlon)
    y = FALSE_N + b / d * (math.cos(beta0) * F.sin(beta) - math.sin(beta0) * F.cos(beta) * F.cos(dlon))
    return x, y


def project_plain(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Equirectangular easting and northing in metres, the fallback without a projection."""
    return lon * 111_320.0 * F.cos(F.radians(lat)), lat * 110_540.0


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting; ring is array<struct<x,y>>, open or closed."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def crosses(a: Column, b: Column) -> Column:
        hit = ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])
        return F.coalesce(hit, F.lit(False)).cast("int")

    return F.aggregate(F.zip_with(ring, nxt, crosses), F.lit(0), lambda s, c: s + c) % 2 == 1


def point_in_polygons(x: Column, y: Column, polygons: Column) -> Column:
    """Inside the outer ring of a polygon and outside its holes; polygons is array<array<ring>>."""
    return F.exists(
        polygons,
        lambda p: point_in_ring(x, y, p[0]) & ~F.exists(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda h: point_in_ring(x, y, h)),
    )


def grid_cell(x: Column, y: Column, west: float, south: float, cell_m: float, columns: int, rows: int) -> tuple[Column, Column]:
    """Row and column of a projected point, row 0 in the south; null outside."""
    col, row = F.floor((x - west) / cell_m).cast("int"), F.floor((y - south) / cell_m).cast("int")
    inside = (col >= 0) & (col < columns) & (row >= 0) & (row < rows)
    return F.when(inside, row), F.when(inside, col)
