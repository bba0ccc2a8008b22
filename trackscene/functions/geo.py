"""Geometry as plain column expressions (D1-D11); no geometry library.

Points are two DOUBLE columns; an axis-aligned box is four DOUBLE columns
(xmin, ymin, xmax, ymax); a polygon is ``ARRAY<ARRAY<STRUCT<x,y>>>`` (rings,
first outer, the rest holes, each closed: last vertex = first).  All tests
are JVM-side expressions, so they stay in whole-stage codegen and are legal
inside join conditions (a Python UDF is not).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: spherical web-mercator radius, WGS84 ellipsoid, UTM scale and offsets
EARTH_RADIUS_M = 6378137.0
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- D1 / D2 / D11
def point(lon, lat) -> Column:
    """A point struct only where both coordinates are present."""
    lon, lat = _c(lon), _c(lat)
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("x"), lat.alias("y")))


def envelope(x1, y1, x2, y2) -> dict[str, Column]:
    """Axis-aligned box from two corners in any order."""
    x1, y1, x2, y2 = map(_c, (x1, y1, x2, y2))
    return {"xmin": F.least(x1, x2), "ymin": F.least(y1, y2),
            "xmax": F.greatest(x1, x2), "ymax": F.greatest(y1, y2)}


def is_empty_point(lon, lat) -> Column:
    """A point is empty/invalid when a coordinate is NULL or NaN."""
    lon, lat = _c(lon), _c(lat)
    return lon.isNull() | lat.isNull() | F.isnan(lon) | F.isnan(lat)


def box_ring(xmin, ymin, xmax, ymax) -> Column:
    """Closed 5-vertex ring of a box, counter-clockwise."""
    xmin, ymin, xmax, ymax = map(_c, (xmin, ymin, xmax, ymax))

    def v(x, y):
        return F.struct(x.alias("x"), y.alias("y"))
    return F.array(v(xmin, ymin), v(xmax, ymin), v(xmax, ymax), v(xmin, ymax), v(xmin, ymin))


# ---------------------------------------------------------------- D3 / D4
def mercator_x(lon) -> Column:
    """D3: EPSG:4326 longitude -> EPSG:3857 x (spherical)."""
    return F.lit(EARTH_RADIUS_M) * F.radians(_c(lon))


def mercator_y(lat) -> Column:
    """D3: EPSG:4326 latitude -> EPSG:3857 y (spherical)."""
    return F.lit(EARTH_RADIUS_M) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(_c(lat)) / 2))


def inverse_mercator_lon(x) -> Column:
    """EPSG:3857 x -> longitude."""
    return F.degrees(_c(x) / F.lit(EARTH_RADIUS_M))


def inverse_mercator_lat(y) -> Column:
    """EPSG:3857 y -> latitude."""
    return F.degrees(F.lit(2.0) * F.atan(F.exp(_c(y) / F.lit(EARTH_RADIUS_M))) - F.lit(math.pi / 2))


def rings_to_mercator(rings) -> Column:
    """D3 on every vertex of a polygon column."""
    return F.transform(_c(rings), lambda r: F.transform(
        r, lambda p: F.struct(mercator_x(p["x"]).alias("x"), mercator_y(p["y"]).alias("y"))))


def rings_from_mercator(rings) -> Column:
    """D4 on every vertex (edges stay straight in degrees afterwards)."""
    return F.transform(_c(rings), lambda r: F.transform(
        r, lambda p: F.struct(inverse_mercator_lon(p["x"]).alias("x"),
                              inverse_mercator_lat(p["y"]).alias("y"))))


# ---------------------------------------------------------------- D5
def _utm_constants():
    n = WGS84_F / (2 - WGS84_F)
    big_a = WGS84_A / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    alpha = [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16,
             13 * n ** 2 / 48 - 3 * n ** 3 / 5,
             61 * n ** 3 / 240]
    k = 2 * math.sqrt(n) / (1 + n)
    return big_a, alpha, k


def _utm_xi_eta(lon: Column, lat: Column, epsg: Column) -> tuple[Column, Column]:
    big_a, alpha, k = _utm_constants()
    lam0 = F.radians((epsg % 100) * 6 - 183)
    dlam = F.radians(lon) - lam0
    sphi = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sphi) - F.lit(k) * F.atanh(F.lit(k) * sphi))
    return F.atan(t / F.cos(dlam)), F.atanh(F.sin(dlam) / F.sqrt(F.lit(1.0) + t * t))


def _utm_from_xi_eta(xi: Column, eta: Column, epsg: Column) -> dict[str, Column]:
    big_a, alpha, _ = _utm_constants()
    e_sum, n_sum = eta, xi
    for j, a_j in enumerate(alpha, start=1):
        e_sum = e_sum + F.lit(a_j) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n_sum = n_sum + F.lit(a_j) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    south = (epsg >= 32701) & (epsg <= 32760)
    known = south | ((epsg >= 32601) & (epsg <= 32660))  # any other code is no UTM zone: NULL
    return {"x": F.when(known, F.lit(UTM_FALSE_EASTING) + F.lit(UTM_K0 * big_a) * e_sum),
            "y": F.when(known, F.when(south, F.lit(UTM_FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))
                        + F.lit(UTM_K0 * big_a) * n_sum)}


def utm(lon, lat, epsg) -> dict[str, Column]:
    """WGS84 lon/lat -> UTM easting/northing for EPSG 326zz (north) / 327zz (south), NULL for other codes.

    Krueger series to third order in n (sub-millimetre inside a zone).  As one
    expression the series repeats its inner terms; on DataFrames prefer
    ``with_utm``, which materialises them once per row.
    """
    lon, lat, epsg = _c(lon), _c(lat), _c(epsg)
    xi, eta = _utm_xi_eta(lon, lat, epsg)
    return _utm_from_xi_eta(xi, eta, epsg)


def with_utm(df, lon: str, lat: str, epsg: str, out_x: str = "utm_x", out_y: str = "utm_y"):
    """D5 on a DataFrame: the shared terms (xi, eta) are computed in their own
    projection, so the series stays small enough for whole-stage codegen."""
    xi, eta = _utm_xi_eta(F.col(lon), F.col(lat), F.col(epsg))
    d = df.select("*", xi.alias("_utm_xi"), eta.alias("_utm_eta"))
    r = _utm_from_xi_eta(F.col("_utm_xi"), F.col("_utm_eta"), F.col(epsg))
    return d.select(*[F.col(f"`{c}`") for c in df.columns], r["x"].alias(out_x), r["y"].alias(out_y))


# ---------------------------------------------------------------- D8 / D9


def _edges_expr(ring: str) -> str:
    return (f"zip_with(slice({ring}, 1, greatest(size({ring}) - 1, 0)), "
            f"slice({ring}, 2, greatest(size({ring}) - 1, 0)), "
            f"(a, b) -> named_struct('ax', a.x, 'ay', a.y, 'bx', b.x, 'by', b.y))")


def crossings_sql(px: str, py: str, rings: str) -> str:
    """How many edges of all rings a ray from the point to the right crosses: odd inside."""
    return (f"aggregate({rings}, 0, (acc, r) -> acc + size(filter({_edges_expr('r')}, e -> "
            f"(e.ay > {py}) <> (e.by > {py}) AND "
            f"{px} < try_divide((e.bx - e.ax) * ({py} - e.ay), e.by - e.ay) + e.ax)))")


def point_in_polygon_sql(px: str, py: str, rings: str) -> str:
    """D9 as a SQL expression: inside or on the boundary (holes excluded, hole
    boundary included).  Even-odd crossing count over all rings plus an exact
    on-segment test.  Horizontal edges never reach the division (they fail the
    straddle test) and ``try_divide`` keeps ANSI mode from raising anyway."""
    on_seg = (f"exists({rings}, r -> exists({_edges_expr('r')}, e -> "
              f"(e.bx - e.ax) * ({py} - e.ay) = (e.by - e.ay) * ({px} - e.ax) "
              f"AND {px} BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx) "
              f"AND {py} BETWEEN least(e.ay, e.by) AND greatest(e.ay, e.by)))")
    return f"(({on_seg}) OR ({crossings_sql(px, py, rings)}) % 2 = 1)"


def point_in_polygon(px: str, py: str, rings: str) -> Column:
    """D9 on named columns."""
    return F.expr(point_in_polygon_sql(px, py, rings))


# ---------------------------------------------------------------- D10
def interpolate(lon0, lat0, lon1, lat1, past_us, total_us) -> dict[str, Column]:
    """Linear interpolation in degrees; fraction past/total, 0.5 when total = 0."""
    lon0, lat0, lon1, lat1, past_us, total_us = map(_c, (lon0, lat0, lon1, lat1, past_us, total_us))
    lon = F.when(total_us > 0, lon0 + (lon1 - lon0) * past_us / total_us).otherwise(
        lon0 + (lon1 - lon0) * F.lit(0.5))
    lat = F.when(total_us > 0, lat0 + (lat1 - lat0) * past_us / total_us).otherwise(
        lat0 + (lat1 - lat0) * F.lit(0.5))
    return {"lon": lon, "lat": lat}
