"""Registered queries: pixel index, windows, patch extraction on a formula raster,
patch tags, band completeness, patch-run summary (B15, B16, E11, F17, J1-J3, J5).

Formula raster (FIXTURES.md, scaled down so the tile table stays small):
``v(row, col, band) = (row*31 + col*17 + band_no*7) % 10000`` on a 200 x 200
grid per scene (1.7 km pixels, origin at the UTM corner of the scene box),
cut in 32-pixel tiles, 0 outside; patches are 16 x 16.
"""

from __future__ import annotations

import math

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import UTM_FALSE_EASTING, UTM_FALSE_NORTHING_SOUTH, UTM_K0, WGS84_A, WGS84_F, with_utm
from ..operators import raster as rs
from . import fixtures as fx
from .fixtures import with_views
from .queries_match import predicted
from .registry import register

GRID_N = 200
PIXEL = 1700.0
TILE = 32
PATCH = 16
BANDS = ("B02", "B03", "B04", "B08")
BAND_NO = {"B02": 2, "B03": 3, "B04": 4, "B08": 8}


def grid(spark: SparkSession, d: str) -> DataFrame:
    s = fx.scenes(spark, d)
    zone = F.floor(((F.col("xmin") + F.col("xmax")) / 2 + 180) / 6) + 1
    g = s.select("api_id", "xmin", "ymax", (F.lit(32600) + zone).cast("int").alias("epsg"))
    g = with_utm(g, "xmin", "ymax", "epsg", "x0", "y0")
    return g.select("api_id", "epsg", "x0", "y0", F.lit(PIXEL).alias("pixel_size"),
                    F.lit(GRID_N).alias("n_rows"), F.lit(GRID_N).alias("n_cols"))


TILE_SCHEMA = ("api_id string, band string, tile_row int, tile_col int, tile_h int, tile_w int, "
               "pixels array<bigint>")


def _fill_tiles(batches):
    """Formula pixels of each tile, vectorised with numpy inside the task."""
    for pdf in batches:
        px = []
        for r0, c0, h, w, bno in zip(pdf["tile_row"] * TILE, pdf["tile_col"] * TILE, pdf["tile_h"], pdf["tile_w"],
                                     pdf["bno"]):
            rows = np.arange(r0, r0 + h, dtype=np.int64)[:, None]
            cols = np.arange(c0, c0 + w, dtype=np.int64)[None, :]
            px.append(((rows * 31 + cols * 17 + int(bno) * 7) % 10000).ravel())
        yield pdf.drop(columns=["bno"]).assign(pixels=px)


def tiles(spark: SparkSession, d: str) -> DataFrame:
    """Decoded band tiles of every scene, generated from the formula."""
    g = grid(spark, d).select("api_id")
    n_t = (GRID_N + TILE - 1) // TILE
    band_arr = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(BAND_NO[b]).alias("bno")) for b in BANDS])
    idx = F.sequence(F.lit(0), F.lit(n_t - 1))
    t = (g.select("api_id", F.inline(band_arr))
         .select("*", F.explode(idx).alias("tile_row"))
         .select("*", F.explode(idx).alias("tile_col")))
    return t.select("api_id", "band", F.col("tile_row").cast("int").alias("tile_row"),
                    F.col("tile_col").cast("int").alias("tile_col"),
                    F.least(F.lit(TILE), F.lit(GRID_N) - F.col("tile_row") * TILE).cast("int").alias("tile_h"),
                    F.least(F.lit(TILE), F.lit(GRID_N) - F.col("tile_col") * TILE).cast("int").alias("tile_w"),
                    "bno").mapInPandas(_fill_tiles, TILE_SCHEMA)


def windows(spark: SparkSession, d: str) -> DataFrame:
    p = rs.pixel_index(predicted(spark, d), grid(spark, d))
    w = rs.centered_window("row", "col", PATCH)
    return p.select("*", w["row0"].alias("row0"), w["col0"].alias("col0"))


# ------------------------------------------------------------------ DuckDB twin of the UTM projection
def _utm_sql(lon: str, lat: str, epsg: str) -> tuple[str, str]:
    n = WGS84_F / (2 - WGS84_F)
    big_a = WGS84_A / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    alpha = [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16, 13 * n ** 2 / 48 - 3 * n ** 3 / 5, 61 * n ** 3 / 240]
    k = 2 * math.sqrt(n) / (1 + n)
    lam0 = f"radians(({epsg} % 100) * 6 - 183)"
    dlam = f"(radians({lon}) - {lam0})"
    t = f"sinh(atanh(sin(radians({lat}))) - {k!r} * atanh({k!r} * sin(radians({lat}))))"
    xi = f"atan({t} / cos({dlam}))"
    eta = f"atanh(sin({dlam}) / sqrt(1e0 + {t} * {t}))"
    e_sum, n_sum = eta, xi
    for j, a in enumerate(alpha, start=1):
        e_sum = f"({e_sum} + {a!r} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta}))"
        n_sum = f"({n_sum} + {a!r} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta}))"
    x = f"({UTM_FALSE_EASTING!r} + {UTM_K0 * big_a!r} * {e_sum})"
    south = f"CASE WHEN {epsg} BETWEEN 32701 AND 32760 THEN {UTM_FALSE_NORTHING_SOUTH!r} ELSE 0e0 END"
    y = f"({south} + {UTM_K0 * big_a!r} * {n_sum})"
    return x, y


_GX, _GY = _utm_sql("xmin", "ymax", "epsg")
GRID_SQL = f"""SELECT api_id, epsg, {_GX} AS x0, {_GY} AS y0 FROM (
  SELECT api_id, xmin, ymax, CAST(32600 + floor(((xmin + xmax) / 2 + 180) / 6) + 1 AS INTEGER) AS epsg FROM scenes) s"""
_PX, _PY = _utm_sql("p.lon", "p.lat", "g.epsg")
PIXEL_SQL = f"""SELECT p.*, CAST(floor((g.y0 - {_PY}) / {PIXEL!r}) AS BIGINT) AS row,
       CAST(floor(({_PX} - g.x0) / {PIXEL!r}) AS BIGINT) AS col
FROM predicted p JOIN grid g ON p.api_id = g.api_id"""
WIN_SQL = f"SELECT *, row - {PATCH // 2} AS row0, col - {PATCH // 2} AS col0 FROM px"
RASTER_VIEWS = {"grid": GRID_SQL, "px": PIXEL_SQL, "win": WIN_SQL}


@register("pixel_index", with_views("SELECT id, api_id, row, col FROM px", "predicted", "scenes",
                                    extra={"grid": GRID_SQL, "px": PIXEL_SQL}))
def q_pixel_index(spark: SparkSession, d: str) -> DataFrame:
    p = rs.pixel_index(predicted(spark, d), grid(spark, d))
    return p.select("id", "api_id", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"))


@register("patch_window", with_views("SELECT id, api_id, row0, col0 FROM win", "predicted", "scenes",
                                     extra=RASTER_VIEWS))
def q_patch_window(spark: SparkSession, d: str) -> DataFrame:
    return windows(spark, d).select("id", "api_id", "row0", "col0")


def _band_sql(bno: int) -> str:
    return (f"list_transform(range(0, {PATCH * PATCH}), lambda k: CASE WHEN row0 + k // {PATCH} BETWEEN 0 AND {GRID_N - 1} "
            f"AND col0 + k % {PATCH} BETWEEN 0 AND {GRID_N - 1} "
            f"THEN CAST(((row0 + k // {PATCH}) * 31 + (col0 + k % {PATCH}) * 17 + {bno} * 7) % 10000 AS BIGINT) "
            f"ELSE CAST(0 AS BIGINT) END)")


@register("extract_patches", with_views(
    "SELECT id, api_id, [" + ", ".join(_band_sql(BAND_NO[b]) for b in BANDS) + "] AS bands FROM win",
    "predicted", "scenes", extra=RASTER_VIEWS))
def q_extract_patches(spark: SparkSession, d: str) -> DataFrame:
    return rs.extract_patches(windows(spark, d), tiles(spark, d), size=PATCH, tile=TILE, bands=BANDS)


@register("extract_patches_float", with_views(
    "SELECT id, api_id, [" + ", ".join(f"list_transform({_band_sql(BAND_NO[b])}, lambda v: v / 4e0)" for b in BANDS) + "] AS bands FROM win",
    "predicted", "scenes", extra=RASTER_VIEWS))
def q_extract_patches_float(spark: SparkSession, d: str) -> DataFrame:
    """The same patches from tiles with fractional pixels."""
    t = tiles(spark, d)
    t = t.withColumn("pixels", F.transform("pixels", lambda v: v / F.lit(4.0)))
    return rs.extract_patches(windows(spark, d), t, size=PATCH, tile=TILE, bands=BANDS)


@register("patch_tags", with_views("""
SELECT api_id, CAST(mmsi AS VARCHAR) AS mmsi, ship_type, lon, lat, id AS record_id,
       CAST(sensing_time AS VARCHAR) AS sensing_time, 'B02,B03,B04,B08' AS bands
FROM predicted""", "predicted"))
def q_patch_tags(spark: SparkSession, d: str) -> DataFrame:
    return rs.patch_tags(predicted(spark, d), BANDS)


# ------------------------------------------------------------------ E11: band members of scene archives
def members(spark: SparkSession, d: str) -> DataFrame:
    """Archive listings per scene: a QI_DATA decoy first, a 20 m B02, two 10 m B03
    copies, B08 missing when key % 5 == 0 and TCI missing when key % 3 == 0."""
    s = fx.catalog(spark, d).select("api_id", F.substring("api_id", 4, 10).cast("int").alias("k"))
    root = F.concat(F.col("api_id"), F.lit(".SAFE/GRANULE/L2A/"))
    entries = F.array(
        F.concat(root, F.lit("QI_DATA/T_B02_10m.jp2")),
        F.concat(root, F.lit("IMG_DATA/R20m/T_B02_20m.jp2")),
        F.concat(root, F.lit("IMG_DATA/R10m/T_B02_10m.jp2")),
        F.concat(root, F.lit("IMG_DATA/R10m/T_B03_10m.jp2")),
        F.concat(root, F.lit("IMG_DATA/R10m/copy_B03_10m.jp2")),
        F.concat(root, F.lit("IMG_DATA/R10m/T_B04_10m.jp2")),
        F.when(F.col("k") % 5 != 0, F.concat(root, F.lit("IMG_DATA/R10m/T_B08_10m.jp2"))),
        F.when(F.col("k") % 3 != 0, F.concat(root, F.lit("IMG_DATA/R10m/T_TCI_10m.jp2"))))
    return (s.select("api_id", F.posexplode(entries).alias("ordinal", "member"))
            .where(F.col("member").isNotNull()).select("api_id", F.col("ordinal").cast("bigint").alias("ordinal"), "member"))


MEMBERS_SQL = """SELECT api_id, CAST(o - 1 AS BIGINT) AS ordinal, member FROM (
  SELECT api_id, generate_subscripts(m, 1) AS o, unnest(m) AS member FROM (
    SELECT api_id, [api_id || '.SAFE/GRANULE/L2A/QI_DATA/T_B02_10m.jp2',
                    api_id || '.SAFE/GRANULE/L2A/IMG_DATA/R20m/T_B02_20m.jp2',
                    api_id || '.SAFE/GRANULE/L2A/IMG_DATA/R10m/T_B02_10m.jp2',
                    api_id || '.SAFE/GRANULE/L2A/IMG_DATA/R10m/T_B03_10m.jp2',
                    api_id || '.SAFE/GRANULE/L2A/IMG_DATA/R10m/copy_B03_10m.jp2',
                    api_id || '.SAFE/GRANULE/L2A/IMG_DATA/R10m/T_B04_10m.jp2',
                    CASE WHEN CAST(substr(api_id, 4) AS INTEGER) % 5 <> 0 THEN api_id || '.SAFE/GRANULE/L2A/IMG_DATA/R10m/T_B08_10m.jp2' END,
                    CASE WHEN CAST(substr(api_id, 4) AS INTEGER) % 3 <> 0 THEN api_id || '.SAFE/GRANULE/L2A/IMG_DATA/R10m/T_TCI_10m.jp2' END] AS m
    FROM scenes) a) b
WHERE member IS NOT NULL"""
SUFFIX_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{b}', '{rs.BAND_SUFFIX[b]}', {i})" for i, b in enumerate(BANDS + ("TCI",))) + ") v(band, suffix, band_ord)"


@register("band_complete", with_views("""
SELECT f.api_id, f.band, f.member FROM (
  SELECT m.api_id, s.band, arg_min(m.member, m.ordinal) AS member
  FROM mem m JOIN sfx s ON contains(m.member, '/IMG_DATA/') AND ends_with(m.member, s.suffix)
  GROUP BY m.api_id, s.band) f
WHERE f.api_id IN (SELECT api_id FROM (
  SELECT m.api_id, count(DISTINCT s.band) AS n
  FROM mem m JOIN sfx s ON contains(m.member, '/IMG_DATA/') AND ends_with(m.member, s.suffix)
  WHERE s.band <> 'TCI' GROUP BY m.api_id) c WHERE n = 4)""", extra={"scenes": fx.CATALOG_SQL, "mem": MEMBERS_SQL, "sfx": SUFFIX_SQL}))
def q_band_complete(spark: SparkSession, d: str) -> DataFrame:
    return rs.band_members(members(spark, d), BANDS + ("TCI",)).select("api_id", "band", "member")


@register("patch_summary", with_views("""
SELECT api_id, CAST(count_if(id % 8 <> 0) AS BIGINT) AS made, CAST(count_if(id % 8 = 0) AS BIGINT) AS skipped
FROM predicted GROUP BY api_id""",
                                      "predicted"))
def q_patch_summary(spark: SparkSession, d: str) -> DataFrame:
    p = predicted(spark, d)
    k = rs.patch_keys(p, "patches")
    existing = (k.where(F.col("id") % 4 == 0).select("key")
                .unionByName(k.where(F.col("id") % 8 == 0).select(F.col("tci_key").alias("key"))))
    return rs.patch_run_summary(p, existing, "patches", save_tci=True)
