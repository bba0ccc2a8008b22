"""Registered queries: scene catalog, water area, open sea."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import point, rings_to_mercator
from ..operators import scenes as sc
from ..operators import spatial
from ..operators.match import index_scenes
from . import fixtures as fx
from .fixtures import with_views
from .queries_match import predicted
from .registry import register

MERC_SCENES = """SELECT api_id, sensing_time, cloud_cover,
       6378137e0*radians(xmin) AS mx0, 6378137e0*ln(tan(pi()/4 + radians(ymin)/2)) AS my0,
       6378137e0*radians(xmax) AS mx1, 6378137e0*ln(tan(pi()/4 + radians(ymax)/2)) AS my1
FROM scenes"""
MERC_WATER = """SELECT id,
       6378137e0*radians(xmin) AS mx0, 6378137e0*ln(tan(pi()/4 + radians(ymin)/2)) AS my0,
       6378137e0*radians(xmax) AS mx1, 6378137e0*ln(tan(pi()/4 + radians(ymax)/2)) AS my1
FROM water"""
WATER_AREA = """SELECT s.api_id, s.sensing_time, s.cloud_cover,
       round(sum(CASE WHEN w.id IS NOT NULL THEN
             (least(s.mx1, w.mx1) - greatest(s.mx0, w.mx0)) * (least(s.my1, w.my1) - greatest(s.my0, w.my0)) END), 0)
         AS water_area
FROM ms s LEFT JOIN mw w
  ON w.mx0 <= s.mx1 AND w.mx1 >= s.mx0 AND w.my0 <= s.my1 AND w.my1 >= s.my0
GROUP BY s.api_id, s.sensing_time, s.cloud_cover"""


def water_area_df(spark: SparkSession, d: str, scenes: DataFrame | None = None) -> DataFrame:
    water3857 = fx.sea_polygons(spark, d).withColumn("rings", rings_to_mercator("rings"))
    wa = spatial.water_area(fx.catalog(spark, d) if scenes is None else scenes, water3857)
    return wa.select("api_id", "sensing_time", "cloud_cover", F.round("water_area", 0).alias("water_area"))


@register("water_area", with_views("SELECT * FROM wa",
                                   extra={"scenes": fx.CATALOG_SQL, "water": fx.SEAS_SQL, "ms": MERC_SCENES, "mw": MERC_WATER, "wa": WATER_AREA}))
def q_water_area(spark: SparkSession, d: str) -> DataFrame:
    return water_area_df(spark, d)


@register("scene_select", with_views("""
SELECT *, count(*) OVER (PARTITION BY year(sensing_time), month(sensing_time), day(sensing_time)) AS image_count
FROM wa WHERE cloud_cover < 5 AND water_area > 10000000""",
                                     extra={"scenes": fx.CATALOG_SQL, "water": fx.SEAS_SQL, "ms": MERC_SCENES, "mw": MERC_WATER, "wa": WATER_AREA}))
def q_scene_select(spark: SparkSession, d: str) -> DataFrame:
    # cloudy scenes go before their water is measured: a filter after the sum is not pushed below it
    return sc.images_per_day(sc.select_scenes(water_area_df(spark, d, sc.clear_scenes(fx.catalog(spark, d)))))


@register("images_per_day", with_views("""
SELECT api_id, sensing_time,
       count(*) OVER (PARTITION BY year(sensing_time), month(sensing_time), day(sensing_time)) AS image_count
FROM (SELECT api_id, sensing_time - (CAST(substr(api_id, 4) AS INTEGER) % 4) * INTERVAL '1' DAY AS sensing_time FROM scenes) t""",
                                       extra={"scenes": fx.CATALOG_SQL}))
def q_images_per_day(spark: SparkSession, d: str) -> DataFrame:
    # scenes shifted back by (key % 4) days so that several fall on one day
    s = fx.catalog(spark, d).select(
        "api_id", (F.col("sensing_time") - F.make_dt_interval(
            F.substring("api_id", 4, 10).cast("int") % 4, F.lit(0), F.lit(0), F.lit(0))).alias("sensing_time"))
    return sc.images_per_day(s)


@register("scenes_per_day", with_views("""
SELECT CAST(sensing_time AS DATE) AS date, count(*) AS count_per_day
FROM (SELECT sensing_time - (CAST(substr(api_id, 4) AS INTEGER) % 4) * INTERVAL '1' DAY AS sensing_time FROM scenes) t
WHERE sensing_time IS NOT NULL GROUP BY 1""", extra={"scenes": fx.CATALOG_SQL}))
def q_scenes_per_day(spark: SparkSession, d: str) -> DataFrame:
    s = fx.catalog(spark, d).select(
        (F.col("sensing_time") - F.make_dt_interval(
            F.substring("api_id", 4, 10).cast("int") % 4, F.lit(0), F.lit(0), F.lit(0))).alias("sensing_time"))
    return sc.scenes_per_day(s)


INDEX_SQL = """SELECT k AS id, concat('S2_', (k + 1) // 2, '.zip') AS file_name,
       CAST('2024-01-01 10:30:00+00' AS TIMESTAMPTZ) + (k % 60) * INTERVAL '1' DAY AS sensing_time
FROM (SELECT CAST(s_suppkey AS BIGINT) AS k FROM supplier) s"""


def scene_index_df(spark: SparkSession, d: str) -> DataFrame:
    """A product file for each supplier; every two are files of one product."""
    k = F.col("s_suppkey").cast("bigint")
    return fx.table(spark, d, "supplier").select(
        k.alias("id"), F.concat(F.lit("S2_"), F.floor((k + 1) / 2).cast("string"), F.lit(".zip")).alias("file_name"),
        (F.lit("2024-01-01 10:30:00").cast("timestamp") + F.make_dt_interval((k % 60).cast("int"), F.lit(0), F.lit(0), F.lit(0))).alias("sensing_time"))


@register("scene_index", with_views("""
SELECT left(i.file_name, length(i.file_name) - 4) AS product_id, i.id, i.file_name,
       s.api_id, s.cloud_cover, s.xmin, s.ymin, s.xmax, s.ymax
FROM idx i JOIN scenes s ON left(i.file_name, length(i.file_name) - 4) = s.api_id""",
                                    extra={"scenes": fx.CATALOG_SQL, "idx": INDEX_SQL}))
def q_scene_index(spark: SparkSession, d: str) -> DataFrame:
    idx = scene_index_df(spark, d).drop("sensing_time")
    meta = fx.catalog(spark, d).drop("sensing_time")
    j = index_scenes(idx, meta)
    return j.select("product_id", "id", "file_name", "api_id", "cloud_cover", "xmin", "ymin", "xmax", "ymax")


@register("scene_index_safe", with_views("""
SELECT s.api_id AS product_id, i.id, s.api_id || (['.zip', '.SAFE.zip', '.SAFE', ''])[1 + i.id % 4] AS file_name, s.cloud_cover
FROM idx i JOIN scenes s ON left(i.file_name, length(i.file_name) - 4) = s.api_id""", extra={"scenes": fx.CATALOG_SQL, "idx": INDEX_SQL}))
def q_scene_index_safe(spark: SparkSession, d: str) -> DataFrame:
    """File names as archives, folders and bare products spell them."""
    ends = F.element_at(F.array(*[F.lit(e) for e in (".zip", ".SAFE.zip", ".SAFE", "")]), (F.col("id") % 4 + 1).cast("int"))
    idx = scene_index_df(spark, d).drop("sensing_time").withColumn("file_name", F.concat(F.regexp_replace("file_name", "[.]zip$", ""), ends))
    return index_scenes(idx, fx.catalog(spark, d)).select("product_id", "id", "file_name", "cloud_cover")


@register("utc_sensing_time", with_views("""
SELECT id, utc AS sensing_time_without_tz, CAST(utc AS DATE) AS date, CAST(year(utc) AS BIGINT) AS year,
       CAST(month(utc) AS BIGINT) AS month, CAST(day(utc) AS BIGINT) AS day
FROM (SELECT id, CAST(sensing_time AT TIME ZONE 'UTC' AS TIMESTAMP) AS utc FROM idx) t""", extra={"idx": INDEX_SQL}))
def q_utc_sensing_time(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.timefn import calendar_parts
    s = sc.with_utc_wall_clock(scene_index_df(spark, d))
    parts = calendar_parts("sensing_time")
    return s.select("id", "sensing_time_without_tz", parts["date"].alias("date"),
                    parts["year"].cast("bigint").alias("year"), parts["month"].cast("bigint").alias("month"),
                    parts["day"].cast("bigint").alias("day"))


@register("scene_boxes", with_views("""
SELECT api_id,
       CASE WHEN k % 7 IN (0, 1, 2) THEN NULL ELSE least(xmin, xmax) END AS xmin,
       CASE WHEN k % 7 IN (0, 1, 2) THEN NULL ELSE least(ymin, ymax) END AS ymin,
       CASE WHEN k % 7 IN (0, 1, 2) THEN NULL ELSE greatest(xmin, xmax) END AS xmax,
       CASE WHEN k % 7 IN (0, 1, 2) THEN NULL ELSE greatest(ymin, ymax) END AS ymax
FROM (SELECT *, CAST(substr(api_id, 4) AS INTEGER) AS k FROM scenes) s""", extra={"scenes": fx.CATALOG_SQL}))
def q_scene_boxes(spark: SparkSession, d: str) -> DataFrame:
    """B2 + D2 + C2: catalog rows carry the bbox as text (corners in any order,
    some NULL, empty or unparsable); the footprint box is parsed back."""
    s = fx.catalog(spark, d)
    k = F.substring("api_id", 4, 10).cast("int")
    txt = (F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 7 == 1, F.lit(""))
           .when(k % 7 == 2, F.lit("[not, a, box]"))
           .otherwise(F.concat(F.lit("["), F.col("xmax").cast("string"), F.lit(", "), F.col("ymin").cast("string"),
                               F.lit(", "), F.col("xmin").cast("string"), F.lit(", "), F.col("ymax").cast("string"),
                               F.lit("]"))))
    cat = s.select("api_id", txt.alias("bbox"))
    return sc.scene_boxes(cat).select("api_id", "xmin", "ymin", "xmax", "ymax")


@register("point_columns", with_views("""
SELECT id, mmsi, lon AS x, lat AS y FROM ais WHERE lon IS NOT NULL AND lat IS NOT NULL""", "ais"))
def q_point_columns(spark: SparkSession, d: str) -> DataFrame:
    a = fx.ais(spark, d)
    p = a.select("id", "mmsi", point("lon", "lat").alias("geom")).where(F.col("geom").isNotNull())
    return p.select("id", "mmsi", F.col("geom.x").alias("x"), F.col("geom.y").alias("y"))


OPEN_SEA_SQL = with_views("""
SELECT p.* FROM predicted p WHERE EXISTS (
  SELECT 1 FROM water w WHERE p.lon BETWEEN w.xmin AND w.xmax AND p.lat BETWEEN w.ymin AND w.ymax)""",
                          "predicted", "water")


@register("open_sea", OPEN_SEA_SQL)
def q_open_sea(spark: SparkSession, d: str) -> DataFrame:
    return spatial.points_in_polygons(predicted(spark, d), fx.water_polygons(spark, d))


@register("open_sea_mercator", OPEN_SEA_SQL)
def q_open_sea_mercator(spark: SparkSession, d: str) -> DataFrame:
    """Water held in EPSG:3857 as in the reference; D4 brings it back to degrees."""
    w = fx.water_polygons(spark, d).withColumn("rings", rings_to_mercator("rings"))
    return spatial.points_in_polygons(predicted(spark, d), w, polygon_crs=3857)


@register("open_sea_triangles", with_views("""
SELECT p.* FROM predicted p WHERE EXISTS (
  SELECT 1 FROM water w WHERE p.lon >= w.xmin AND p.lat >= w.ymin
     AND (p.lon - w.xmin) * (w.ymax - w.ymin) + (p.lat - w.ymin) * (w.xmax - w.xmin)
         <= (w.xmax - w.xmin) * (w.ymax - w.ymin))""", "predicted", "water"))
def q_open_sea_triangles(spark: SparkSession, d: str) -> DataFrame:
    return spatial.points_in_polygons(predicted(spark, d), fx.water_triangles(spark, d))


@register("touching_boxes", with_views("""
SELECT s.api_id, w.id AS water_id, (s.mx1 = w.mx0 OR s.mx0 = w.mx1 OR s.my1 = w.my0 OR s.my0 = w.my1) AS only_touches
FROM ms s JOIN mw w ON w.mx0 <= s.mx1 AND w.mx1 >= s.mx0 AND w.my0 <= s.my1 AND w.my1 >= s.my0""",
                                       extra={"scenes": fx.CATALOG_SQL, "water": fx.SEAS_SQL, "ms": MERC_SCENES, "mw": MERC_WATER}))
def q_touching_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Scenes and water that intersect, edges and corners that only touch included."""
    water3857 = fx.sea_polygons(spark, d).withColumn("rings", rings_to_mercator("rings"))
    return (spatial.scenes_on_water(fx.catalog(spark, d), water3857)
            .select("api_id", F.col("id").alias("water_id"), (F.col("area") == 0).alias("only_touches")))


@register("open_sea_grown", with_views("""
SELECT a.id, a.lon, a.lat FROM ais a WHERE EXISTS (
  SELECT 1 FROM water w WHERE a.lon BETWEEN w.xmin AND w.xmax AND a.lat BETWEEN w.ymin AND w.ymax)""",
                                       "ais", extra={"water": fx.SEAS_SQL}))
def q_open_sea_grown(spark: SparkSession, d: str) -> DataFrame:
    """E8 over all reports and water that overlaps, touches and grows with the data."""
    return spatial.points_in_polygons(fx.ais(spark, d).select("id", "lon", "lat"), fx.sea_polygons(spark, d))
