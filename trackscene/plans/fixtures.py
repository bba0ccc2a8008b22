"""Stand-in inputs over the driver tables (FIXTURES.md part 2).

Each view exists twice: as a Spark DataFrame built from the parquet tables
(column expressions only, so scans prune columns and the plan stays in
codegen), and as DuckDB SQL text used by the oracle.  Both sides must give
the same rows; the oracle text is plain arithmetic (no spatial extension).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import box_ring
from ..session import pin_utc

HALF_WINDOW_MIN = 720  # fixtures: the event data is sparse, 10 min would give almost no pairs
ARCHIVE_BASE = "https://archive.example.org/positions/"  # fixture download base (any base works)


_TABLES: dict[str, tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table; the DataFrame (listing and footer reads done once) is
    reused while the same live session asks again (the test tables never change)."""
    pin_utc(spark)
    path = f"{d}/{name}.parquet"
    hit = _TABLES.get(path)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        return hit[1]
    df = spark.read.parquet(path)
    _TABLES[path] = (spark, df)
    return df


# ------------------------------------------------------------------ Spark views
def ais(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    uid = F.col("user_id")
    ship = (F.when(uid % 7 == 0, "Cargo").when(uid % 7 == 1, "Tanker").when(uid % 7 == 2, "Fishing")
            .when(uid % 7 == 3, "Passenger").when(uid % 7 == 4, "Sailing").when(uid % 7 == 5, "Pleasure"))
    return e.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp_ntz").alias("ts"),
                    uid.alias("mmsi"),
                    (F.lit(8.0) + (F.col("event_id") * 7919 % 6000) / F.lit(1000.0)).alias("lon"),
                    (F.lit(54.0) + (F.col("event_id") * 104729 % 4000) / F.lit(1000.0)).alias("lat"),
                    ship.alias("ship_type"), (F.lit(10) + uid % 200).alias("length"))


def scenes(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    k = F.col("n_nationkey")
    return n.select(F.concat(F.lit("S2_"), k.cast("string")).alias("api_id"),
                    (F.lit("2024-01-01 10:30:00").cast("timestamp_ntz")
                     + F.make_dt_interval(k, F.lit(0), F.lit(0), F.lit(0))).alias("sensing_time"),
                    ((k * 37 % 100) / F.lit(10.0)).alias("cloud_cover"),
                    (F.lit(8.0) + k % 3).alias("xmin"), (F.lit(54.0) + k % 2).alias("ymin"),
                    (F.lit(12.0) + k % 3).alias("xmax"), (F.lit(57.0) + k % 2).alias("ymax"))


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """A scene catalog that grows with the data: a scene for each supplier, several a day, boxes on quarter degrees."""
    k = F.col("s_suppkey").cast("bigint")
    s = table(spark, d, "supplier").select(k.alias("k"))
    x, y = F.lit(4.0) + (F.col("k") % 64) / F.lit(4.0), F.lit(50.0) + (F.col("k") * 7 % 48) / F.lit(4.0)
    return s.select(F.concat(F.lit("S2_"), F.col("k").cast("string")).alias("api_id"),
                    (F.lit("2024-01-01 10:30:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("k") % 60).cast("int"), F.lit(0), F.lit(0), F.lit(0))).alias("sensing_time"),
                    ((F.col("k") * 37 % 100) / F.lit(10.0)).alias("cloud_cover"),
                    x.alias("xmin"), y.alias("ymin"), (x + 4.0).alias("xmax"), (y + 3.0).alias("ymax"))


def seas(spark: SparkSession, d: str) -> DataFrame:
    """Water boxes that grow with the data; their edges lie on quarter degrees too, so that some only touch a scene."""
    k = F.col("s_suppkey").cast("bigint")
    s = table(spark, d, "supplier").select(k.alias("k"))
    x, y = F.lit(3.0) + (F.col("k") * 13 % 84) / F.lit(4.0), F.lit(49.0) + (F.col("k") * 11 % 60) / F.lit(4.0)
    return s.select(F.col("k").alias("id"), x.alias("xmin"), y.alias("ymin"), (x + F.lit(0.75) + (F.col("k") % 3) / F.lit(4.0)).alias("xmax"),
                    (y + F.lit(0.5) + (F.col("k") % 2) / F.lit(4.0)).alias("ymax"))


def sea_polygons(spark: SparkSession, d: str) -> DataFrame:
    return seas(spark, d).select("id", F.array(box_ring("xmin", "ymin", "xmax", "ymax")).alias("rings"))


def passes(spark: SparkSession, d: str) -> DataFrame:
    """Every scene with two sensing times under one api_id, ninety minutes apart."""
    s = scenes(spark, d)
    return s.unionByName(s.withColumn("sensing_time", F.col("sensing_time") + F.make_dt_interval(F.lit(0), F.lit(1), F.lit(30), F.lit(0))))


def water(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "region")
    k = F.col("r_regionkey")
    return r.select(k.cast("bigint").alias("id"),
                    (F.lit(8.0) + k * F.lit(1.2)).alias("xmin"), (F.lit(54.0) + k * F.lit(0.5)).alias("ymin"),
                    (F.lit(8.9) + k * F.lit(1.2)).alias("xmax"), (F.lit(55.7) + k * F.lit(0.5)).alias("ymax"))


def water_polygons(spark: SparkSession, d: str) -> DataFrame:
    """Water boxes as polygon rings (one outer ring each), lon/lat."""
    w = water(spark, d)
    return w.select("id", F.array(box_ring("xmin", "ymin", "xmax", "ymax")).alias("rings"))


def water_triangles(spark: SparkSession, d: str) -> DataFrame:
    """Lower-left half of every water box as a triangle (general D9 polygons)."""
    w = water(spark, d)

    def v(x, y):
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(v("xmin", "ymin"), v("xmax", "ymin"), v("xmin", "ymax"), v("xmin", "ymin"))
    return w.select("id", F.array(ring).alias("rings"))


def archive_dates(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    # the days as an aggregate: filters on archive names are tried on distinct days, not pushed down to every order
    return (o.groupBy(F.date_add(F.lit("2023-10-01").cast("date"), (F.col("o_orderkey") % 600).cast("int")).alias("_d"))
            .agg(F.max(F.date_add(F.lit("2023-10-01").cast("date"), (F.col("o_orderkey") % 600).cast("int"))).alias("d"))
            .select("d"))


# ------------------------------------------------------------------ DuckDB oracle text
US = "date_diff('microsecond', {a}, {b})"


def us(a: str, b: str) -> str:
    return US.format(a=a, b=b)


AIS_SQL = """SELECT event_id AS id, ts, user_id AS mmsi,
       8e0 + (event_id*7919 % 6000)/1000e0 AS lon, 54e0 + (event_id*104729 % 4000)/1000e0 AS lat,
       CASE user_id % 7 WHEN 0 THEN 'Cargo' WHEN 1 THEN 'Tanker' WHEN 2 THEN 'Fishing' WHEN 3 THEN 'Passenger'
                        WHEN 4 THEN 'Sailing' WHEN 5 THEN 'Pleasure' END AS ship_type,
       10 + user_id % 200 AS length
FROM events"""

SCENES_SQL = """SELECT concat('S2_', n_nationkey) AS api_id,
       CAST('2024-01-01 10:30:00' AS TIMESTAMP) + n_nationkey * INTERVAL '1' DAY AS sensing_time,
       (n_nationkey*37 % 100)/10e0 AS cloud_cover,
       8e0 + n_nationkey % 3 AS xmin, 54e0 + n_nationkey % 2 AS ymin,
       12e0 + n_nationkey % 3 AS xmax, 57e0 + n_nationkey % 2 AS ymax
FROM nation"""

WATER_SQL = """SELECT CAST(r_regionkey AS BIGINT) AS id, 8e0 + r_regionkey*1.2e0 AS xmin, 54e0 + r_regionkey*0.5e0 AS ymin,
       8.9e0 + r_regionkey*1.2e0 AS xmax, 55.7e0 + r_regionkey*0.5e0 AS ymax
FROM region"""

CATALOG_SQL = """SELECT concat('S2_', k) AS api_id, CAST('2024-01-01 10:30:00' AS TIMESTAMP) + (k % 60) * INTERVAL '1' DAY AS sensing_time,
       (k*37 % 100)/10e0 AS cloud_cover, 4e0 + (k % 64)/4e0 AS xmin, 50e0 + (k*7 % 48)/4e0 AS ymin,
       8e0 + (k % 64)/4e0 AS xmax, 53e0 + (k*7 % 48)/4e0 AS ymax
FROM (SELECT CAST(s_suppkey AS BIGINT) AS k FROM supplier) s"""

SEAS_SQL = """SELECT k AS id, 3e0 + (k*13 % 84)/4e0 AS xmin, 49e0 + (k*11 % 60)/4e0 AS ymin,
       3.75e0 + (k*13 % 84)/4e0 + (k % 3)/4e0 AS xmax, 49.5e0 + (k*11 % 60)/4e0 + (k % 2)/4e0 AS ymax
FROM (SELECT CAST(s_suppkey AS BIGINT) AS k FROM supplier) s"""

PASSES_SQL = "SELECT * FROM scenes UNION ALL SELECT * REPLACE (sensing_time + INTERVAL '90' MINUTE AS sensing_time) FROM scenes"

MATCHED_SQL = f"""SELECT a.*, s.api_id, s.sensing_time,
         CASE WHEN ts <= sensing_time THEN 'before' ELSE 'after' END AS rel,
         abs({us('sensing_time', 'ts')})/1e6 AS time_diff
  FROM ais a JOIN scenes s
    ON ts BETWEEN sensing_time - INTERVAL '{HALF_WINDOW_MIN}' MINUTE AND sensing_time + INTERVAL '{HALF_WINDOW_MIN}' MINUTE
   AND lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax"""

CLOSEST_SQL = f"""SELECT id, ts, mmsi, lon, lat, ship_type, length, api_id, sensing_time, rel, time_diff FROM (
  SELECT m.*, row_number() OVER (PARTITION BY mmsi, api_id, sensing_time, rel
                                 ORDER BY abs({us('sensing_time', 'ts')}), id) AS rnk
  FROM matched m) t
WHERE rnk = 1"""

PREDICTED_SQL = f"""SELECT b.id, b.mmsi, b.ship_type, b.length, b.api_id, b.sensing_time,
       round(b.lon + (a.lon-b.lon)*{us('b.ts', 'b.sensing_time')}/{us('b.ts', 'a.ts')}, 6) AS lon,
       round(b.lat + (a.lat-b.lat)*{us('b.ts', 'b.sensing_time')}/{us('b.ts', 'a.ts')}, 6) AS lat
FROM closest b JOIN closest a
  ON b.mmsi = a.mmsi AND b.api_id = a.api_id AND b.sensing_time = a.sensing_time
 AND b.rel = 'before' AND a.rel = 'after'"""

ARCHIVE_DATES_SQL = """SELECT DISTINCT CAST(CAST('2023-10-01 00:00:00' AS TIMESTAMP) + (o_orderkey % 600) * INTERVAL '1' DAY AS DATE) AS d
FROM orders"""

VIEWS_SQL = {
    "ais": AIS_SQL,
    "scenes": SCENES_SQL,
    "water": WATER_SQL,
    "matched": MATCHED_SQL,
    "closest": CLOSEST_SQL,
    "predicted": PREDICTED_SQL,
    "archive_dates": ARCHIVE_DATES_SQL,
}
# dependencies between the oracle views, in definition order
_VIEW_ORDER = ["ais", "scenes", "water", "matched", "closest", "predicted", "archive_dates"]
_DEPS = {"matched": ["ais", "scenes"], "closest": ["matched"], "predicted": ["closest"]}


def with_views(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    """Oracle SQL: ``WITH`` the needed fixture views (and their dependencies), then ``body``."""
    need: set[str] = set()

    def add(v):
        if v in need:
            return
        for dep in _DEPS.get(v, []):
            add(dep)
        need.add(v)
    for v in views:
        add(v)
    ctes = [f"{v} AS (\n{VIEWS_SQL[v]}\n)" for v in _VIEW_ORDER if v in need]
    for name, sql in (extra or {}).items():
        ctes.append(f"{name} AS (\n{sql}\n)")
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
