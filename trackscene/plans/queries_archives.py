"""Registered queries: archive planning, record cleaning, JSON flattening, keys
(A4-A6, A11, B9-B11, C3, C4, C7, C8, F3, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import utc_ntz
from ..operators import archives as ar
from ..operators import records as rec
from . import fixtures as fx
from .fixtures import ARCHIVE_BASE, with_views
from .registry import register

BASE_SQL = ARCHIVE_BASE.rstrip("/")
ZIP_SQL = """CASE WHEN d >= DATE '2024-03-01' THEN 'aisdk-' || strftime(d, '%Y-%m-%d') || '.zip'
                  ELSE 'aisdk-' || strftime(d, '%Y-%m') || '.zip' END"""
URL_SQL = f"""'{BASE_SQL}/' || CASE WHEN d >= DATE '2025-01-01' THEN '' WHEN d >= DATE '2024-03-01' THEN '2024/'
                                   ELSE strftime(d, '%Y') || '/' END || {ZIP_SQL}"""
PLAN_SQL = f"SELECT DISTINCT {ZIP_SQL} AS zipname, {URL_SQL} AS url FROM archive_dates"
# archive keys: every archive name under a folder, plus a same-named CSV per date that is no archive
KEYS_SQL = f"""SELECT 'raw/ais/' || zipname AS key FROM ({PLAN_SQL}) p
UNION ALL SELECT 'raw/ais/aisdk-' || strftime(d, '%Y-%m-%d') || '.csv' AS key FROM archive_dates WHERE day(d) = 1"""


def archive_keys(spark: SparkSession, d: str) -> DataFrame:
    dates = fx.archive_dates(spark, d)
    plan = ar.archive_plan(dates.withColumnRenamed("d", "date"), ARCHIVE_BASE)
    zips = plan.select(F.concat(F.lit("raw/ais/"), F.col("zipname")).alias("key"))
    csvs = (dates.where(F.dayofmonth("d") == 1)
            .select(F.concat(F.lit("raw/ais/aisdk-"), F.date_format("d", "yyyy-MM-dd"), F.lit(".csv")).alias("key")))
    return zips.unionByName(csvs)


@register("archive_urls", with_views(PLAN_SQL, "archive_dates"))
def q_archive_urls(spark: SparkSession, d: str) -> DataFrame:
    return ar.archive_plan(fx.archive_dates(spark, d).withColumnRenamed("d", "date"), ARCHIVE_BASE)


@register("archive_ranges", with_views("""
SELECT key,
       CASE WHEN regexp_matches(key, '^raw/ais/aisdk-\\d+-\\d+\\.zip$')
            THEN CAST(strptime(regexp_extract(key, 'aisdk-(\\d+-\\d+)\\.zip', 1) || '-01', '%Y-%m-%d') AS DATE)
            WHEN regexp_matches(key, '^raw/ais/aisdk-\\d+-\\d+-\\d+\\.zip$')
            THEN CAST(strptime(regexp_extract(key, 'aisdk-(\\d+-\\d+-\\d+)\\.zip', 1), '%Y-%m-%d') AS DATE) END AS zip_start,
       CASE WHEN regexp_matches(key, '^raw/ais/aisdk-\\d+-\\d+\\.zip$')
            THEN CAST(strptime(regexp_extract(key, 'aisdk-(\\d+-\\d+)\\.zip', 1) || '-01', '%Y-%m-%d') + INTERVAL '1' MONTH AS DATE)
            WHEN regexp_matches(key, '^raw/ais/aisdk-\\d+-\\d+-\\d+\\.zip$')
            THEN CAST(strptime(regexp_extract(key, 'aisdk-(\\d+-\\d+-\\d+)\\.zip', 1), '%Y-%m-%d') + INTERVAL '1' DAY AS DATE) END AS zip_end
FROM keys""", "archive_dates", extra={"keys": KEYS_SQL}))
def q_archive_ranges(spark: SparkSession, d: str) -> DataFrame:
    return ar.with_archive_range(archive_keys(spark, d))


@register("archive_filter", with_views("""
SELECT key FROM r WHERE zip_start IS NOT NULL AND zip_end > DATE '2024-01-15' AND zip_start < DATE '2024-06-01'
   AND contains(key, 'aisdk')""", "archive_dates", extra={"keys": KEYS_SQL, "r": """
SELECT key,
       CASE WHEN regexp_matches(key, '^raw/ais/aisdk-\\d+-\\d+\\.zip$')
            THEN CAST(strptime(regexp_extract(key, 'aisdk-(\\d+-\\d+)\\.zip', 1) || '-01', '%Y-%m-%d') AS DATE)
            WHEN regexp_matches(key, '^raw/ais/aisdk-\\d+-\\d+-\\d+\\.zip$')
            THEN CAST(strptime(regexp_extract(key, 'aisdk-(\\d+-\\d+-\\d+)\\.zip', 1), '%Y-%m-%d') AS DATE) END AS zip_start,
       CASE WHEN regexp_matches(key, '^raw/ais/aisdk-\\d+-\\d+\\.zip$')
            THEN CAST(strptime(regexp_extract(key, 'aisdk-(\\d+-\\d+)\\.zip', 1) || '-01', '%Y-%m-%d') + INTERVAL '1' MONTH AS DATE)
            WHEN regexp_matches(key, '^raw/ais/aisdk-\\d+-\\d+-\\d+\\.zip$')
            THEN CAST(strptime(regexp_extract(key, 'aisdk-(\\d+-\\d+-\\d+)\\.zip', 1), '%Y-%m-%d') + INTERVAL '1' DAY AS DATE) END AS zip_end
FROM keys"""}))
def q_archive_filter(spark: SparkSession, d: str) -> DataFrame:
    return ar.filter_archives(archive_keys(spark, d), "2024-01-15", "2024-06-01", key_contains="aisdk")


MEMBERS_SQL = """SELECT 'aisdk-' || strftime(d, '%Y-%m-%d') || '.csv' AS member FROM archive_dates
UNION ALL SELECT DISTINCT 'aisdk-' || strftime(d, '%Y-%m') || '.csv' AS member FROM archive_dates"""


def members_df(spark: SparkSession, d: str) -> DataFrame:
    dates = fx.archive_dates(spark, d)
    daily = dates.select(F.concat(F.lit("aisdk-"), F.date_format("d", "yyyy-MM-dd"), F.lit(".csv")).alias("member"))
    monthly = dates.select(F.concat(F.lit("aisdk-"), F.date_format("d", "yyyy-MM"), F.lit(".csv")).alias("member")).distinct()
    return daily.unionByName(monthly)


@register("needed_members", with_views("""
SELECT member, CAST(strptime(substr(member, 7, 10), '%Y-%m-%d') AS DATE) AS member_date
FROM members WHERE length(member) = 20
  AND CAST(strptime(substr(member, 7, 10), '%Y-%m-%d') AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) FROM ais)""",
                                       "archive_dates", "ais", extra={"members": MEMBERS_SQL}))
def q_needed_members(spark: SparkSession, d: str) -> DataFrame:
    wanted = fx.ais(spark, d).select(F.to_date("ts").alias("date"))
    return ar.needed_members(members_df(spark, d), wanted)


@register("download_plan", with_views(f"""
SELECT DISTINCT {ZIP_SQL} AS zipname, {URL_SQL} AS url FROM archive_dates
WHERE {ZIP_SQL} NOT IN (SELECT {ZIP_SQL} FROM archive_dates
                        WHERE month(d) = 12 OR d BETWEEN DATE '2024-05-01' AND DATE '2024-05-15')""",
                                      "archive_dates"))
def q_download_plan(spark: SparkSession, d: str) -> DataFrame:
    dates = fx.archive_dates(spark, d)
    wanted = dates.withColumnRenamed("d", "date")
    stored = dates.where((F.month("d") == 12) | F.col("d").between(F.lit("2024-05-01").cast("date"),
                                                                   F.lit("2024-05-15").cast("date")))
    existing = ar.archive_plan(stored.withColumnRenamed("d", "date"), ARCHIVE_BASE).select("zipname")
    return ar.download_plan(wanted, existing, ARCHIVE_BASE)


# ------------------------------------------------------------------ A4
def raw_records(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events")
    k = F.col("event_id") % 5
    ts = F.col("ts")
    text = (F.when(k == 0, F.date_format(ts, "dd/MM/yyyy HH:mm:ss"))
            .when(k == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(k == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(k == 3, F.lit("   ")).otherwise(F.lit("not a time")))
    etype = F.when(F.col("event_id") % 11 == 0, F.lit("  ")).otherwise(F.col("event_type"))
    return e.select(F.col("event_id").alias("id"), text.alias("# Timestamp"), etype.alias("Name"),
                    F.col("value").alias("SOG"))


@register("clean_records", """
SELECT event_id AS id,
       CASE event_id % 5 WHEN 0 THEN CAST(strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS TIMESTAMP)
                         WHEN 1 THEN CAST(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)
                         WHEN 2 THEN CAST(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)
       END AS "# Timestamp",
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS "Name",
       value AS "SOG"
FROM events""")
def q_clean_records(spark: SparkSession, d: str) -> DataFrame:
    return rec.clean_records(raw_records(spark, d), time_cols=("# Timestamp",))


# ------------------------------------------------------------------ A5
def stac_pages(spark: SparkSession, d: str, keep_page: bool = False) -> DataFrame:
    """Scene-search result pages built from events: up to 100 features per page."""
    e = fx.table(spark, d, "events")
    eid = F.col("event_id")
    feat = F.struct(
        F.when(eid % 13 != 0, F.concat(F.lit("E"), eid.cast("string"))).alias("id"),
        F.struct(F.when(eid % 17 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("datetime"),
                 F.col("value").alias("eo:cloud_cover"), F.col("event_type").alias("platform"),
                 F.lit("sentinel-2").alias("constellation"),
                 (F.lit(32601) + F.col("user_id") % 60).cast("int").alias("proj:epsg")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array((eid % 90).cast("double"), (eid % 45).cast("double"))
                 .alias("coordinates")).alias("geometry"),
        F.array((eid % 90).cast("double"), (eid % 45).cast("double"),
                (eid % 90 + 1).cast("double"), (eid % 45 + 1).cast("double")).alias("bbox"))
    return (e.select((eid / 100).cast("bigint").alias("page"), eid.alias("n"), feat.alias("f"))
            # a page is an answer of at most 100 features, in the order of their ids
            .groupBy("page").agg(F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct("n", "f"))), lambda x: x["f"]).alias("features"))).alias("json"))
            .select(*(["page"] if keep_page else []), "json"))


@register("flatten_json", """
SELECT 'E' || event_id AS api_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS datetime, value AS cloud_cover,
       event_type AS platform, 'sentinel-2' AS constellation, CAST(32601 + user_id % 60 AS INTEGER) AS proj_epsg,
       '{"type":"Point","coordinates":[' || CAST(CAST(event_id % 90 AS DOUBLE) AS VARCHAR) || ','
           || CAST(CAST(event_id % 45 AS DOUBLE) AS VARCHAR) || ']}' AS geom_geojson,
       '[' || CAST(CAST(event_id % 90 AS DOUBLE) AS VARCHAR) || ', ' || CAST(CAST(event_id % 45 AS DOUBLE) AS VARCHAR)
           || ', ' || CAST(CAST(event_id % 90 + 1 AS DOUBLE) AS VARCHAR) || ', '
           || CAST(CAST(event_id % 45 + 1 AS DOUBLE) AS VARCHAR) || ']' AS bbox
FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0""")
def q_flatten_json(spark: SparkSession, d: str) -> DataFrame:
    return rec.flatten_stac(stac_pages(spark, d))


def damaged_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages of ``stac_pages``, some cut off, some an error message, and some features with a time that is none."""
    p, k = stac_pages(spark, d, keep_page=True), F.col("page")
    text = F.when(k % 7 == 3, F.expr("substring(json, 1, 120)")).when(k % 11 == 5, F.lit('{"message": "busy"}')).otherwise(
        F.regexp_replace("json", "T(\\d\\d):(\\d\\d):13Z", "T$1:$2:73Z"))
    return p.select("page", text.alias("json"))


PAGED = """SELECT event_id // 100 AS page, event_id % 13 <> 0 AS named, event_id % 17 <> 0 AS timed, date_trunc('second', ts) AS secs, second(ts) = 13 AS odd,
       row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS feature, * FROM events"""


@register("stac_features", """
SELECT 'E' || event_id AS api_id, secs AS datetime, value AS cloud_cover, event_type AS platform, 'sentinel-2' AS constellation,
       CAST(32601 + user_id % 60 AS INTEGER) AS proj_epsg,
       '[' || CAST(CAST(event_id % 90 AS DOUBLE) AS VARCHAR) || ', ' || CAST(CAST(event_id % 45 AS DOUBLE) AS VARCHAR)
           || ', ' || CAST(CAST(event_id % 90 + 1 AS DOUBLE) AS VARCHAR) || ', ' || CAST(CAST(event_id % 45 + 1 AS DOUBLE) AS VARCHAR) || ']' AS bbox,
       CAST(event_id % 90 AS DOUBLE) AS x, CAST(event_id % 45 AS DOUBLE) AS y
FROM (""" + PAGED + """) e WHERE named AND timed AND NOT odd AND page % 7 <> 3 AND page % 11 <> 5""")
def q_stac_features(spark: SparkSession, d: str) -> DataFrame:
    features, _ = rec.read_stac(damaged_pages(spark, d))
    xy = F.from_json("geom_geojson", "coordinates array<double>")["coordinates"]
    return features.withColumn("datetime", utc_ntz("datetime")).select("*", xy[0].alias("x"), xy[1].alias("y")).drop("geom_geojson")


@register("stac_rejects", """
SELECT page, CAST(NULL AS INTEGER) AS feature, CASE WHEN page % 7 = 3 THEN 'no JSON' ELSE 'no features' END AS reason
FROM (SELECT DISTINCT event_id // 100 AS page FROM events) p WHERE page % 7 = 3 OR page % 11 = 5
UNION ALL
SELECT page, CAST(feature AS INTEGER), 'bad datetime' FROM (""" + PAGED + """) e WHERE timed AND odd AND page % 7 <> 3 AND page % 11 <> 5""")
def q_stac_rejects(spark: SparkSession, d: str) -> DataFrame:
    return rec.read_stac(damaged_pages(spark, d))[1]


@register("stac_props", """
SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
WHERE json_extract(props, '$.k') IS NOT NULL""")
def q_stac_props(spark: SparkSession, d: str) -> DataFrame:
    """A5 on a flat property bag (``events.props``), missing key -> dropped."""
    e = fx.table(spark, d, "events")
    return (e.select(F.col("event_id").alias("id"),
                     F.from_json("props", "k BIGINT")["k"].alias("k"))
            .dropna(subset=["k"]))


@register("unique_keys", with_views("""
SELECT mmsi, date_trunc('hour', ts) AS hour, count(*) AS n FROM ais GROUP BY 1, 2 HAVING count(*) > 1""", "ais"))
def q_unique_keys(spark: SparkSession, d: str) -> DataFrame:
    a = fx.ais(spark, d).select("mmsi", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    return rec.duplicate_keys(a, ["mmsi", "hour"])
