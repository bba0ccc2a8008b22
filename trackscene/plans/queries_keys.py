"""Registered queries: object keys, patch names, buckets, labels, manifests
(A8, A11, B8, B12-B17, E9, G6, H1, K2, K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import TAXONOMIES, join_key, label_from_path, patch_name, ship_type_from_key, slug
from ..operators import manifests as mf
from ..operators import match
from .fixtures import with_views
from .queries_match import CLOSEST_COLS, matched, predicted
from .registry import register


def closest_df(spark: SparkSession, d: str) -> DataFrame:
    return match.closest_fixes(matched(spark, d), columns=CLOSEST_COLS)


def object_keys(spark: SparkSession, d: str) -> DataFrame:
    """FIXTURES object_keys: ``raw/<api_id>/<type>_<mmsi>_<id % 20>.tif``."""
    c = closest_df(spark, d)
    return c.select(F.concat(F.lit("raw/"), F.col("api_id"), F.lit("/"), F.coalesce("ship_type", F.lit("NA")),
                             F.lit("_"), F.col("mmsi").cast("string"), F.lit("_"),
                             (F.col("id") % 20).cast("string"), F.lit(".tif")).alias("key"),
                    "api_id", "mmsi", "id").groupBy("key").agg(
        F.min("api_id").alias("api_id"), F.min("mmsi").alias("mmsi"), F.min("id").alias("id"))


OBJECT_KEYS_SQL = """SELECT key, min(api_id) AS api_id, min(mmsi) AS mmsi, min(id) AS id FROM (
  SELECT concat('raw/', api_id, '/', coalesce(ship_type,'NA'), '_', mmsi, '_', id % 20, '.tif') AS key, api_id, mmsi, id
  FROM closest) t GROUP BY key"""
# second key layout: type folder first, a basename without a usable type token
ALT_KEYS_SQL = """SELECT concat('raw/', coalesce(ship_type, '123'), '/', api_id, '/', mmsi, '_', id % 20, '.tif') AS key
FROM closest"""

PLAUSIBLE = "'^[A-Za-z][A-Za-z _-]*$'"
SHIP_TYPE_SQL = f"""coalesce(
  CASE WHEN contains(regexp_extract(key, '[^/]*$'), '_')
        AND regexp_matches(split_part(regexp_extract(key, '[^/]*$'), '_', 1), {PLAUSIBLE})
       THEN split_part(regexp_extract(key, '[^/]*$'), '_', 1) END,
  list_filter(list_filter(string_split(CASE WHEN starts_with(key, 'raw/') THEN substr(key, 5) ELSE key END, '/'),
                          lambda s: s <> '')[1:2], lambda s: regexp_matches(s, {PLAUSIBLE}))[1],
  'unclassified')"""


def all_keys(spark: SparkSession, d: str) -> DataFrame:
    c = closest_df(spark, d)
    alt = c.select(F.concat(F.lit("raw/"), F.coalesce("ship_type", F.lit("123")), F.lit("/"), F.col("api_id"),
                            F.lit("/"), F.col("mmsi").cast("string"), F.lit("_"),
                            (F.col("id") % 20).cast("string"), F.lit(".tif")).alias("key"))
    return object_keys(spark, d).select("key").unionByName(alt)


@register("ship_type_from_key", with_views(f"""
SELECT key, {SHIP_TYPE_SQL} AS ship_type FROM (
  SELECT key FROM ok UNION ALL SELECT key FROM alt) t""", "closest",
                                           extra={"ok": OBJECT_KEYS_SQL, "alt": ALT_KEYS_SQL}))
def q_ship_type_from_key(spark: SparkSession, d: str) -> DataFrame:
    k = all_keys(spark, d)
    return k.select("key", ship_type_from_key(F.col("key"), "raw/").alias("ship_type"))


def _slug_sql(expr: str) -> str:
    t = f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"
    t = f"regexp_replace({t}, '\\s+', '_', 'g')"
    t = f"regexp_replace({t}, '[^A-Za-z0-9_\\-]', '', 'g')"
    return f"coalesce(nullif({t}, ''), 'NA')"


MESSY_SQL = "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN ' ' || ship_type || '  ship #' || (mmsi % 3) || ' ' ELSE ship_type END"


@register("slug_keys", with_views(f"""
SELECT id,
       {_slug_sql(MESSY_SQL)} AS type_slug,
       'patches/' || api_id || '/' || {_slug_sql(MESSY_SQL)} || '_' || {_slug_sql('CAST(mmsi AS VARCHAR)')} || '_' || id || '.tif' AS key,
       'patches/' || api_id || '/' || {_slug_sql(MESSY_SQL)} || '_' || {_slug_sql('CAST(mmsi AS VARCHAR)')} || '_' || id || '_TCI.tif' AS tci_key
FROM predicted""", "predicted"))
def q_slug_keys(spark: SparkSession, d: str) -> DataFrame:
    p = predicted(spark, d)
    messy = (F.when(F.col("id") % 4 == 0, F.lit(None).cast("string"))
             .when(F.col("id") % 4 == 1, F.concat(F.lit(" "), F.col("ship_type"), F.lit("  ship #"),
                                                  (F.col("mmsi") % 3).cast("string"), F.lit(" ")))
             .otherwise(F.col("ship_type")))
    return p.select("id", slug(messy).alias("type_slug"),
                    join_key(F.lit("patches"), F.col("api_id"), patch_name(messy, F.col("mmsi"), F.col("id"))).alias("key"),
                    join_key(F.lit("patches"), F.col("api_id"),
                             patch_name(messy, F.col("mmsi"), F.col("id"), tci=True)).alias("tci_key"))


def _strip_sql(e: str) -> str:
    return f"regexp_replace({e}, '^/+|/+$', '', 'g')"


@register("join_keys", with_views(f"""
SELECT id,
  CASE WHEN {_strip_sql("pre")} <> '' AND sfx <> '' THEN {_strip_sql("pre")} || '/' || sfx
       WHEN {_strip_sql("pre")} <> '' THEN {_strip_sql("pre")} ELSE sfx END AS key
FROM (SELECT id, pre, concat_ws('/', CASE WHEN coalesce(p1, '') <> '' THEN {_strip_sql("p1")} END,
                                     CASE WHEN coalesce(p2, '') <> '' THEN {_strip_sql("p2")} END,
                                     CASE WHEN coalesce(p3, '') <> '' THEN {_strip_sql("p3")} END) AS sfx
      FROM (SELECT id,
                   CASE id % 3 WHEN 0 THEN '/patches/' WHEN 1 THEN '' ELSE 'out//' END AS pre,
                   CASE WHEN id % 5 = 0 THEN '' ELSE '/' || api_id || '/' END AS p1,
                   CASE WHEN id % 7 = 0 THEN '/' ELSE ship_type END AS p2,
                   mmsi || '.tif' AS p3
            FROM predicted) t) u""", "predicted"))
def q_join_keys(spark: SparkSession, d: str) -> DataFrame:
    p = predicted(spark, d)
    i = F.col("id")
    pre = F.when(i % 3 == 0, "/patches/").when(i % 3 == 1, "").otherwise("out//")
    p1 = F.when(i % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("/"), F.col("api_id"), F.lit("/")))
    p2 = F.when(i % 7 == 0, F.lit("/")).otherwise(F.col("ship_type"))
    p3 = F.concat(F.col("mmsi").cast("string"), F.lit(".tif"))
    return p.select("id", join_key(pre, p1, p2, p3).alias("key"))


REBUCKET_SQL = f"""SELECT dest_key, arg_min(key, key) AS src_key, arg_min(ship_type, key) AS ship_type FROM (
  SELECT key, {SHIP_TYPE_SQL} AS ship_type,
         'by-type/' || {SHIP_TYPE_SQL} || '/' || regexp_extract(key, '[^/]*$') AS dest_key
  FROM ok) t GROUP BY dest_key"""


@register("rebucket", with_views("""
SELECT * FROM rb WHERE dest_key NOT IN (SELECT dest_key FROM rb0)""", "closest",
                                 extra={"ok": OBJECT_KEYS_SQL, "rb": REBUCKET_SQL,
                                        "rb0": REBUCKET_SQL.replace("FROM ok)", "FROM ok WHERE api_id = 'S2_3')")}))
def q_rebucket(spark: SparkSession, d: str) -> DataFrame:
    keys = object_keys(spark, d)
    existing = mf.rebucket(keys.where(F.col("api_id") == "S2_3"), "raw/", "by-type/").select("dest_key")
    return mf.rebucket(keys, "raw/", "by-type/", existing=existing)


IMAGE_KEYS_SQL = f"""SELECT 'images/' || {SHIP_TYPE_SQL} || '/' || api_id || '/' || regexp_extract(key, '[^/]*$') AS key
FROM ok WHERE id % 20 <> 7
UNION ALL
SELECT 'images/' || {SHIP_TYPE_SQL} || '/' || api_id || '/'
       || replace(regexp_extract(key, '[^/]*$'), '.tif', CASE WHEN id % 20 = 3 THEN '_TCI.TIF' ELSE '_TCI.tif' END) AS key
FROM ok WHERE id % 20 < 10"""


def image_keys(spark: SparkSession, d: str) -> DataFrame:
    ok = object_keys(spark, d)
    st = ship_type_from_key(F.col("key"), "raw/")
    base = F.element_at(F.split("key", "/"), -1)
    folder = F.concat(F.lit("images/"), st, F.lit("/"), F.col("api_id"), F.lit("/"))
    merged = ok.where(F.col("id") % 20 != 7).select(F.concat(folder, base).alias("key"))
    tci = ok.where(F.col("id") % 20 < 10).select(F.concat(folder, F.replace(
        base, F.lit(".tif"), F.when(F.col("id") % 20 == 3, F.lit("_TCI.TIF")).otherwise(F.lit("_TCI.tif")))).alias("key"))
    return merged.unionByName(tci)


PAIR_S_SQL = """SELECT key, split_part(substr(key, 8), '/', 1) AS class,
       regexp_matches(regexp_extract(key, '[^/]*$'), '(?i)_TCI\\.tiff?$') AS is_tci,
       split_part(substr(key, 8), '/', 1) || '/' ||
         CASE WHEN regexp_matches(regexp_extract(key, '[^/]*$'), '(?i)_TCI\\.tiff?$')
               AND (ends_with(key, '_TCI.tif') OR ends_with(key, '_TCI.TIF'))
              THEN left(regexp_extract(key, '[^/]*$'), length(regexp_extract(key, '[^/]*$')) - 8) || '.tif'
              ELSE regexp_extract(key, '[^/]*$') END AS base_key
FROM ik WHERE len(string_split(substr(key, 8), '/')) >= 2"""


@register("pair_images", with_views("""
SELECT m.class, m.base_key, m.merged_key, t.tci_key FROM m LEFT JOIN t ON m.base_key = t.base_key""",
                                    "closest", extra={
                                        "ok": OBJECT_KEYS_SQL, "ik": IMAGE_KEYS_SQL, "s": PAIR_S_SQL,
                                        "m": "SELECT base_key, max(key) AS merged_key, max(class) AS class FROM s WHERE NOT is_tci GROUP BY base_key",
                                        "t": "SELECT base_key, max(key) AS tci_key FROM s WHERE is_tci GROUP BY base_key"}))
def q_pair_images(spark: SparkSession, d: str) -> DataFrame:
    return mf.pair_images(image_keys(spark, d), "images/")


# ------------------------------------------------------------------ B13 / K3
DATASET_KEYS_SQL = f"""SELECT 'dataset/' || CASE WHEN id % 9 = 0 THEN 'misc/' || {SHIP_TYPE_SQL} || '_dir'
                                   WHEN id % 9 = 1 THEN 'CargoTanker' ELSE {SHIP_TYPE_SQL} END
       || '/' || regexp_extract(key, '[^/]*$') AS key
FROM ok"""


def dataset_keys(spark: SparkSession, d: str) -> DataFrame:
    ok = object_keys(spark, d)
    st = ship_type_from_key(F.col("key"), "raw/")
    folder = (F.when(F.col("id") % 9 == 0, F.concat(F.lit("misc/"), st, F.lit("_dir")))
              .when(F.col("id") % 9 == 1, F.lit("CargoTanker")).otherwise(st))
    return ok.select(F.concat(F.lit("dataset/"), folder, F.lit("/"), F.element_at(F.split("key", "/"), -1)).alias("key"))


def _label_sql(tax: dict) -> str:
    parts = "string_split(replace(key, '\\', '/'), '/')"
    whens = []
    for target, names in tax["aliases"]:
        lst = "[" + ", ".join(f"'{n}'" for n in names) + "]"
        whens.append(f"WHEN list_has_any({parts}, {lst}) THEN '{target}'")
    for c in tax["classes"]:
        whens.append(f"WHEN list_contains({parts}, '{c}') THEN '{c}'")
    parent = f"CASE WHEN len({parts}) >= 2 THEN {parts}[-2] END"
    fb = parent
    if tax["aliases"]:
        fbw = " ".join(f"WHEN {parent} IN ({', '.join(repr(n) for n in names)}) THEN '{target}'"
                       for target, names in tax["aliases"])
        fb = f"CASE {fbw} ELSE {parent} END"
    return f"CASE {' '.join(whens)} ELSE {fb} END"


def _register_labels(n: int) -> None:
    @register(f"labels_{n}", with_views(f"SELECT key, {_label_sql(TAXONOMIES[n])} AS label FROM dk", "closest",
                                         extra={"ok": OBJECT_KEYS_SQL, "dk": DATASET_KEYS_SQL}))
    def q(spark: SparkSession, d: str) -> DataFrame:
        return dataset_keys(spark, d).select("key", label_from_path(F.col("key"), n).alias("label"))


for _n in (4, 5, 6):
    _register_labels(_n)


LISTING_SQL = f"""SELECT key FROM dk
UNION ALL SELECT replace(key, '.tif', '_TCI.tif') FROM dk
UNION ALL SELECT replace(key, '.tif', '.json') FROM dk
UNION ALL SELECT 'dataset/.hidden/' || regexp_extract(key, '[^/]*$') FROM dk
UNION ALL SELECT 'dataset/.ipynb_checkpoints/Cargo/' || regexp_extract(key, '[^/]*$') FROM dk
UNION ALL SELECT replace(key, '.tif', '.TIFF') FROM dk
UNION ALL SELECT DISTINCT regexp_replace(key, '[^/]*$', '') FROM dk"""


def listing(spark: SparkSession, d: str) -> DataFrame:
    dk = dataset_keys(spark, d)
    k = F.col("key")
    base = F.element_at(F.split(k, "/"), -1)
    parts = [dk,
             dk.select(F.replace(k, F.lit(".tif"), F.lit("_TCI.tif")).alias("key")),
             dk.select(F.replace(k, F.lit(".tif"), F.lit(".json")).alias("key")),
             dk.select(F.concat(F.lit("dataset/.hidden/"), base).alias("key")),
             dk.select(F.concat(F.lit("dataset/.ipynb_checkpoints/Cargo/"), base).alias("key")),
             dk.select(F.replace(k, F.lit(".tif"), F.lit(".TIFF")).alias("key")),
             dk.select(F.regexp_replace(k, "[^/]*$", "").alias("key")).distinct()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("training_manifest", with_views(f"""
SELECT key, label, CAST(list_position(['CargoTanker', 'Fishing', 'Passenger', 'Leisure'], label) - 1 AS BIGINT) AS label_idx
FROM (SELECT key, {_label_sql(TAXONOMIES[4])} AS label
      FROM lst
      WHERE NOT ends_with(key, '/') AND NOT contains(key, '/.') AND NOT contains(key, '.ipynb_checkpoints')
        AND NOT contains(lower(regexp_extract(key, '[^/]*$')), 'tci')
        AND (ends_with(lower(key), '.tif') OR ends_with(lower(key), '.tiff'))) t
WHERE list_position(['CargoTanker', 'Fishing', 'Passenger', 'Leisure'], label) IS NOT NULL""",
                                          "closest", extra={"ok": OBJECT_KEYS_SQL, "dk": DATASET_KEYS_SQL,
                                                            "lst": LISTING_SQL}))
def q_training_manifest(spark: SparkSession, d: str) -> DataFrame:
    return mf.training_manifest(listing(spark, d), 4)
