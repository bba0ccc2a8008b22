"""Registered queries: sampling, folds, class statistics, patch quality,
normalisation and evaluation (F4-F16, G3-G5, I1, J8, K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import TAXONOMIES
from ..operators import evaluate as ev
from ..operators import folds as fo
from ..operators import quality as qa
from ..operators import raster as ra
from . import fixtures as fx
from .fixtures import with_views
from .queries_match import predicted
from .registry import register

K = 10
SEED = 42
N_CLASSES = 6
CLASS_NAMES = TAXONOMIES[6]["classes"]


# ------------------------------------------------------------------ fixtures over `embeddings`
def patches(spark: SparkSession, d: str) -> DataFrame:
    """4 bands x 4x4 pixels per embedding: pixel(b, i) = embedding[16 b + i] + 0.6; class = label % 6."""
    e = fx.table(spark, d, "embeddings")
    bands = F.transform(F.sequence(F.lit(0), F.lit(3)),
                        lambda b: F.transform(F.slice("embedding", b * 16 + 1, F.lit(16)),
                                              lambda x: x.cast("double") + F.lit(0.6)))
    return e.select("vec_id", (F.col("label") % 6).alias("cls"), bands.alias("bands"))


def tci_patches(spark: SparkSession, d: str) -> DataFrame:
    """Companion RGB: first three bands times 1, 200 or 1000 (vec_id % 3) to exercise the value scaling."""
    p = patches(spark, d)
    s = F.when(F.col("vec_id") % 3 == 0, F.lit(1.0)).when(F.col("vec_id") % 3 == 1, F.lit(200.0)).otherwise(F.lit(1000.0))
    return p.select("vec_id", "cls", F.transform(F.slice("bands", 1, 3), lambda b: F.transform(b, lambda x: x * s))
                    .alias("bands"))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "embeddings")
    scores = F.slice("embedding", 1, 6)
    return e.select("vec_id", (F.col("label") % 6).cast("bigint").alias("y_true"),
                    ev.argmax_first(scores).alias("y_pred"), scores.alias("scores"))


def folds_df(spark: SparkSession, d: str) -> DataFrame:
    return fo.stratified_folds(patches(spark, d), K, SEED, class_col="cls", key="vec_id")


PT_SQL = """SELECT vec_id, label % 6 AS cls,
  [list_transform(embedding[1:16], lambda x: CAST(x AS DOUBLE) + 0.6e0),
   list_transform(embedding[17:32], lambda x: CAST(x AS DOUBLE) + 0.6e0),
   list_transform(embedding[33:48], lambda x: CAST(x AS DOUBLE) + 0.6e0),
   list_transform(embedding[49:64], lambda x: CAST(x AS DOUBLE) + 0.6e0)] AS bands
FROM embeddings"""
FOLDS_SQL = f"""SELECT *, CAST((row_number() OVER (ORDER BY cls, md5(CAST(vec_id AS VARCHAR) || ':{SEED}')) - 1) % {K} AS BIGINT) AS fold
FROM pt"""
PRED_SQL = """SELECT vec_id, CAST(label % 6 AS BIGINT) AS y_true,
       CAST(list_position(embedding[1:6], list_max(embedding[1:6])) - 1 AS BIGINT) AS y_pred, embedding[1:6] AS scores
FROM embeddings"""
VIEWS = {"pt": PT_SQL, "folds": FOLDS_SQL, "pred": PRED_SQL}


def views(*names: str, extra: dict | None = None) -> dict:
    out = {n: VIEWS[n] for n in ("pt", "folds", "pred") if n in names}
    out.update(extra or {})
    return out


# ------------------------------------------------------------------ G3 / G4 / G5 / I1 / F4 / F5
@register("limit_per_scene", with_views("""
SELECT id, mmsi, ship_type, length, api_id, sensing_time, lon, lat FROM (
  SELECT *, row_number() OVER (PARTITION BY api_id ORDER BY id) AS rn FROM predicted) t WHERE rn <= 5""", "predicted"))
def q_limit_per_scene(spark: SparkSession, d: str) -> DataFrame:
    return fo.limit_per_scene(predicted(spark, d), 5)


@register("sample_per_class", with_views("""
SELECT vec_id, cls FROM (
  SELECT vec_id, cls, row_number() OVER (PARTITION BY cls ORDER BY md5(CAST(vec_id AS VARCHAR) || ':7'), vec_id) AS rn
  FROM pt) t WHERE rn <= 30""", extra=views("pt")))
def q_sample_per_class(spark: SparkSession, d: str) -> DataFrame:
    return fo.sample_per_class(patches(spark, d), 30, 7, class_col="cls", key="vec_id").select("vec_id", "cls")


@register("stratified_folds", with_views("SELECT vec_id, cls, fold FROM folds", extra=views("pt", "folds")))
def q_stratified_folds(spark: SparkSession, d: str) -> DataFrame:
    return folds_df(spark, d).select("vec_id", "cls", "fold")


@register("train_rows", with_views(f"SELECT vec_id, cls, fold FROM folds WHERE fold NOT IN (0, 1)",
                                   extra=views("pt", "folds")))
def q_train_rows(spark: SparkSession, d: str) -> DataFrame:
    return fo.train_rows(folds_df(spark, d), 0, K, key="vec_id").select("vec_id", "cls", "fold")


@register("class_counts", with_views("SELECT cls, count(*) AS n FROM pt GROUP BY cls", extra=views("pt")))
def q_class_counts(spark: SparkSession, d: str) -> DataFrame:
    return fo.class_counts(patches(spark, d), "cls")


@register("class_weights", with_views("""
SELECT c.range AS cls, CAST((SELECT count(*) FROM folds WHERE fold NOT IN (0, 1)) AS DOUBLE)
         / greatest(1, coalesce(n.n, 1)) AS weight
FROM range(6) c LEFT JOIN (SELECT cls, count(*) AS n FROM folds WHERE fold NOT IN (0, 1) GROUP BY cls) n
  ON c.range = n.cls""", extra=views("pt", "folds")))
def q_class_weights(spark: SparkSession, d: str) -> DataFrame:
    train = fo.train_rows(folds_df(spark, d), 0, K, key="vec_id")
    return fo.class_weights(train, N_CLASSES, "cls")


@register("class_weights_all_folds", with_views(f"""
SELECT r.range AS round, c.range AS cls,
       CAST((SELECT count(*) FROM folds WHERE fold NOT IN (r.range, (r.range + 1) % {K})) AS DOUBLE) / greatest(1, coalesce(n.n, 1)) AS weight
FROM range({K}) r CROSS JOIN range({N_CLASSES}) c
LEFT JOIN (SELECT r.range AS round, cls, count(*) AS n FROM range({K}) r JOIN folds ON fold NOT IN (r.range, (r.range + 1) % {K}) GROUP BY ALL) n
  ON n.round = r.range AND n.cls = c.range""", extra=views("pt", "folds")))
def q_class_weights_all_folds(spark: SparkSession, d: str) -> DataFrame:
    return fo.class_weights_all_folds(folds_df(spark, d), K, N_CLASSES, "cls")


# ------------------------------------------------------------------ J6 / J7 / J9 over embeddings
@register("resize_nearest", """
SELECT vec_id, [round(embedding[1 + (k // 49) * 16 + ((k % 49) // 7 * 4 // 7) * 4 + (k % 7) * 4 // 7]::DOUBLE, 6) FOR k IN range(98)] AS pixels
FROM embeddings""")
def q_resize_nearest(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, 32).cast("array<double>").alias("px"))
    r = e.select("vec_id", ra.resize_nearest("px", 2, 4, 4, 7).alias("px"))
    return r.select("vec_id", F.transform("px", lambda x: F.round(x, 6)).alias("pixels"))


@register("to_chw", """
SELECT vec_id, [round(greatest(embedding[1 + (k % 16) * 4 + k // 16], 0)::DOUBLE, 5) FOR k IN range(64)] AS pixels FROM embeddings""")
def q_to_chw(spark: SparkSession, d: str) -> DataFrame:
    """Images of 4 x 4 pixels, channels last, to channels first."""
    e = fx.table(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, 64).alias("px"), F.lit(4).alias("h"), F.lit(4).alias("w"), F.lit(4).alias("c"))
    # three equal axes would be ambiguous: the grid is read as 16 x 1 pixels
    c = ra.to_chw(e.withColumns({"h": F.lit(16), "w": F.lit(1)}), "px", ("h", "w", "c"), 4)
    return c.select("vec_id", F.transform("chw", lambda x: F.round(x.cast("double"), 5)).alias("pixels"))


# ------------------------------------------------------------------ F6 / J8 / F7 / F8 / F9
STATS_SQL = f"""SELECT band, round(q[1], 6) AS low, round(CASE WHEN q[2] <= q[1] THEN q[1] + 1e-3 ELSE q[2] END, 6) AS high
FROM (SELECT CAST(b - 1 AS BIGINT) AS band, quantile_cont(v, [0.02, 0.98]) AS q
      FROM (SELECT generate_subscripts(bands, 1) AS b, unnest(bands) AS px FROM sampled) t,
           unnest(px) AS u(v)
      GROUP BY b) s"""
SAMPLED_SQL = "SELECT * FROM folds WHERE fold NOT IN (0, 1)"  # every training row: a histogram needs no sample


def stats_df(spark: SparkSession, d: str) -> DataFrame:
    return qa.percentile_stats(fo.train_rows(folds_df(spark, d), 0, K, key="vec_id"))


@register("percentile_stats", with_views("SELECT * FROM stats",
                                         extra=views("pt", "folds", extra={"sampled": SAMPLED_SQL,
                                                                           "stats": STATS_SQL})))
def q_percentile_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats_df(spark, d)


@register("percentile_stats_all_folds", with_views(f"""
SELECT round, band, round(q[1], 6) AS low, round(CASE WHEN q[2] <= q[1] THEN q[1] + 1e-3 ELSE q[2] END, 6) AS high
FROM (SELECT round, CAST(b - 1 AS BIGINT) AS band, quantile_cont(v, [0.02, 0.98]) AS q
      FROM (SELECT round, generate_subscripts(bands, 1) AS b, unnest(bands) AS px
            FROM (SELECT r.range AS round, f.bands FROM range({K}) r JOIN folds f ON f.fold NOT IN (r.range, (r.range + 1) % {K})) x) t,
           unnest(px) AS u(v)
      GROUP BY round, b) s""", extra=views("pt", "folds")))
def q_percentile_stats_all_folds(spark: SparkSession, d: str) -> DataFrame:
    return qa.percentile_stats_all_folds(folds_df(spark, d), K)


def _round_list_sql(e: str) -> str:
    return f"list_transform({e}, lambda x: round(x, 6))"


@register("normalize_patches", with_views(f"""
SELECT p.vec_id, p.cls, CAST(p.b - 1 AS BIGINT) AS band,
       {_round_list_sql("list_transform(p.px, lambda x: (least(s.high, greatest(s.low, x)) - s.low) / greatest(s.high - s.low, 1e-6))")} AS pixels
FROM (SELECT vec_id, cls, generate_subscripts(bands, 1) AS b, unnest(bands) AS px FROM pt) p
JOIN stats s ON s.band = p.b - 1""", extra=views("pt", "folds", extra={"sampled": SAMPLED_SQL, "stats": STATS_SQL})))
def q_normalize_patches(spark: SparkSession, d: str) -> DataFrame:
    n = qa.normalize_bands(patches(spark, d), stats_df(spark, d))
    return n.select("vec_id", "cls", "band", F.transform("pixels", lambda x: F.round(x, 6)).alias("pixels"))


def _quant_sql(lst: str, q: float) -> str:
    s = f"list_sort({lst})"
    pos = f"((len({lst}) - 1) * {q}e0)"
    i = f"CAST(floor({pos}) AS BIGINT)"
    return (f"({s}[{i} + 1] + ({s}[least({i} + 2, len({lst}))] - {s}[{i} + 1]) * ({pos} - {i}))")


def _scale_sql(px: str) -> str:
    """F7 in DuckDB; the caller provides ``lo``, ``hi``, ``mn``, ``mx`` for the band."""
    return (f"CASE WHEN hi <= lo THEN (CASE WHEN mx <= mn THEN list_transform({px}, lambda x: 0e0) "
            f"ELSE list_transform({px}, lambda x: (x - mn) / (mx - mn + 1e-6)) END) "
            f"ELSE list_transform({px}, lambda x: least(1e0, greatest(0e0, (x - lo) / (hi - lo + 1e-6)))) END")


# one row per (patch, band) with the band statistics computed once
BAND_STATS_SQL = f"""SELECT vec_id, cls, b, px, {_quant_sql("px", 0.02)} AS lo, {_quant_sql("px", 0.98)} AS hi,
       list_min(px) AS mn, list_max(px) AS mx
FROM (SELECT vec_id, cls, generate_subscripts(bands, 1) AS b, unnest(bands) AS px FROM pt) t"""


@register("percentile_scale", with_views(f"""
SELECT vec_id, CAST(b - 1 AS BIGINT) AS band, {_round_list_sql(_scale_sql("px"))} AS pixels
FROM bs""", extra=views("pt", extra={"bs": BAND_STATS_SQL})))
def q_percentile_scale(spark: SparkSession, d: str) -> DataFrame:
    p = qa.with_percentile_scale(patches(spark, d)).select("vec_id", F.posexplode("scaled").alias("band", "pixels"))
    return p.select("vec_id", F.col("band").cast("bigint").alias("band"),
                    F.transform("pixels", lambda x: F.round(x, 6)).alias("pixels"))


TCI_SQL = """SELECT vec_id, cls, list_transform(bands[1:3], lambda b: list_transform(b, lambda x: x *
        CASE vec_id % 3 WHEN 0 THEN 1e0 WHEN 1 THEN 200e0 ELSE 1000e0 END)) AS bands FROM pt"""
RGB_RATIO_SQL = """SELECT vec_id, cls,
  CAST(len(list_filter(list_transform(range(1, 17), lambda i:
        0.2126e0 * (bands[1][i] / sc) + 0.7152e0 * (bands[2][i] / sc) + 0.0722e0 * (bands[3][i] / sc)),
        lambda v: v > 0.8e0)) AS DOUBLE) / 16 AS ratio
FROM (SELECT vec_id, cls, bands,
             CASE WHEN mx > 1 THEN (CASE WHEN mx <= 255 THEN 255e0 ELSE mx END) ELSE 1e0 END AS sc
      FROM (SELECT *, list_max(list_transform(bands, lambda b: list_max(b))) AS mx FROM tci) a) b"""


@register("cloud_rgb", with_views("SELECT vec_id, ratio FROM rr", extra=views("pt", extra={"tci": TCI_SQL,
                                                                                         "rr": RGB_RATIO_SQL})))
def q_cloud_rgb(spark: SparkSession, d: str) -> DataFrame:
    return qa.with_cloud_ratio_rgb(tci_patches(spark, d)).select("vec_id", "ratio")


SCALED_SQL = f"""SELECT vec_id, cls, list(sb ORDER BY b) AS s
FROM (SELECT vec_id, cls, b, {_scale_sql("px")} AS sb FROM bs) t GROUP BY vec_id, cls"""
MB_RATIO_SQL = """SELECT vec_id, cls,
  CAST(len(list_filter(range(1, 17), lambda i:
        (s[1][i] + s[2][i] + s[3][i]) / 3e0 > 0.75e0 AND s[4][i] > 0.65e0
        AND (s[4][i] - s[3][i]) / (s[4][i] + s[3][i] + 1e-6) < 0.25e0)) AS DOUBLE) / 16 AS ratio
FROM scaled"""


@register("cloud_multiband", with_views("SELECT vec_id, ratio FROM mr",
                                        extra=views("pt", extra={"bs": BAND_STATS_SQL, "scaled": SCALED_SQL,
                                                                 "mr": MB_RATIO_SQL})))
def q_cloud_multiband(spark: SparkSession, d: str) -> DataFrame:
    return qa.with_cloud_ratio_multiband(patches(spark, d)).select("vec_id", "ratio")


CLASS_NAME_SQL = "['" + "', '".join(CLASS_NAMES) + "'][cls + 1]"


def _report(spark: SparkSession, d: str, read=None, **options) -> DataFrame:
    """The cloud report over all listed images; ``read`` says which of them have pixels."""
    from ..operators import manifests as mf
    p = patches(spark, d)
    names = F.element_at(F.array(*[F.lit(c) for c in CLASS_NAMES]), (F.col("cls") + 1).cast("int"))
    merged_keys = p.select(F.concat(F.lit("images/"), names, F.lit("/"), F.col("vec_id").cast("string"),
                                    F.lit(".tif")).alias("key"), "bands", "vec_id")
    t = tci_patches(spark, d).where(F.col("vec_id") % 2 == 0)
    tci_keys = t.select(F.concat(F.lit("images/"), names, F.lit("/"), F.col("vec_id").cast("string"),
                                 F.lit("_TCI.tif")).alias("key"), "bands", "vec_id")
    listing = merged_keys.select("key").unionByName(tci_keys.select("key"))
    pairs = mf.pair_images(listing, "images/")
    merged, tci = (x if read is None else x.where(read) for x in (merged_keys, tci_keys))
    return qa.cloud_report(pairs, merged, tci, "images/", "cloudy_images/", **options)


REPORT_SQL = f"""SELECT {CLASS_NAME_SQL} AS class,
       'images/' || {CLASS_NAME_SQL} || '/' || vec_id || '.tif' AS merged_key,
       CASE WHEN vec_id % 2 = 0 THEN 'images/' || {CLASS_NAME_SQL} || '/' || vec_id || '_TCI.tif' ELSE '' END AS tci_key,
       CASE WHEN vec_id % 2 = 0 THEN 'TCI' ELSE 'MULTIBAND' END AS mode,
       printf('%.4f', ratio) AS cloud_ratio,
       CASE WHEN ratio >= 0.3e0 THEN 'MOVE' ELSE 'KEEP' END AS action,
       CASE WHEN ratio >= 0.3e0 THEN 'cloudy_images/' || {CLASS_NAME_SQL} || '/' || vec_id || '.tif' ELSE '' END AS dst_merged,
       CASE WHEN ratio >= 0.3e0 AND vec_id % 2 = 0
            THEN 'cloudy_images/' || {CLASS_NAME_SQL} || '/' || vec_id || '_TCI.tif' ELSE '' END AS dst_tci
FROM (SELECT m.vec_id, m.cls, CASE WHEN m.vec_id % 2 = 0 THEN r.ratio ELSE m.ratio END AS ratio
      FROM mr m JOIN rr r ON m.vec_id = r.vec_id) t"""
REPORT_VIEWS = views("pt", extra={"tci": TCI_SQL, "rr": RGB_RATIO_SQL, "bs": BAND_STATS_SQL, "scaled": SCALED_SQL,
                                  "mr": MB_RATIO_SQL,
                                  "report": REPORT_SQL})


@register("cloud_report", with_views("SELECT * FROM report", extra=REPORT_VIEWS))
def q_cloud_report(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d).drop("ratio_value")


@register("cloud_summary", with_views("""
SELECT count(*) AS total, count(cloud_ratio) AS examined, CAST(count_if(action <> 'KEEP') AS BIGINT) AS cloudy,
       count_if(action <> 'KEEP') / greatest(1, count(cloud_ratio)) AS cloudy_share FROM report""",
                                      extra=REPORT_VIEWS))
def q_cloud_summary(spark: SparkSession, d: str) -> DataFrame:
    return qa.cloud_summary(_report(spark, d))


#: Every fifth image was listed but could not be read.
MISSING_SQL = """SELECT class, merged_key, tci_key, mode, CASE WHEN gone THEN 'null' ELSE cloud_ratio END AS cloud_ratio,
  CASE WHEN gone THEN 'ERROR' WHEN action = 'KEEP' THEN 'KEEP' ELSE 'DELETE' END AS action,
  CASE WHEN gone THEN '' ELSE dst_merged END AS dst_merged, CASE WHEN gone THEN '' ELSE dst_tci END AS dst_tci
FROM (SELECT *, CAST(regexp_extract(merged_key, '/([0-9]+)[.]tif$', 1) AS BIGINT) % 5 = 0 AS gone FROM report) r"""


@register("cloud_report_missing", with_views(MISSING_SQL, extra=REPORT_VIEWS))
def q_cloud_report_missing(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d, read=F.col("vec_id") % 5 != 0, action="DELETE").drop("ratio_value")


# ------------------------------------------------------------------ F10-F15
CM_SQL = """SELECT t.range AS y_true, p.range AS y_pred, coalesce(c.n, 0) AS n
FROM range(6) t CROSS JOIN range(6) p
LEFT JOIN (SELECT y_true, y_pred, count(*) AS n FROM pred GROUP BY y_true, y_pred) c
  ON c.y_true = t.range AND c.y_pred = p.range"""
PC_SQL = """SELECT cls, tp, support, predicted,
       CASE WHEN predicted > 0 THEN tp / predicted ELSE 0e0 END AS precision,
       CASE WHEN support > 0 THEN tp / support ELSE 0e0 END AS recall
FROM (SELECT y_true AS cls,
             CAST(sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(n) AS BIGINT) AS support,
             CAST((SELECT sum(n) FROM cm c2 WHERE c2.y_pred = cm.y_true) AS BIGINT) AS predicted
      FROM cm GROUP BY y_true) t"""
PCF_SQL = """SELECT *, CASE WHEN precision + recall > 0 THEN 2e0 * precision * recall / (precision + recall) ELSE 0e0 END AS f1
FROM pc"""


@register("confusion", with_views("SELECT * FROM cm", extra=views("pred", extra={"cm": CM_SQL})))
def q_confusion(spark: SparkSession, d: str) -> DataFrame:
    return ev.confusion(predictions(spark, d), N_CLASSES)


@register("confusion_norm", with_views("""
SELECT y_true, y_pred, n, round(n / greatest(CAST(sum(n) OVER (PARTITION BY y_true) AS DOUBLE), 1e-6), 6) AS rate
FROM cm""", extra=views("pred", extra={"cm": CM_SQL})))
def q_confusion_norm(spark: SparkSession, d: str) -> DataFrame:
    cm = ev.confusion_normalized(ev.confusion(predictions(spark, d), N_CLASSES))
    return cm.withColumn("rate", F.round("rate", 6))


@register("class_report", with_views(f"""
SELECT {CLASS_NAME_SQL} AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM pcf
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcf""",
                                     extra=views("pred", extra={"cm": CM_SQL, "pc": PC_SQL, "pcf": PCF_SQL})))
def q_class_report(spark: SparkSession, d: str) -> DataFrame:
    r = ev.classification_report(predictions(spark, d), CLASS_NAMES)
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


PRED_FOLDS_SQL = "SELECT p.*, f.fold FROM pred p JOIN folds f ON p.vec_id = f.vec_id"
TOPK_SQL = """SELECT fold, count(*) AS n, avg(CASE WHEN y_true = y_pred THEN 1e0 ELSE 0e0 END) AS acc,
       avg(CASE WHEN (len(list_filter(range(1, 7), lambda j: scores[j] > scores[y_true + 1]))
                    + len(list_filter(range(1, 7), lambda j: scores[j] = scores[y_true + 1] AND j < y_true + 1))) < 2
                THEN 1e0 ELSE 0e0 END) AS top2
FROM pf GROUP BY fold"""


@register("top_k", with_views("SELECT fold, n, round(acc, 6) AS acc, round(top2, 6) AS top2 FROM tk",
                              extra=views("pt", "folds", "pred", extra={"pf": PRED_FOLDS_SQL, "tk": TOPK_SQL})))
def q_top_k(spark: SparkSession, d: str) -> DataFrame:
    pf = predictions(spark, d).join(folds_df(spark, d).select("vec_id", "fold"), "vec_id")
    t = ev.topk_by_fold(pf, 2)
    return t.select("fold", "n", F.round("acc", 6).alias("acc"), F.round("top2", 6).alias("top2"))


CMF_SQL = """SELECT f.range AS fold, t.range AS y_true, p.range AS y_pred, coalesce(c.n, 0) AS n
FROM range(10) f CROSS JOIN range(6) t CROSS JOIN range(6) p
LEFT JOIN (SELECT fold, y_true, y_pred, count(*) AS n FROM pf GROUP BY ALL) c
  ON c.fold = f.range AND c.y_true = t.range AND c.y_pred = p.range"""
PCFOLD_SQL = """SELECT fold, cls, tp, support, predicted,
       CASE WHEN predicted > 0 THEN tp / predicted ELSE 0e0 END AS precision,
       CASE WHEN support > 0 THEN tp / support ELSE 0e0 END AS recall
FROM (SELECT fold, y_true AS cls,
             CAST(sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(n) AS BIGINT) AS support,
             CAST((SELECT sum(n) FROM cmf c2 WHERE c2.y_pred = cmf.y_true AND c2.fold = cmf.fold) AS BIGINT) AS predicted
      FROM cmf GROUP BY fold, y_true) t"""
PCFOLDF_SQL = """SELECT *, CASE WHEN precision + recall > 0 THEN 2e0 * precision * recall / (precision + recall) ELSE 0e0 END AS f1
FROM pcfold"""
SUMMARY_SQL = """SELECT s.fold, CAST(t.total - v.n_val - s.n_test AS BIGINT) AS n_train, v.n_val, s.n_test,
       round(m.acc, 6) AS acc, round(k.top2, 6) AS top2, round(m.macro_f1, 6) AS macro_f1, round(m.weighted_f1, 6) AS weighted_f1
FROM (SELECT fold, count(*) AS n_test FROM folds GROUP BY fold) s
JOIN (SELECT CAST((fold + 9) % 10 AS BIGINT) AS fold, count(*) AS n_val FROM folds GROUP BY fold) v ON v.fold = s.fold
JOIN (SELECT fold, sum(tp) / sum(support) AS acc, avg(f1) AS macro_f1,
             CASE WHEN sum(support) > 0 THEN sum(f1 * support) / sum(support) ELSE 0e0 END AS weighted_f1
      FROM pcfoldf GROUP BY fold) m ON m.fold = s.fold
JOIN tk k ON k.fold = s.fold
CROSS JOIN (SELECT count(*) AS total FROM folds) t"""
SUMMARY_VIEWS = views("pt", "folds", "pred", extra={"pf": PRED_FOLDS_SQL, "tk": TOPK_SQL, "cmf": CMF_SQL,
                                                    "pcfold": PCFOLD_SQL, "pcfoldf": PCFOLDF_SQL,
                                                    "summary": SUMMARY_SQL})


def _summary(spark: SparkSession, d: str) -> DataFrame:
    folds = folds_df(spark, d)
    pf = predictions(spark, d).join(folds.select("vec_id", "fold"), "vec_id")
    return ev.cv_summary(folds, pf, N_CLASSES, K, 2)


@register("cv_summary", with_views("SELECT * FROM summary", extra=SUMMARY_VIEWS))
def q_cv_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _summary(spark, d)
    return s.select("fold", "n_train", "n_val", "n_test",
                    *[F.round(c, 6).alias(c) for c in ("acc", "top2", "macro_f1", "weighted_f1")])


@register("cv_stats", with_views("""
SELECT round(avg(acc), 6) AS acc_mean, round(stddev_pop(acc), 6) AS acc_std,
       round(avg(top2), 6) AS top2_mean, round(stddev_pop(top2), 6) AS top2_std,
       round(avg(macro_f1), 6) AS macro_f1_mean, round(stddev_pop(macro_f1), 6) AS macro_f1_std,
       round(avg(weighted_f1), 6) AS weighted_f1_mean, round(stddev_pop(weighted_f1), 6) AS weighted_f1_std,
       count(*) AS folds
FROM (SELECT s.fold, m.acc, k.top2, m.macro_f1, m.weighted_f1 FROM
        (SELECT fold, sum(tp) / sum(support) AS acc, avg(f1) AS macro_f1,
                CASE WHEN sum(support) > 0 THEN sum(f1 * support) / sum(support) ELSE 0e0 END AS weighted_f1
         FROM pcfoldf GROUP BY fold) m
      JOIN tk k ON k.fold = m.fold JOIN (SELECT DISTINCT fold FROM folds) s ON s.fold = m.fold) x""",
                                 extra=SUMMARY_VIEWS))
def q_cv_stats(spark: SparkSession, d: str) -> DataFrame:
    st = ev.cv_stats(_summary(spark, d))
    return st.select(*[F.round(c, 6).alias(c) for c in st.columns if c != "folds"], "folds")


@register("confusion_all_folds", with_views("""
SELECT y_true, y_pred, CAST(sum(n) AS BIGINT) AS n FROM cmf GROUP BY y_true, y_pred""", extra=SUMMARY_VIEWS))
def q_confusion_all_folds(spark: SparkSession, d: str) -> DataFrame:
    pf = predictions(spark, d).join(folds_df(spark, d).select("vec_id", "fold"), "vec_id")
    return ev.confusion_sum(ev.confusion(pf, N_CLASSES, K))


# ------------------------------------------------------------------ J9
def _u(i: int) -> str:
    return f"CAST(('0x' || substr(md5(vec_id || ':{SEED}:3:{i}'), 1, 13)) AS BIGINT) / 4503599627370496e0"


AUGMENT_SQL = f"""
WITH pt AS ({PT_SQL}),
u AS (SELECT vec_id, bands, {', '.join(f'{_u(i)} AS u{i}' for i in range(7))} FROM pt),
p AS (SELECT *, CASE WHEN u2 < 0.5 THEN 1 + CAST(floor(u3 * 3) AS INTEGER) ELSE 0 END AS turns,
  CASE WHEN u4 < 0.5 THEN 0.9e0 + 0.2e0 * u5 ELSE 1e0 END AS scale, CASE WHEN u4 < 0.5 THEN 0.06e0 * u6 - 0.03e0 ELSE 0e0 END AS shift FROM u),
-- the pixel (r, c) of a turned image comes from (tr, tc) of the mirrored one, and that from (sr, sc) of the first
t AS (SELECT *, i // 4 AS r, i % 4 AS c FROM p, (SELECT unnest(range(16)) AS i) x),
m AS (SELECT *, CASE turns WHEN 0 THEN r WHEN 1 THEN c WHEN 2 THEN 3 - r ELSE 3 - c END AS tr,
  CASE turns WHEN 0 THEN c WHEN 1 THEN 3 - r WHEN 2 THEN 3 - c ELSE r END AS tc FROM t),
s AS (SELECT *, 1 + 4 * (CASE WHEN u1 < 0.5 THEN 3 - tr ELSE tr END) + (CASE WHEN u0 < 0.5 THEN 3 - tc ELSE tc END) AS src FROM m),
g AS (SELECT vec_id, any_value(turns) AS turns, any_value(scale) AS scale, any_value(shift) AS shift, any_value(u4) AS u4,
  list(i ORDER BY i) AS i, list([bands[1][src], bands[2][src], bands[3][src], bands[4][src]] ORDER BY i) AS px FROM s GROUP BY vec_id)
SELECT vec_id, turns, list_transform(flatten([list_transform(px, lambda v: v[1]), list_transform(px, lambda v: v[2]), list_transform(px, lambda v: v[3]),
  list_transform(px, lambda v: v[4])]), lambda v: round(CASE WHEN u4 < 0.5 THEN greatest(v * scale + shift, 0e0) ELSE v END, 6)) AS augmented FROM g"""


@register("augment", AUGMENT_SQL)
def q_augment(spark: SparkSession, d: str) -> DataFrame:
    p = patches(spark, d).select("vec_id", F.flatten("bands").alias("pixels"))
    a = ra.augment(p, "pixels", 4, 4, 4, SEED, 3, key="vec_id")
    turns = ra.augment_plan(p, "vec_id", SEED, 3).select("vec_id", F.col("plan.turns").alias("turns"))
    return a.join(turns, "vec_id").select("vec_id", "turns", F.transform("augmented", lambda v: F.round(v, 6)).alias("augmented"))
