"""Matching position reports to scenes.

Plan shape (checked with ``explain``):

* E2 ``match_window`` -- the *scene* side is exploded into (time bucket, grid
  cell) keys, never the positions; positions get exactly one key each.  The join
  is an equi join on the key plus the exact window / footprint test, so Spark
  plans a hash join (broadcast when AQE measures the scene side below
  ``spark.sql.autoBroadcastJoinThreshold``, otherwise a shuffled join whose
  skewed keys AQE splits).  The naive form is a nested-loop join.
* E3/E5 fused -- one ``groupBy(mmsi, api_id, sensing_time)`` keeps the nearest
  ``before`` and ``after`` report as ``min_by(row, struct(|dt|, id))``.  That is a
  partial (map-side) aggregation: every task reduces its rows to one per group
  before the shuffle, so a vessel holding a third of all reports is no hot spot,
  and the before/after self join of the reference disappears.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import interpolate, is_empty_point
from ..functions.text import product_id
from ..functions.timefn import epoch_micros, micros_between
from ..session import pin_utc

_S = "_s_"  # prefix of scene-side helper columns


def index_scenes(index: DataFrame, metadata: DataFrame, *, file_col: str = "file_name",
                 key_col: str = "api_id") -> DataFrame:
    """Product index joined to the scene catalog on the product id of the file name:
    ``X.SAFE.zip``, ``X.zip``, ``X.SAFE`` and ``X`` all name product ``X``.

    Inner equi join; duplicate index rows multiply.  The catalog side is small
    per product, and AQE turns the join into a broadcast only when it measures
    that side below the broadcast threshold.
    """
    idx = index.withColumn("product_id", product_id(F.col(file_col)))
    return idx.join(metadata, idx["product_id"] == metadata[key_col], "inner")


def scene_time_range(scenes: DataFrame, scene_time: str = "sensing_time") -> tuple:
    """(first, last) sensing time: one row to the driver, whatever the catalog's size."""
    r = scenes.agg(F.min(scene_time).alias("a"), F.max(scene_time).alias("b")).first()
    return r["a"], r["b"]


def write_by_day(positions: DataFrame, path: str, ts: str = "ts", day: str = "day") -> None:
    """The positions laid out by UTC day of ``ts``, each day dealt to as many files as its rows need; null times have a
    folder of their own."""
    pin_utc(positions.sparkSession)
    d = positions.withColumn(day, F.col(ts).cast("date"))
    # a rebalance splits large days and joins small ones; no day is bound to one task
    d.hint("rebalance", day).write.partitionBy(day).parquet(path)


def read_by_day(spark, path: str, schema=None) -> DataFrame:
    """Positions that ``write_by_day`` laid out (``schema``: theirs, with the day last)."""
    pin_utc(spark)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def _scene_days(scenes: DataFrame, scene_time: str, half: int) -> DataFrame:
    """The UTC days that the windows of the scenes touch."""
    us = epoch_micros(F.col(scene_time), scenes.schema[scene_time].dataType)
    edge = lambda x: F.timestamp_micros(x).cast("date")
    # Spark prunes only by a side with a condition it takes for selective; a null time has no window
    some = scenes.where(F.col(scene_time) >= F.lit(dt.datetime(1, 1, 1)).cast(scenes.schema[scene_time].dataType))
    return some.select(F.explode(F.sequence(edge(us - F.lit(half)), edge(us + F.lit(half)))).alias("_day")).distinct()


def match_window(positions: DataFrame, scenes: DataFrame, minutes: float = 10, *,
                 ts: str = "ts", lon: str = "lon", lat: str = "lat",
                 scene_key: str = "api_id", scene_time: str = "sensing_time",
                 box: Sequence[str] = ("xmin", "ymin", "xmax", "ymax"),
                 cell_size: float = 1.0, salt: int = 1, id_col: str = "id",
                 between: tuple | None = None, day: str | None = None) -> DataFrame:
    """E2 (+D8, B5, B6): every (report, scene) with ``|ts - sensing_time| <= minutes``
    (inclusive) and the report inside the scene footprint box (inclusive).

    ``salt > 1`` spreads hot (bucket, cell) keys over ``salt`` shuffle
    partitions when the scene side is too large to broadcast: scene key rows are
    replicated per salt, each report takes one salt from a hash of its id.
    ``between`` = (first, last) sensing time (``scene_time_range``) adds bounds on
    ``ts`` that reach the scan of the positions, so files outside are not read.
    ``day`` names a column of ``positions`` that holds the UTC day of ``ts`` and
    by which its files are laid out (``write_by_day``): the days that scene
    windows touch are sent to all executors (a row for each calendar day, so
    their number is bounded), and Spark prunes all other days while it runs.

    Output: all position columns, ``scene_key``, ``scene_time``, ``rel``
    ('before' when ts <= sensing time, else 'after'), ``diff_us`` (signed,
    ts - sensing_time) and ``time_diff`` (absolute seconds).
    """
    pin_utc(positions.sparkSession)  # NTZ differences are taken through the session zone
    half = int(round(minutes * 60 * 1_000_000))
    width = 2 * half if half > 0 else 1
    ts_type = positions.schema[ts].dataType
    st_type = scenes.schema[scene_time].dataType
    if between is not None:
        first, last = (t if t is not None else dt.datetime(1970, 1, 1) for t in between)
        pad = dt.timedelta(microseconds=half)
        positions = positions.where((F.col(ts) >= F.lit(first - pad)) & (F.col(ts) <= F.lit(last + pad)))
    if day is not None:
        positions = positions.join(F.broadcast(_scene_days(scenes, scene_time, half).withColumnRenamed("_day", day)), day, "left_semi").select(*positions.columns)
    pos = (positions
           .where(F.col(ts).isNotNull() & F.col(lon).isNotNull() & F.col(lat).isNotNull())
           .select("*", F.floor(epoch_micros(F.col(ts), ts_type) / F.lit(width)).alias("_tb"),
                   F.floor(F.col(lon) / F.lit(cell_size)).alias("_cx"),
                   F.floor(F.col(lat) / F.lit(cell_size)).alias("_cy")))
    xmin, ymin, xmax, ymax = box
    s_us = epoch_micros(F.col(scene_time), st_type)
    sc = (scenes
          .where(F.col(scene_time).isNotNull() & F.col(xmin).isNotNull() & F.col(ymin).isNotNull()
                 & F.col(xmax).isNotNull() & F.col(ymax).isNotNull())
          .select(F.col(scene_key).alias(_S + "key"), F.col(scene_time).alias(_S + "time"),
                  F.col(xmin).alias(_S + "xmin"), F.col(ymin).alias(_S + "ymin"),
                  F.col(xmax).alias(_S + "xmax"), F.col(ymax).alias(_S + "ymax"),
                  F.sequence(F.floor((s_us - F.lit(half)) / F.lit(width)),
                             F.floor((s_us + F.lit(half)) / F.lit(width))).alias("_tbs"),
                  F.sequence(F.floor(F.col(xmin) / F.lit(cell_size)),
                             F.floor(F.col(xmax) / F.lit(cell_size))).alias("_cxs"),
                  F.sequence(F.floor(F.col(ymin) / F.lit(cell_size)),
                             F.floor(F.col(ymax) / F.lit(cell_size))).alias("_cys"))
          .select("*", F.explode("_tbs").alias("_tb"))
          .select("*", F.explode("_cxs").alias("_cx"))
          .select("*", F.explode("_cys").alias("_cy"))
          .drop("_tbs", "_cxs", "_cys"))
    if salt > 1:
        pos = pos.withColumn("_salt", F.pmod(F.xxhash64(F.col(id_col)), F.lit(salt)).cast("int"))
        sc = sc.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    diff = micros_between(sc[_S + "time"], pos[ts])
    cond = ((pos["_tb"] == sc["_tb"]) & (pos["_cx"] == sc["_cx"]) & (pos["_cy"] == sc["_cy"])
            & (F.abs(diff) <= F.lit(half))
            & pos[lon].between(sc[_S + "xmin"], sc[_S + "xmax"])
            & pos[lat].between(sc[_S + "ymin"], sc[_S + "ymax"]))
    if salt > 1:
        cond = cond & (pos["_salt"] == sc["_salt"])
    j = pos.join(sc, cond, "inner")
    out_cols = [pos[c] for c in positions.columns]
    return j.select(*out_cols,
                    sc[_S + "key"].alias(scene_key), sc[_S + "time"].alias(scene_time),
                    F.when(pos[ts] <= sc[_S + "time"], F.lit("before")).otherwise(F.lit("after")).alias("rel"),
                    micros_between(sc[_S + "time"], pos[ts]).alias("diff_us"),
                    (F.abs(micros_between(sc[_S + "time"], pos[ts])) / F.lit(1e6)).alias("time_diff"))


def match_window_naive(positions: DataFrame, scenes: DataFrame, minutes: float = 10, *,
                       ts: str = "ts", lon: str = "lon", lat: str = "lat",
                       scene_key: str = "api_id", scene_time: str = "sensing_time",
                       box: Sequence[str] = ("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """E2 written as the plain theta join (nested-loop plan); kept for tests and the bench."""
    half = int(round(minutes * 60 * 1_000_000))
    xmin, ymin, xmax, ymax = box
    sc = scenes.select(F.col(scene_key).alias(_S + "key"), F.col(scene_time).alias(_S + "time"),
                       *[F.col(b).alias(_S + b) for b in box])
    diff = micros_between(sc[_S + "time"], positions[ts])
    cond = ((F.abs(diff) <= F.lit(half))
            & positions[lon].between(sc[_S + xmin], sc[_S + xmax])
            & positions[lat].between(sc[_S + ymin], sc[_S + ymax]))
    j = positions.join(sc, cond, "inner")
    return j.select(*[positions[c] for c in positions.columns],
                    sc[_S + "key"].alias(scene_key), sc[_S + "time"].alias(scene_time),
                    F.when(positions[ts] <= sc[_S + "time"], F.lit("before")).otherwise(F.lit("after")).alias("rel"),
                    diff.alias("diff_us"), (F.abs(diff) / F.lit(1e6)).alias("time_diff"))


def _nearest_parts(matched: DataFrame, keys: Sequence[str], id_col: str) -> tuple[Column, Column, list[str]]:
    payload = [c for c in matched.columns if c not in keys and c != id_col]
    value = F.struct(F.col(id_col), *[F.col(c) for c in payload])
    order = F.struct(F.abs(F.col("diff_us")).alias("_abs_us"), F.col(id_col).alias("_id"))
    return value, order, [id_col] + payload


def nearest_before_after(matched: DataFrame, keys: Sequence[str] = ("mmsi", "api_id", "sensing_time"),
                         id_col: str = "id") -> DataFrame:
    """E3 + E5 fused: per group the nearest report on each side of the scene time.

    Ordering is (|dt| in integer microseconds, id) -- deterministic ties.  One
    partial aggregation (``min_by`` with the ordering NULL on the other side);
    output ``keys + [before, after]`` (structs, NULL when that side has no
    report).  Measured against ``min(struct)`` and a ``row_number`` window on
    the sf0.1 match set: 0.63 s vs 0.87 s and 0.72 s.
    """
    value, order, _ = _nearest_parts(matched, keys, id_col)
    rel = F.col("rel")
    return (matched.groupBy(*keys)
            .agg(F.min_by(value, F.when(rel == "before", order)).alias("before"),
                 F.min_by(value, F.when(rel == "after", order)).alias("after")))


def closest_fixes(matched: DataFrame, keys: Sequence[str] = ("mmsi", "api_id", "sensing_time"),
                  id_col: str = "id", columns: Sequence[str] | None = None) -> DataFrame:
    """One row per (keys, relation): the report nearest to the scene time.

    ``keys`` without ``sensing_time`` gives E4 (the per-scene loop flavour:
    best per (api_id, mmsi, relation)).  ``columns`` fixes the output order
    (defaults to the matched columns minus ``diff_us``).
    """
    pairs = nearest_before_after(matched, keys, id_col)
    _, _, field_names = _nearest_parts(matched, keys, id_col)
    sides = F.filter(F.array(F.col("before"), F.col("after")), lambda x: x.isNotNull())
    flat = pairs.select(*keys, F.explode(sides).alias("_b"))
    out = flat.select(*keys, *[F.col("_b")[f].alias(f) for f in field_names])
    cols = list(columns) if columns is not None else [c for c in matched.columns if c != "diff_us"]
    return out.select(*cols)


def pairs_from_closest(closest: DataFrame, keys: Sequence[str] = ("mmsi", "api_id", "sensing_time"),
                       id_col: str = "id", ts: str = "ts") -> DataFrame:
    """E5 on a stored closest table: before/after pairs with one aggregation
    instead of the self join (each group has at most one row per side)."""
    payload = [c for c in closest.columns if c not in keys]
    s = F.struct(*[F.col(c) for c in payload])
    return (closest.groupBy(*keys)
            .agg(F.min(F.when(F.col("rel") == "before", s)).alias("before"),
                 F.min(F.when(F.col("rel") == "after", s)).alias("after")))


def interpolate_pairs(pairs: DataFrame, *, keys: Sequence[str] = ("mmsi", "api_id", "sensing_time"),
                      id_col: str = "id", ts: str = "ts", lon: str = "lon", lat: str = "lat",
                      scene_time: str = "sensing_time", carry: Sequence[str] = ("ship_type", "length"),
                      digits: int | None = None,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """E6 (D10, C6, D11): inner pairing (both sides present), position at the
    scene time by linear interpolation; attributes and id from the *before* side.
    """
    b, a = F.col("before"), F.col("after")
    t_scene = F.col(scene_time) if scene_time in keys else b[scene_time]
    past = micros_between(b[ts], t_scene)
    total = micros_between(b[ts], a[ts])
    p = interpolate(b[lon], b[lat], a[lon], a[lat], past, total)
    plon, plat = p["lon"], p["lat"]
    if digits is not None:
        plon, plat = F.round(plon, digits), F.round(plat, digits)
    out = (pairs.where(b.isNotNull() & a.isNotNull() & (total >= 0))
           .select(b[id_col].alias(id_col),
                   *[F.col(k) for k in keys],
                   *[b[c].alias(c) for c in carry],
                   *([] if scene_time in keys else [t_scene.alias(scene_time)]),
                   plon.alias(lon), plat.alias(lat))
           .where(~is_empty_point(lon, lat)))
    if columns is not None:
        out = out.select(*columns)
    return out


def predict_positions(positions: DataFrame, scenes: DataFrame, minutes: float = 10, *,
                      digits: int | None = None, cell_size: float = 1.0,
                      carry: Sequence[str] = ("ship_type", "length"), salt: int = 1, day: str | None = None) -> DataFrame:
    """E2 -> E3/E5 -> E6 as one plan: a single shuffle after the (broadcast) join.  ``day`` as in ``match_window``."""
    m = match_window(positions, scenes, minutes, cell_size=cell_size, salt=salt, day=day)
    m = m.drop(day) if day else m
    pairs = nearest_before_after(m)
    return interpolate_pairs(pairs, digits=digits, carry=carry,
                             columns=["id", "mmsi", *carry, "api_id", "sensing_time", "lon", "lat"])
