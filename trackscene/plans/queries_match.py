"""Registered queries: matching, prediction, open sea."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators import match
from ..session import checkpoint_dir
from . import fixtures as fx
from .fixtures import HALF_WINDOW_MIN, us, with_views
from .registry import register

CLOSEST_COLS = ["id", "ts", "mmsi", "lon", "lat", "ship_type", "length", "api_id", "sensing_time", "rel",
                "time_diff"]
PREDICTED_COLS = ["id", "mmsi", "ship_type", "length", "api_id", "sensing_time", "lon", "lat"]


def matched(spark: SparkSession, d: str) -> DataFrame:
    return match.match_window(fx.ais(spark, d), fx.scenes(spark, d), HALF_WINDOW_MIN)


def predicted(spark: SparkSession, d: str) -> DataFrame:
    return match.predict_positions(fx.ais(spark, d), fx.scenes(spark, d), HALF_WINDOW_MIN, digits=6)


@register("closest_fixes", with_views("SELECT * FROM closest", "closest"))
def q_closest_fixes(spark: SparkSession, d: str) -> DataFrame:
    return match.closest_fixes(matched(spark, d), columns=CLOSEST_COLS)


@register("closest_fixes_per_scene", with_views(f"""
SELECT id, ts, mmsi, lon, lat, ship_type, length, api_id, sensing_time, rel, time_diff FROM (
  SELECT m.*, row_number() OVER (PARTITION BY api_id, mmsi, rel
                                 ORDER BY abs({us('sensing_time', 'ts')}), id) AS rnk
  FROM matched m) t
WHERE rnk = 1""", "matched"))
def q_closest_fixes_per_scene(spark: SparkSession, d: str) -> DataFrame:
    return match.closest_fixes(matched(spark, d), keys=("mmsi", "api_id"), columns=CLOSEST_COLS)


@register("closest_fixes_two_passes", with_views(f"""
SELECT id, ts, mmsi, lon, lat, ship_type, length, api_id, sensing_time, rel, time_diff FROM (
  SELECT m.*, row_number() OVER (PARTITION BY api_id, mmsi, rel
                                 ORDER BY abs({us('sensing_time', 'ts')}), id, sensing_time) AS rnk
  FROM two m) t
WHERE rnk = 1""", "ais", "scenes", extra={"passes": fx.PASSES_SQL, "two": fx.MATCHED_SQL.replace("JOIN scenes s", "JOIN passes s")}))
def q_closest_fixes_two_passes(spark: SparkSession, d: str) -> DataFrame:
    """E4 where it differs from E3: one api_id has two sensing times, and only the nearest report of both survives."""
    m = match.match_window(fx.ais(spark, d), fx.passes(spark, d), HALF_WINDOW_MIN)
    return match.closest_fixes(m, keys=("mmsi", "api_id"), columns=CLOSEST_COLS)


@register("closest_fixes_by_day", with_views("SELECT * FROM closest", "closest"))
def q_closest_fixes_by_day(spark: SparkSession, d: str) -> DataFrame:
    """E3 on reports laid out by day: only days that a scene's window touches are read."""
    path = f"{checkpoint_dir(spark)}/by-day-{uuid.uuid4().hex}"
    match.write_by_day(fx.ais(spark, d), path)
    m = match.match_window(match.read_by_day(spark, path), fx.scenes(spark, d), HALF_WINDOW_MIN, day="day")
    return match.closest_fixes(m.drop("day"), columns=CLOSEST_COLS)


@register("predict_positions", with_views("SELECT * FROM predicted", "predicted"))
def q_predict_positions(spark: SparkSession, d: str) -> DataFrame:
    return predicted(spark, d)


@register("predict_from_closest", with_views("SELECT * FROM predicted", "predicted"))
def q_predict_from_closest(spark: SparkSession, d: str) -> DataFrame:
    """E5 as written in the reference: pairs built from a stored closest table."""
    closest = match.closest_fixes(matched(spark, d), columns=CLOSEST_COLS)
    return match.interpolate_pairs(match.pairs_from_closest(closest), digits=6, columns=PREDICTED_COLS)
