"""Matching and spatial operators: plan shape, equivalences, geometry goldens."""

import math
from datetime import datetime, timedelta

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackscene.functions import geo
from trackscene.operators import match, spatial
from trackscene.plans import fixtures as fx

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_match_window_plans_hash_join_not_nested_loop(spark):
    m = match.match_window(fx.ais(spark, SF_SMALL), fx.scenes(spark, SF_SMALL), fx.HALF_WINDOW_MIN)
    p = _plan(m)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    naive = match.match_window_naive(fx.ais(spark, SF_SMALL), fx.scenes(spark, SF_SMALL), fx.HALF_WINDOW_MIN)
    assert "NestedLoopJoin" in _plan(naive)


def test_bucketed_join_equals_naive_join(spark):
    a, s = fx.ais(spark, SF_SMALL), fx.scenes(spark, SF_SMALL)
    for minutes in (10, 90, 720):
        m1 = match.match_window(a, s, minutes).select("id", "api_id", "diff_us")
        m2 = match.match_window_naive(a, s, minutes).select("id", "api_id", "diff_us")
        assert m1.exceptAll(m2).count() == 0 and m2.exceptAll(m1).count() == 0


def test_window_bounds_are_inclusive(spark):
    t0 = datetime(2024, 1, 1, 12, 0, 0)
    pos = spark.createDataFrame(
        [(1, t0 - timedelta(minutes=10), 5, 1.0, 1.0), (2, t0 + timedelta(minutes=10), 5, 1.0, 1.0),
         (3, t0 + timedelta(minutes=10, microseconds=1), 5, 1.0, 1.0), (4, t0, 5, 2.0, 2.0),
         (5, t0, 5, 2.0000001, 2.0)],
        "id long, ts timestamp_ntz, mmsi long, lon double, lat double")
    sc = spark.createDataFrame([("A", t0, 0.0, 0.0, 2.0, 2.0)],
                               "api_id string, sensing_time timestamp_ntz, xmin double, ymin double, xmax double, ymax double")
    got = sorted(r.id for r in match.match_window(pos, sc, 10).collect())
    assert got == [1, 2, 4]


def test_pairs_by_aggregate_equal_self_join(spark):
    m = match.match_window(fx.ais(spark, SF_SMALL), fx.scenes(spark, SF_SMALL), fx.HALF_WINDOW_MIN)
    closest = match.closest_fixes(m)
    b = closest.where("rel = 'before'").alias("b")
    a = closest.where("rel = 'after'").alias("a")
    self_join = (b.join(a, (F.col("b.mmsi") == F.col("a.mmsi")) & (F.col("b.api_id") == F.col("a.api_id"))
                        & (F.col("b.sensing_time") == F.col("a.sensing_time")))
                 .select(F.col("b.id").alias("id"), F.col("a.id").alias("aid")))
    agg = match.nearest_before_after(m).where("before IS NOT NULL AND after IS NOT NULL") \
        .select(F.col("before.id").alias("id"), F.col("after.id").alias("aid"))
    assert self_join.exceptAll(agg).count() == 0 and agg.exceptAll(self_join).count() == 0


def test_interpolated_point_inside_fix_bbox(spark):
    m = match.match_window(fx.ais(spark, SF_SMALL), fx.scenes(spark, SF_SMALL), fx.HALF_WINDOW_MIN)
    pairs = match.nearest_before_after(m)
    p = match.interpolate_pairs(pairs, columns=None).join(
        pairs.select("mmsi", "api_id", "sensing_time", "before", "after"), ["mmsi", "api_id", "sensing_time"])
    bad = p.where("lon < least(before.lon, after.lon) - 1e-9 OR lon > greatest(before.lon, after.lon) + 1e-9 "
                  "OR lat < least(before.lat, after.lat) - 1e-9 OR lat > greatest(before.lat, after.lat) + 1e-9")
    assert bad.count() == 0


def test_point_in_polygon_with_hole_and_boundary(spark):
    outer = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    hole = [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0), (4.0, 4.0)]
    poly = spark.createDataFrame([(1, [[{"x": x, "y": y} for x, y in outer], [{"x": x, "y": y} for x, y in hole]])],
                                 "id long, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame(
        [(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 4.0, 5.0), (4, 10.0, 3.0), (5, 11.0, 1.0), (6, 0.0, 0.0), (7, 3.0, 0.5)],
        "pid long, lon double, lat double")
    rings = [[{"x": x, "y": y} for x, y in outer], [{"x": x, "y": y} for x, y in hole]]
    with_rings = spark.createDataFrame([(r.pid, r.lon, r.lat, rings) for r in pts.collect()],
                                       "pid long, lon double, lat double, rings array<array<struct<x:double,y:double>>>")
    j = with_rings.select("pid", geo.point_in_polygon("lon", "lat", "rings").alias("inside"))
    got = {r.pid: r.inside for r in j.collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: False, 6: True, 7: True}
    # the cell-split semi join agrees, with small cells so the polygon spans many
    semi = spatial.points_in_polygons(pts, poly, cell_size=1.0)
    assert sorted(r.pid for r in semi.collect()) == [1, 3, 4, 6, 7]
    assert "NestedLoopJoin" not in _plan(semi)


def _ring(n, seed):
    """A simple (star-shaped) ring: vertices by angle around a centre with every
    angular gap below 180 degrees, so the centre stays in the kernel."""
    rng = np.random.default_rng(seed)
    ang = (np.arange(n) + rng.uniform(0.3, 0.7, n)) * (2 * math.pi / n)
    rad = rng.uniform(1.0, 5.0, n)
    return 7.3 + rad * np.cos(ang), -2.1 + rad * np.sin(ang)


@settings(max_examples=30, deadline=None)
@given(st.integers(3, 40), st.integers(0, 10_000), st.sampled_from([0.5, 1.0, 2.5]))
def test_signed_cell_pieces_sum_for_any_ring(n, seed, cell):
    rng = np.random.default_rng(seed)  # arbitrary, possibly self-intersecting rings
    xs, ys = rng.uniform(0, 6, n), rng.uniform(-3, 3, n)
    parts = sum(spatial.ring_area(x, y) for _, _, rs, _ in spatial.split_polygon([xs], [ys], cell, 0.0) for x, y in rs)
    assert math.isclose(spatial.ring_area(xs, ys), parts, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=30, deadline=None)
@given(st.integers(3, 40), st.integers(0, 10_000), st.sampled_from([0.5, 1.0, 2.5]))
def test_cell_pieces_sum_to_whole_area(n, seed, cell):
    xs, ys = _ring(n, seed)
    whole = abs(spatial.ring_area(xs, ys))
    parts = 0.0
    for _, _, rs, _ in spatial.split_polygon([xs], [ys], cell, 0.0):
        parts += sum(abs(spatial.ring_area(x, y)) for x, y in rs)
    assert math.isclose(whole, parts, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=30, deadline=None)
@given(st.integers(3, 30), st.integers(0, 10_000))
def test_box_area_matches_grid_estimate(n, seed):
    xs, ys = _ring(n, seed)
    box = (5.0, -3.0, 9.0, 1.0)
    area, hit = spatial.polygon_box_area([xs], [ys], box)
    # reference: clip area equals whole area minus the parts outside, via a fine cell split
    inside = 0.0
    for cx, cy, rs, _ in spatial.split_polygon([xs], [ys], 1.0, 0.0):
        if 5 <= cx < 9 and -3 <= cy < 1:
            inside += sum(abs(spatial.ring_area(x, y)) for x, y in rs)
    assert math.isclose(area, inside, rel_tol=1e-9, abs_tol=1e-9)


def test_mercator_roundtrip_and_value(spark):
    df = spark.createDataFrame([(10.0, 55.0)], "lon double, lat double")
    r = df.select(geo.mercator_x("lon").alias("x"), geo.mercator_y("lat").alias("y")).first()
    assert abs(r.x - 1113194.9079327357) < 1e-6
    assert abs(r.y - 7361866.113051185) < 1e-4
    back = df.select(geo.inverse_mercator_lon(geo.mercator_x("lon")).alias("lon"),
                     geo.inverse_mercator_lat(geo.mercator_y("lat")).alias("lat")).first()
    assert abs(back.lon - 10.0) < 1e-12 and abs(back.lat - 55.0) < 1e-12


def test_utm_central_meridian_and_known_point(spark):
    df = spark.createDataFrame([(3.0, 0.0, 32631), (12.0, 55.0, 32633), (-75.0, -33.0, 32718)],
                               "lon double, lat double, epsg int")
    u = geo.utm("lon", "lat", "epsg")
    rows = df.select(u["x"].alias("x"), u["y"].alias("y")).collect()
    assert abs(rows[0].x - 500000.0) < 1e-6 and abs(rows[0].y) < 1e-6
    # 12E is 3 degrees west of the zone-33 meridian (15E): easting below 500 km, symmetric in lon
    assert 300000 < rows[1].x < 500000 and 6090000 < rows[1].y < 6100000
    assert abs(rows[2].x - 500000.0) < 1e-6 and 6340000 < rows[2].y < 6350000


def test_materialised_tables_replace_per_scene(spark, scratch):
    import os
    from trackscene.operators import tables_build as tbl
    ais, sc = fx.ais(spark, SF_SMALL), fx.scenes(spark, SF_SMALL)
    cpath, ppath = os.path.join(scratch, "closest"), os.path.join(scratch, "pred")
    closest = tbl.build_closest_table(ais, sc, cpath, fx.HALF_WINDOW_MIN)
    assert closest.count() == 324  # FIXTURES.md: closest rows at sf0.001
    pred = tbl.build_predictions_table(spark, cpath, ppath, digits=6)
    assert pred.count() == 76
    # rerun two scenes only: their partitions are replaced, nothing duplicates
    tbl.build_closest_table(ais, sc.where("api_id IN ('S2_1', 'S2_2')"), cpath, fx.HALF_WINDOW_MIN)
    assert spark.read.parquet(cpath).count() == 324
    tbl.build_predictions_table(spark, cpath, ppath, digits=6)
    assert spark.read.parquet(ppath).count() == 76
