"""Scenes on water: every kind of polygon gives the areas of a plain clip, and many boxes meet in time."""
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackscene.functions.geo import EARTH_RADIUS_M, box_ring, mercator_x, mercator_y, rings_to_mercator
from trackscene.operators import spatial

SIDE = 100_000.0


def _merc(x, y):
    return EARTH_RADIUS_M * math.radians(x), EARTH_RADIUS_M * math.log(math.tan(math.pi / 4 + math.radians(y) / 2))


def _polygons(spark, polys):
    rows = [(i, [[{"x": float(x), "y": float(y)} for x, y in [*r, r[0]]] for r in rings]) for i, rings in polys]
    return spark.createDataFrame(rows, "id long, rings array<array<struct<x:double,y:double>>>")


def _box(x0, y0, x1, y1):
    (a, b), (c, d) = _merc(x0, y0), _merc(x1, y1)
    return [(a, b), (c, b), (c, d), (a, d)]


@pytest.fixture(scope="module")
def water():
    rng = random.Random(5)
    polys = [(i, [_box(x := rng.randint(0, 30) / 4, y := rng.randint(0, 20) / 4, x + rng.randint(1, 9) / 4, y + rng.randint(1, 9) / 4)]) for i in range(40)]
    polys += [(100, [_box(-2, -2, 12, 12), _box(1, 1, 3, 3)]), (101, [[_merc(0, 0), _merc(7, 1), _merc(2, 6)]]),
              (102, [_box(2, 2, 3, 3)[::-1]]), (103, [_box(4, 4, 4, 6)]), (7, [_box(0, 0, 1, 1)]), (7, [_box(0, 0, 1, 1)])]
    return [*polys, (104, [[_merc(5 + (3 + math.cos(9 * t)) * math.cos(t), 4 + 3 * math.sin(t)) for t in np.linspace(0, 6.2, 90)]])]


@pytest.fixture(scope="module")
def boxes():
    rng = random.Random(6)
    got = [(f"s{i}", x := rng.randint(0, 24) / 4, y := rng.randint(0, 16) / 4, x + 4.0, y + 3.0) for i in range(15)]
    return [*got, ("s3", 0.0, 0.0, 4.0, 4.0), (None, 1.0, 1.0, 2.0, 2.0), (None, 1.5, 1.0, 2.0, 2.0), ("hole", 1.25, 1.25, 2.75, 2.75),
            ("far", 50.0, 50.0, 51.0, 51.0), ("none", None, 0.0, 1.0, 1.0), ("turned", 4.0, 3.0, 0.0, 0.0)]


def _want(spark, boxes, water):
    """(scene key, water key) -> area, by clipping every piece to every box."""
    merc = {(r["x"], r["y"]): (r["mx"], r["my"]) for r in spark.createDataFrame(sorted({(float(x), float(y)) for b in boxes if None not in b[1:]
            for x, y in ((b[1], b[2]), (b[3], b[4]))}), "x double, y double").select("x", "y", mercator_x("x").alias("mx"), mercator_y("y").alias("my")).collect()}
    want = {}
    for k, *b in boxes:
        if None in b:
            continue
        box = (*merc[b[0], b[1]], *merc[b[2], b[3]])
        for i, rings in water:
            closed = [np.array([*r, r[0]]) for r in rings]
            for _, _, rs, _ in spatial.split_polygon([r[:, 0] for r in closed], [r[:, 1] for r in closed], SIDE, 0.0):
                area, hit = spatial.polygon_box_area([x for x, _ in rs], [y for _, y in rs], box)
                if hit:
                    want[k, i] = want.get((k, i), 0.0) + area
    return want


SCENES = "api_id string, xmin double, ymin double, xmax double, ymax double"


def test_areas_equal_a_plain_clip(spark, boxes, water):
    want = _want(spark, boxes, water)
    rows = spatial.scenes_on_water(spark.createDataFrame(boxes, SCENES), _polygons(spark, water)).collect()
    got = {(r["api_id"], r["id"]): r["area"] for r in rows}
    assert len(got) == len(rows) and got.keys() == want.keys() and any(v == 0 for v in want.values())
    for pair, area in want.items():
        assert math.isclose(got[pair], area, rel_tol=1e-9, abs_tol=1e-2), (pair, got[pair], area)
        assert (got[pair] == 0) == (area == 0), pair
    sums = {}
    for (k, _), area in want.items():
        sums[k] = sums.get(k, 0.0) + area
    got = spatial.water_area(spark.createDataFrame(boxes, SCENES), _polygons(spark, water)).collect()
    assert sorted(str(r["api_id"]) for r in got) == sorted(str(b[0]) for b in boxes)
    for r in got:
        k, a = r["api_id"], r["water_area"]
        assert (a is None and (k is None or k not in sums)) or math.isclose(a, sums[k], rel_tol=1e-9), r


def test_many_boxes_meet_in_time(spark):
    """Scenes and boxes of water are compared without a clip for each pair: 2.25 million candidates took minutes."""
    n = 1500
    scenes = spark.range(n).selectExpr("concat('s', id) AS api_id", "id % 64 / 4D AS xmin", "id * 7 % 48 / 4D AS ymin", "id % 64 / 4D + 4 AS xmax", "id * 7 % 48 / 4D + 3 AS ymax")
    seas = spark.range(n).selectExpr("id", "id * 13 % 84 / 4D AS xmin", "id * 11 % 60 / 4D AS ymin", "id * 13 % 84 / 4D + 0.75D AS xmax", "id * 11 % 60 / 4D + 0.5D AS ymax")
    polys = seas.select("id", rings_to_mercator(F.array(box_ring("xmin", "ymin", "xmax", "ymax"))).alias("rings"))
    begun = time.monotonic()
    touching, rest = (spatial.scenes_on_water(scenes, polys).groupBy().agg(F.count_if(F.col("area") == 0), F.count_if(F.col("area") > 0)).first())
    assert time.monotonic() - begun < 60
    k = np.arange(n)
    x, y, u, v = k % 64 / 4, k * 7 % 48 / 4, k * 13 % 84 / 4, k * 11 % 60 / 4
    meet = [(a <= c[:, None] + w) & (a + z >= c[:, None]) for a, c, w, z in ((x, u, 0.75, 4), (y, v, 0.5, 3))]
    over = [(a < c[:, None] + w) & (a + z > c[:, None]) for a, c, w, z in ((x, u, 0.75, 4), (y, v, 0.5, 3))]
    assert rest == (over[0] & over[1]).sum() and touching + rest == (meet[0] & meet[1]).sum()


def test_scene_select_of_many_scenes_in_time(spark, scratch):
    import __spark_entry__ as E
    import duckdb
    from trackscene.plans.check import rows_hash
    spark.range(1500).selectExpr("id * 7 + id % 3 AS s_suppkey").coalesce(1).write.parquet(f"{scratch}/supplier.parquet")
    begun = time.monotonic()
    rows = E.queries()["scene_select"](spark, scratch).collect()
    assert time.monotonic() - begun < 60
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW supplier AS SELECT * FROM read_parquet('{scratch}/supplier.parquet/*.parquet')")
        cur = con.execute(E.oracle_sql()["scene_select"])
        names, want = [c[0] for c in cur.description], cur.fetchall()
    assert len(rows) > 500 and rows_hash(rows[0].__fields__, [tuple(r) for r in rows]) == rows_hash(names, want)


def test_a_filter_makes_the_rings_of_water_once(spark):
    """Each ring was made anew for every corner that the test for boxes reads, which made plans slow to prepare."""
    seas = spark.range(50).selectExpr("id", "id % 7 / 4D AS xmin", "id % 5 / 4D AS ymin", "id % 7 / 4D + 1 AS xmax", "id % 5 / 4D + 1 AS ymax")
    polys = seas.select("id", rings_to_mercator(F.array(box_ring("xmin", "ymin", "xmax", "ymax"))).alias("rings"))
    plan = spatial._with_bounds(polys, "rings").where("_rect")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("TAN(") <= 4


def test_scene_select_measures_clear_scenes_only(spark, scratch):
    import __spark_entry__ as E
    spark.range(40).selectExpr("id AS s_suppkey").coalesce(1).write.parquet(f"{scratch}/supplier.parquet")
    plan = E.queries()["scene_select"](spark, scratch)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("< 5.0)") >= 3  # of the scenes returned, of those that meet boxes and of those that meet other water
