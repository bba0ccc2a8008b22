"""The hierarchical cover: same points as a plain test, few cells for an ocean, bounded batches."""
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackscene.functions.geo import box_ring
from trackscene.operators import spatial


def _ring(cx, cy, r, n, rng):
    a = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + r * rng.uniform(0.5, 1) * math.cos(t), cy + r * rng.uniform(0.5, 1) * math.sin(t)) for t in a]


def _inside(x, y, rings):
    odd = False
    for r in rings:
        for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1]):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def _polygons(spark, polys):
    rows = [(i, [[{"x": float(x), "y": float(y)} for x, y in r + r[:1]] for r in rings]) for i, rings in enumerate(polys)]
    return spark.createDataFrame(rows, "id long, rings array<array<struct<x:double,y:double>>>")


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(8)
    big = [(-30.0, -20.0), (31.5, -21.0), (33.0, 22.0), (0.5, 9.25), (-32.0, 20.0)]
    return [[big, [(2.0, -8.0), (12.0, -8.0), (12.0, 3.0), (2.0, 3.0)]], [_ring(40, 5, 9, 30, rng)], [_ring(38, 2, 6, 12, rng)], [[(16.0, 0.0), (20.0, 0.0), (20.0, 4.0), (16.0, 4.0)]]]


def test_points_equal_a_plain_test(spark, shapes):
    rng = random.Random(9)
    pts = [(rng.uniform(-40, 55), rng.uniform(-25, 25)) for _ in range(1500)]
    pts += [(x, y) for s in shapes for r in s for x, y in r] + [(2.0, 0.0), (7.0, -2.0), (16.0, 2.0), (20.0, 4.0), (20.0, 4.000001), (64.0, 0.0)]
    pts += [(float(x), float(y)) for x in range(-34, 36, 2) for y in range(-24, 25, 4)]  # on the borders of cells
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)] + [(9999, None, 1.0), (0, *pts[0])], "id long, lon double, lat double")
    want = sorted([i for i, p in enumerate(pts) if any(_inside(*p, s) for s in shapes)] + [0] * any(_inside(*pts[0], s) for s in shapes))
    for kw in ({}, {"salt": 3, "id_col": "id"}):
        got = spatial.points_in_polygons(df, _polygons(spark, shapes), **kw)
        assert got.columns == df.columns and sorted(r["id"] for r in got.collect()) == want
    assert spatial.points_in_polygons(df, _polygons(spark, []).limit(0)).count() == 0


def test_an_ocean_is_few_cells():
    rng = np.random.default_rng(1)
    top = [(x, 60 + rng.uniform(-1, 1)) for x in np.arange(170, -171, -1.0)]
    ring = [(-170.0, -60.0), (170.0, -60.0), *top]
    cells = list(spatial.cover_polygon([[x for x, _ in ring]], [[y for _, y in ring]], 1.0, 1e-3))
    assert len(cells) < 5000 < 40_000 < sum(1 for _ in spatial.split_polygon([[x for x, _ in ring]], [[y for _, y in ring]], 1.0, 1e-3))
    area = sum(spatial.COVER_FACTOR ** (2 * level) for level, _, _, rs, _ in cells if rs is None)
    assert {c[0] for c in cells} == {0, 1, 2} and area > 35_000


def test_pieces_leave_in_bounded_batches(spark, shapes, monkeypatch):
    seen = spatial.split_by_cell(_polygons(spark, shapes), 0.5)
    assert seen.count() == sum(1 for s in shapes for _ in spatial.split_polygon([[x for x, _ in r] for r in s], [[y for _, y in r] for r in s], 0.5, 5e-4))


def test_points_of_many_overlapping_boxes(spark):
    """Boxes that overlap leave few rows to test, and borders, holes and points that are none stay exact; one by one they took minutes."""
    n, m = 12_000, 20_000
    boxes = spark.range(n).selectExpr("id", "id * 13 % 840 / 40D AS xmin", "id * 11 % 601 / 40D AS ymin", "id * 13 % 840 / 40D + 0.75D + id % 3 / 4D AS xmax",
                                      "id * 11 % 601 / 40D + 0.5D AS ymax").where("xmin NOT BETWEEN 8 AND 12")
    rings = boxes.select(F.array(box_ring("xmin", "ymin", "xmax", "ymax")).alias("rings"))
    points = spark.range(m).selectExpr("id", "id * 7919 % 2400 / 100D AS lon", "id * 104729 % 1700 / 100D AS lat")
    odd = spark.createDataFrame([(m, float("nan"), 1.0), (m + 1, 1.0, float("nan")), (m + 2, None, 1.0), (0, 0.0, 0.0)], "id long, lon double, lat double")
    begun = time.monotonic()
    got = sorted(r["id"] for r in spatial.points_in_polygons(points.unionByName(odd), rings).collect())
    assert time.monotonic() - begun < 60
    b = np.array(boxes.select("xmin", "ymin", "xmax", "ymax").collect())
    want = [0] if ((b[:, 0] <= 0) & (b[:, 1] <= 0)).any() else []
    for r in points.collect():
        want += [r["id"]] * bool(((b[:, 0] <= r["lon"]) & (r["lon"] <= b[:, 2]) & (b[:, 1] <= r["lat"]) & (r["lat"] <= b[:, 3])).any())
    assert got == sorted(want) and 0.3 * m < len(got) < 0.95 * m
    assert spatial._semi_pieces(rings, 1.0, "rings").where("_px0 IS NOT NULL").count() < 2 * n


def test_boxes_and_other_polygons_together(spark, shapes):
    rng = random.Random(10)
    square = lambda x, y, w, h: [[(x, y), (x + w, y), (x + w, y + h), (x, y + h)]]
    mixed = [*shapes, square(-40.0, -24.0, 5.5, 3.0), square(44.25, -20.0, 0.5, 40.0), square(50.0, 10.0, 2.0, 0.0), square(45.0, 0.0, 3.0, 3.0)]
    pts = [(rng.randint(-170, 220) / 4, rng.randint(-100, 100) / 4) for _ in range(1500)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id long, lon double, lat double")
    got = sorted(r["id"] for r in spatial.points_in_polygons(df, _polygons(spark, mixed)).collect())
    assert got == [i for i, p in enumerate(pts) if any(_inside(*p, s) for s in mixed)]
