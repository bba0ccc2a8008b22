"""Cases in which an operator once gave a wrong answer or lost data."""
import numpy as np
import pytest

from trackscene.functions import text
from trackscene.operators import match, quality, raster


def test_images_without_pixels_are_never_acted_on(spark):
    pairs = spark.createDataFrame([("c", "a", "a", None), ("c", "b", "b", "b_tci"), ("c", "d", "d", "d_tci")],
                                  "class string, base_key string, merged_key string, tci_key string")
    bright = [[1.0] * 4, [1.0] * 4, [1.0] * 4]
    tci = spark.createDataFrame([("d_tci", bright)], "key string, bands array<array<double>>")
    merged = spark.createDataFrame([], "key string, bands array<array<double>>")
    r = quality.cloud_report(pairs, merged, tci, "in", "cloudy", action="DELETE")
    got = {x["merged_key"]: (x["action"], x["dst_merged"], x["mode"]) for x in r.collect()}
    assert got == {"in/a": ("ERROR", "", "MULTIBAND"), "in/b": ("ERROR", "", "TCI"), "in/d": ("DELETE", "cloudy/d", "TCI")}
    s = quality.cloud_summary(r).first()
    assert (s["total"], s["examined"], s["cloudy"], s["cloudy_share"]) == (3, 1, 1, 1.0)


def test_no_pixels_cross_the_report_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = spark.createDataFrame([("c", "a", "a", None), ("c", "b", "b", "b_tci")], "class string, base_key string, merged_key string, tci_key string")
        images = spark.createDataFrame([("a", [[1.0]])], "key string, bands array<array<double>>")
        r = quality.cloud_report(pairs, images, images, "in", "cloudy")
        plan = r._jdf.queryExecution().optimizedPlan().toString()
        joins = [x for x in plan.splitlines() if "Join LeftOuter" in x]
        assert len(joins) == 2
        for side in plan.split("Join LeftOuter")[1:]:
            assert "_ratio" in side.splitlines()[0] or "_r" in side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kind", ["double", "float", "int"])
def test_patches_keep_the_pixel_type(spark, kind):
    values = [0.25, 0.5, 0.75, 1.0] if kind != "int" else [1, 2, 3, 4]
    tiles = spark.createDataFrame([("s", "B02", 0, 0, 2, 2, values)],
                                  f"api_id string, band string, tile_row long, tile_col long, tile_h int, tile_w int, pixels array<{kind}>")
    windows = spark.createDataFrame([(1, "s", 0, 0), (2, "s", 1, 1), (3, "s", 50, 50), (4, "none", 0, 0)], "id long, api_id string, row0 long, col0 long")
    got = {r["id"]: r["bands"][0] for r in raster.extract_patches(windows, tiles, size=2, tile=2, bands=("B02",)).collect()}
    assert got == {1: values, 2: [values[3], 0, 0, 0], 3: [0] * 4, 4: [0] * 4}


def test_whole_tiles_are_never_broadcast(spark):
    tiles = spark.range(3).selectExpr("'s' AS api_id", "'B02' AS band", "id AS tile_row", "id AS tile_col", "2 AS tile_h", "2 AS tile_w",
                                      "array(1, 2, 3, 4) AS pixels")
    windows = spark.range(2).selectExpr("id", "'s' AS api_id", "id AS row0", "id AS col0")
    df = raster.extract_patches(windows, tiles, size=2, tile=2, bands=("B02",))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for i, line in enumerate(plan.splitlines()):
        if "BroadcastExchange" in line:
            below = plan.splitlines()[i + 1:i + 3]
            assert not any("pixels" in x for x in below), below


def test_product_ids(spark):
    index = spark.createDataFrame([("X.SAFE.zip",), ("X.zip",), ("X.SAFE",), ("X",), ("Y",)], "file_name string")
    scenes = spark.createDataFrame([("X",)], "api_id string")
    assert match.index_scenes(index, scenes).count() == 4


def test_bbox_parts(spark):
    rows = [("[1.5, -2, 3 ,4e1]", (1.5, -2.0, 3.0, 40.0)), ("[1, 2, 3]", (1.0, 2.0, None, None)), ("none", (None,) * 4), (None, (None,) * 4),
            ("[a, 2, 3, 4]", (None, 2.0, 3.0, 4.0)), ("[1,2,3,4", (1.0, 2.0, 3.0, None))]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string").coalesce(1)
    b = text.parse_bbox("t")
    got = [tuple(r) for r in df.select(*[b[k].alias(k) for k in b]).collect()]
    assert got == [w for _, w in rows]


def test_band_scaling_of_all_bands_at_once():
    rng = np.random.default_rng(0)
    bands = [rng.random(50), np.full(50, 3.0), np.concatenate([np.zeros(49), [7.0]]), np.array([np.nan, np.inf, *range(48)])]
    y = quality.scale_bands_np(bands)
    assert (y[1] == 0).all() and y[2][-1] > 0.99 and (y[2][:-1] == 0).all()
    lo, hi = np.percentile(bands[0], [2, 98])
    assert np.allclose(y[0], np.clip((bands[0] - lo) / (hi - lo + 1e-6), 0, 1)) and np.isfinite(y).all()


def test_unreadable_archives_are_rejected(spark, scratch):
    import os
    import zipfile

    from trackscene.sources import positions
    head = ",".join(f'"{n}"' for n, _ in positions.POSITION_COLUMNS)
    row = ["01/01/2024 10:00:00"] + [""] * (len(positions.POSITION_COLUMNS) - 1)
    with zipfile.ZipFile(os.path.join(scratch, "good.zip"), "w") as z:
        z.writestr("a.csv", head + "\n" + ",".join(row) + "\n")
    with open(os.path.join(scratch, "broken.zip"), "wb") as f:
        f.write(b"this is no archive")
    rows, rejects = positions.read_folder_tolerant(spark, scratch)
    assert rows.count() == 1
    assert [os.path.basename(r["source"]) for r in rejects.collect()] == ["broken.zip"]


def test_null_pixels_are_left_out(spark):
    df = spark.createDataFrame([([[1.0, None, 3.0], [5.0, 5.0, 5.0]],)], "bands array<array<double>>")
    got = {r["band"]: (r["low"], r["high"]) for r in quality.percentile_stats(df).collect()}
    assert got[0] == (1.04, 2.96) and got[1] == (5.0, 5.001)


def test_codes_without_a_zone_give_no_position(spark):
    from trackscene.functions import geo
    df = spark.createDataFrame([(9.0, 55.0, 32632), (9.0, 55.0, 4326)], "lon double, lat double, epsg int")
    got = [tuple(r) for r in geo.with_utm(df, "lon", "lat", "epsg", "x", "y").select("x", "y").collect()]
    assert abs(got[0][0] - 500000) < 1e-6 and got[1] == (None, None)


def test_bounds_on_time_change_no_match(spark):
    scenes = spark.sql("SELECT 's' AS api_id, timestamp_ntz'2024-01-05 10:00:00' AS sensing_time, 0d AS xmin, 0d AS ymin, 2d AS xmax, 2d AS ymax")
    pos = spark.range(600).selectExpr("id", "id % 7 AS mmsi", "timestamp_ntz'2024-01-05 08:00:00' + make_dt_interval(0, 0, cast(id as int), 0) AS ts", "1d AS lon", "1d AS lat")
    a = match.match_window(pos, scenes, 30)
    b = match.match_window(pos, scenes, 30, between=match.scene_time_range(scenes))
    assert a.count() == 61 and sorted(a.collect()) == sorted(b.collect())
    none = scenes.limit(0)
    assert match.match_window(pos, none, 30, between=match.scene_time_range(none)).count() == 0


def test_archive_filter_keeps_every_month_of_its_range(spark, scratch):
    from trackscene.plans import registry
    registry.load_all()
    # days 2023-10-01 + key: a month archive before the range, two that reach it, day archives inside and after it, one day twice
    keys = [0, 92, 130, 152, 183, 214, 244, 244, 250]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{scratch}/orders.parquet")
    got = sorted(r["key"] for r in registry.QUERIES["archive_filter"](spark, scratch).collect())
    assert got == ["raw/ais/aisdk-2024-01.zip", "raw/ais/aisdk-2024-02.zip", "raw/ais/aisdk-2024-03-01.zip", "raw/ais/aisdk-2024-04-01.zip",
                   "raw/ais/aisdk-2024-05-02.zip"]
