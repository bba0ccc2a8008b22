"""Operator behaviours without a registered query twin (A6, A11 all-of, K1 variants, E1 duplicates)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackscene.operators import archives, quality, records
from trackscene.operators.match import index_scenes


def test_require_unique_and_dedupe(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "api_id string, v int")
    with pytest.raises(ValueError):
        records.require_unique(df, ["api_id"])
    assert records.require_unique(df.where("v < 3"), ["api_id"]).count() == 2
    assert records.dedupe_on_key(df, ["api_id"]).count() == 2
    assert [tuple(r) for r in records.duplicate_keys(df, ["api_id"]).collect()] == [("a", 2)]


def test_skip_existing_requires_all_outputs(spark):
    cand = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "base string")
    existing = spark.createDataFrame([("p1", "p1.tif"), ("p1", "p1_TCI.tif"), ("p2", "p2.tif")],
                                     "base string, key string")
    left = archives.skip_existing_all(cand, existing, "base", "key", required=2)
    assert sorted(r.base for r in left.collect()) == ["p2", "p3"]  # p2 lacks its companion
    left1 = archives.skip_existing(cand, existing.select(F.col("base").alias("b")), "base", "b")
    assert sorted(r.base for r in left1.collect()) == ["p3"]


def test_index_scenes_duplicates_multiply(spark):
    idx = spark.createDataFrame([(1, "S2_A.zip"), (2, "S2_A.zip"), (3, "S2_B.zip"), (4, "x")],
                                "id int, file_name string")
    meta = spark.createDataFrame([("S2_A", 1.0), ("S2_B", 2.0)], "api_id string, cloud_cover double")
    got = sorted((r.id, r.api_id) for r in index_scenes(idx, meta).collect())
    assert got == [(1, "S2_A"), (2, "S2_A"), (3, "S2_B")]


def _report_inputs(spark):
    pairs = spark.createDataFrame([("Cargo", "Cargo/a.tif", "img/Cargo/a.tif", "img/Cargo/a_TCI.tif"),
                                   ("Cargo", "Cargo/b.tif", "img/Cargo/b.tif", None)],
                                  "class string, base_key string, merged_key string, tci_key string")
    bright = [[250.0] * 4, [250.0] * 4, [250.0] * 4]      # all pixels bright -> ratio 1
    flat = [[0.5] * 4, [0.5] * 4, [0.5] * 4, [0.5] * 4]   # flat bands scale to 0 -> ratio 0
    merged = spark.createDataFrame([("img/Cargo/a.tif", flat), ("img/Cargo/b.tif", flat)],
                                   "key string, bands array<array<double>>")
    tci = spark.createDataFrame([("img/Cargo/a_TCI.tif", bright)], "key string, bands array<array<double>>")
    return pairs, merged, tci


def test_cloud_report_actions_and_dry_run(spark):
    pairs, merged, tci = _report_inputs(spark)
    rep = {r.merged_key: r for r in quality.cloud_report(pairs, merged, tci, "img", "cloudy").collect()}
    a, b = rep["img/Cargo/a.tif"], rep["img/Cargo/b.tif"]
    assert (a.mode, a.cloud_ratio, a.action) == ("TCI", "1.0000", "MOVE")
    assert (a.dst_merged, a.dst_tci) == ("cloudy/Cargo/a.tif", "cloudy/Cargo/a_TCI.tif")
    assert (b.mode, b.cloud_ratio, b.action, b.tci_key, b.dst_merged) == ("MULTIBAND", "0.0000", "KEEP", "", "")
    dry = {r.merged_key: r for r in quality.cloud_report(pairs, merged, tci, "img", "cloudy", dry_run=True,
                                                         action="DELETE").collect()}
    assert (dry["img/Cargo/a.tif"].action, dry["img/Cargo/a.tif"].dst_merged) == ("WOULD_DELETE", "")
    with pytest.raises(ValueError):
        quality.cloud_report(pairs, merged, tci, "img", "cloudy", action="SHRED")
    s = quality.cloud_summary(quality.cloud_report(pairs, merged, tci, "img", "cloudy")).first()
    assert (s.total, s.examined, s.cloudy, s.cloudy_share) == (2, 2, 1, 0.5)


def test_checkpoint_dir_and_lineage_cut(spark):
    import os
    from trackscene.session import checkpoint_dir, cut_lineage
    configured = spark.conf.get("spark.checkpoint.dir", None)
    d = checkpoint_dir(spark)
    if configured:
        assert d == configured  # a deployment's shared folder is used as is
    assert checkpoint_dir(spark) == d and os.path.isdir(d)
    df = spark.range(100).selectExpr("id", "id * 2 AS v")
    cut = cut_lineage(df)
    assert cut.count() == 100 and cut.agg({"v": "sum"}).first()[0] == 9900
    assert os.listdir(d)  # the reliable checkpoint was written there
    assert "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()  # lineage is cut


def test_stac_pages_with_odd_values(spark):
    from trackscene.operators.records import read_stac
    page = '{"features": [%s]}'
    ok = '{"id": "A", "properties": {"datetime": "2024-01-02T03:04:05.5Z", "eo:cloud_cover": 7, "proj:epsg": "no number"}, "geometry": null, "bbox": [1, 2.5]}'
    rows = [(1, page % ok), (2, None), (3, "{"), (4, '{"features": 5}'), (5, page % '{"id": "B", "properties": {"datetime": "soon"}}, 7, {"id": 9}'), (6, page % ""), (7, "[1]")]
    features, rejects = read_stac(spark.createDataFrame(rows, "page long, json string"))
    f = features.collect()
    assert [(r["api_id"], str(r["datetime"]), r["cloud_cover"], r["proj_epsg"], r["bbox"]) for r in f] == [("A", "2024-01-02 03:04:05.500000", 7.0, None, "[1.0, 2.5]")]
    assert sorted(map(tuple, rejects.collect()), key=str) == [(2, None, "no JSON"), (3, None, "no JSON"), (4, None, "no features"), (5, 0, "bad datetime"), (7, None, "no features")]
    empty, none = read_stac(spark.createDataFrame([], "page long, json string"))
    assert empty.count() == none.count() == 0


def test_augmentation_is_a_function_of_key_seed_and_epoch(spark):
    from pyspark.sql import functions as F

    from trackscene.operators import raster as ra
    df = spark.createDataFrame([(i, [float(v) for v in range(12)]) for i in range(400)] + [(400, None)], "id long, px array<double>")
    a = {r["id"]: r for r in ra.augment_plan(ra.augment(df, "px", 1, 3, 4, 7, 0), "id", 7, 0).collect()}
    assert a[400]["augmented"] is None
    b = {r["id"]: r["augmented"] for r in ra.augment(df.repartition(5), "px", 1, 3, 4, 7, 0).collect()}
    assert b == {k: r["augmented"] for k, r in a.items()}
    other = {r["id"]: r["augmented"] for r in ra.augment(df, "px", 1, 3, 4, 7, 1).collect()}
    assert sum(other[i] != b[i] for i in range(400)) > 200
    for r in a.values():
        p = r["plan"]
        if r["augmented"] is not None:
            x = np.arange(12.0).reshape(3, 4)
            x = np.fliplr(x) if p["across"] else x
            x = np.flipud(x) if p["down"] else x
            x = np.rot90(x, p["turns"]).ravel()
            np.testing.assert_allclose(r["augmented"], np.maximum(x * p["scale"] + p["shift"], 0) if p["shade"] else x)
    for part, share in (("across", .5), ("down", .5), ("shade", .5)):
        assert abs(sum(r["plan"][part] for r in a.values()) / 401 - share) < 0.08
    assert {r["plan"]["turns"] for r in a.values()} == {0, 1, 2, 3}
    u = [r[0] for r in df.select(ra.draw("id", 1, 2, 3)).collect()]
    assert 0 <= min(u) < 0.02 and 0.98 < max(u) < 1 and df.select(F.countDistinct(ra.draw("id", 1, 2, 3))).first()[0] == 401
