"""File sources and sinks, written to a fresh scratch folder per test."""

import os
import zipfile

import pytest

from trackscene.sources import positions as ps
from trackscene.sources import scene_archives as sa
from trackscene.sources import tables as tb
from trackscene.streaming.incremental import ingest_new_positions

HEADER = ",".join(n for n, _ in ps.POSITION_COLUMNS)


def _row(ts, mmsi, lat, lon, name="", ship="Cargo", eta=""):
    vals = [ts, "Class A", str(mmsi), str(lat), str(lon), "Under way", "", "10.5", "", "", "", "", name, ship,
            "", "", "", "", "", "", eta, "AIS", "", "", "", ""]
    return ",".join(vals)


def _write(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "\n" + "\n".join(rows) + "\n")


def test_read_positions_csv_copy_rules(spark, scratch):
    p = os.path.join(scratch, "a.csv")
    _write(p, [_row("31/12/2023 23:59:59", 211, 55.1, 10.2, name='""'),
               _row("2024-01-02 03:04:05", 212, 55.2, 10.3, name=""),
               _row("2024-01-02T03:04:05", 213, 55.3, 10.4, name='"x, y"')])
    rows = {r["MMSI"]: r for r in ps.read_positions_csv(spark, p).collect()}
    assert str(rows[211]["# Timestamp"]) == "2023-12-31 23:59:59"
    assert str(rows[212]["# Timestamp"]) == "2024-01-02 03:04:05"
    assert str(rows[213]["# Timestamp"]) == "2024-01-02 03:04:05"
    assert rows[211]["Name"] == ""          # quoted empty stays ''
    assert rows[212]["Name"] is None        # unquoted empty is NULL
    assert rows[213]["Name"] == "x, y"
    assert rows[212]["ROT"] is None and rows[212]["SOG"] == 10.5


def test_read_positions_csv_fails_on_bad_value(spark, scratch):
    p = os.path.join(scratch, "bad.csv")
    _write(p, [_row("31/12/2023 23:59:59", 211, 55.1, 10.2), _row("yesterday", 212, 55.2, 10.3)])
    with pytest.raises(Exception):
        ps.read_positions_csv(spark, p).collect()
    _write(p, [_row("31/12/2023 23:59:59", "notanumber", 55.1, 10.2)])
    with pytest.raises(Exception):
        ps.read_positions_csv(spark, p).collect()


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, rows in members.items():
            z.writestr(name, HEADER + "\n" + "\n".join(rows) + "\n")


def test_read_archives_members_ids_and_quoted_newline(spark, scratch):
    _zip(os.path.join(scratch, "aisdk-2024-01-01.zip"),
         {"aisdk-2024-01-01.csv": [_row("01/01/2024 00:00:01", 1, 55.0, 10.0),
                                   _row("01/01/2024 00:00:02", 2, 55.0, 10.0, name='"two\nlines"')],
          "readme.txt": ["ignored"], "UPPER.CSV": [_row("01/01/2024 00:00:03", 3, 55.0, 10.0)]})
    _zip(os.path.join(scratch, "aisdk-2024-01-02.zip"),
         {"aisdk-2024-01-02.csv": [_row("02/01/2024 00:00:01", 4, 55.0, 10.0)]})
    df = ps.read_archives(spark, scratch)
    got = {r["MMSI"]: r for r in df.collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert got[2]["Name"] == "two\nlines"
    sensitive = ps.read_archives(spark, scratch, case_insensitive=False)
    assert sorted(r["MMSI"] for r in sensitive.collect()) == [1, 2, 4]
    ids = ps.with_row_id(df).select("MMSI", "id").collect()
    assert len({r.id for r in ids}) == 4
    again = {r.MMSI: r.id for r in ps.with_row_id(ps.read_archives(spark, scratch)).select("MMSI", "id").collect()}
    assert again == {r.MMSI: r.id for r in ids}  # stable across reruns


def test_read_folder_tolerant_rejects_whole_files(spark, scratch):
    _write(os.path.join(scratch, "good.csv"), [_row("01/01/2024 00:00:01", 1, 55.0, 10.0)])
    _write(os.path.join(scratch, "bad.csv"), [_row("01/01/2024 00:00:01", 2, 55.0, 10.0),
                                              _row("01/01/2024 00:00:01", "x", 55.0, 10.0)])
    _zip(os.path.join(scratch, "z.zip"), {"a.csv": [_row("01/01/2024 00:00:01", 3, 55.0, 10.0)],
                                          "b.csv": [_row("bad time", 4, 55.0, 10.0)]})
    _zip(os.path.join(scratch, "ok.zip"), {"a.csv": [_row("01/01/2024 00:00:01", 5, 55.0, 10.0)]})
    rows, rejects = ps.read_folder_tolerant(spark, scratch)
    assert sorted(r["MMSI"] for r in rows.collect()) == [1, 5]
    assert sorted(os.path.basename(r.source) for r in rejects.collect()) == ["bad.csv", "z.zip"]


def test_index_scene_archives(spark, scratch):
    xml = "<root><General_Info><SENSING_TIME>2024-01-02T10:30:21.024Z</SENSING_TIME></General_Info></root>"
    with zipfile.ZipFile(os.path.join(scratch, "S2A_X.SAFE.zip"), "w") as z:
        z.writestr("S2A_X.SAFE/GRANULE/T/MTD_TL.xml", xml)
    with zipfile.ZipFile(os.path.join(scratch, "S2B_Y.SAFE.zip"), "w") as z:
        z.writestr("S2B_Y.SAFE/GRANULE/T/MTD_TL.xml", "<root><broken>")
    with zipfile.ZipFile(os.path.join(scratch, "S2C_Z.SAFE.zip"), "w") as z:
        z.writestr("S2C_Z.SAFE/other.xml", xml)
    got = {r.file_name: r.sensing_time for r in sa.index_scene_archives(spark, scratch).collect()}
    assert set(got) == {"S2A_X", "S2B_Y", "S2C_Z"}
    assert str(got["S2A_X"]).startswith("2024-01-02 10:30:21.024")
    assert got["S2B_Y"] is None and got["S2C_Z"] is None


def test_list_objects_and_training_filter(spark, scratch):
    from trackscene.operators.manifests import training_manifest
    root = os.path.join(scratch, "dataset")
    for rel in ["Cargo/a.tif", "Cargo/a_TCI.tif", "Sailing/b.TIFF", ".hidden/c.tif", "Fishing/d.json",
                ".ipynb_checkpoints/e.tif", "Misc/f.tif"]:
        full = os.path.join(root, rel)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "wb") as f:
            f.write(b"II*\x00")
    keys = sa.list_objects(spark, root)
    listed = sorted(r.key for r in keys.collect())
    assert "Cargo/a.tif" in listed and "Fishing/d.json" in listed
    assert not any(k.startswith(".") for k in listed)  # hidden paths never reach the listing
    m = {r.key: (r.label, r.label_idx) for r in training_manifest(keys, 4).collect()}
    assert m == {"Cargo/a.tif": ("CargoTanker", 0), "Sailing/b.TIFF": ("Leisure", 3)}


def test_write_table_load_modes_and_report(spark, scratch):
    df = spark.createDataFrame([("S2_1", 1), ("S2_2", 2)], "api_id string, v int")
    out = os.path.join(scratch, "t")
    tb.write_table(df, out)
    with pytest.raises(Exception):
        tb.write_table(df, out)
    tb.load(df, out, "append")
    assert spark.read.parquet(out).count() == 4
    p = os.path.join(scratch, "p")
    tb.load(df, p, "append", ["api_id"])
    tb.load(spark.createDataFrame([("S2_1", 9)], "api_id string, v int"), p, "replace", ["api_id"])
    assert sorted((r.api_id, r.v) for r in spark.read.parquet(p).collect()) == [("S2_1", 9), ("S2_2", 2)]
    rp = os.path.join(scratch, "report")
    tb.write_report(df, rp)
    back = tb.read_csv_inferred(spark, rp)
    assert sorted(r.v for r in back.collect()) == [1, 2] and dict(back.dtypes)["v"] == "int"


def test_incremental_ingest_processes_each_file_once(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    table = os.path.join(scratch, "table")
    ckpt = os.path.join(scratch, "ckpt")
    _write(os.path.join(src, "a.csv"), [_row("01/01/2024 00:00:01", 1, 55.0, 10.0)])
    _write(os.path.join(src, "b.csv"), [_row("01/01/2024 00:00:02", 2, 55.0, 10.0)])
    ingest_new_positions(spark, src, table, checkpoint=ckpt)
    assert spark.read.parquet(table).count() == 2
    ingest_new_positions(spark, src, table, checkpoint=ckpt)  # nothing new
    assert spark.read.parquet(table).count() == 2
    _write(os.path.join(src, "c.csv"), [_row("01/01/2024 00:00:03", 3, 55.0, 10.0)])
    ingest_new_positions(spark, src, table, checkpoint=ckpt)
    assert sorted(r["MMSI"] for r in spark.read.parquet(table).collect()) == [1, 2, 3]
