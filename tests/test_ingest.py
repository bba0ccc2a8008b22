"""Split CSV files, archives by member, ids over several loads, replayed streams."""
import os
import random
import re
import zipfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackscene.operators.prefix import reserve_ids, running_total, with_row_id
from trackscene.sources import archive_source as ar
from trackscene.sources import csv_records as cr
from trackscene.sources import positions as ps
from trackscene.streaming.incremental import ingest_new_positions

from .test_sources import HEADER, _row, _write, _zip

FIELD = st.one_of(st.sampled_from(["", '""', '"a,b"', '"two\nlines"', '"say ""x"""', '"\n\n"', '",\n"""', "plain", "ü", '"\r\n"']), st.from_regex(r"[a-z0-9 ]{0,5}", fullmatch=True))


def _plain_records(raw: bytes) -> list[tuple[int, str]]:
    """One character after another: a newline outside quotes ends a record; the header is left out."""
    out, cur, inside = [], bytearray(), False
    for b in raw:
        if b == 0x22:
            inside = not inside
        if b == 0x0A and not inside:
            out.append(bytes(cur))
            cur = bytearray()
        else:
            cur.append(b)
    if cur:
        out.append(bytes(cur))
    text = [(i, r.decode().rstrip("\r\n")) for i, r in enumerate(out) if i]
    return [(i, r) for i, r in text if r]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.lists(FIELD, min_size=3, max_size=3), max_size=12), size=st.sampled_from([1, 2, 3, 7, 64]), eol=st.sampled_from(["\n", "\r\n"]), last=st.booleans())
def test_ranges_give_the_records_of_a_plain_reader(spark, tmp_path_factory, rows, size, eol, last):
    raw = eol.join(["h1,h2,h3", *map(",".join, rows)]).encode() + (eol.encode() if last else b"")
    p = str(tmp_path_factory.mktemp("csv") / "f.csv")
    with open(p, "wb") as f:
        f.write(raw)
    got = sorted((r["record_no"], r["record"]) for r in cr.csv_records(cr.files(spark, p), size).collect())
    assert got == _plain_records(raw)


def test_split_reader_equals_the_multi_line_reader(spark, scratch):
    rng = random.Random(1)
    names = ['""', "", '"x, y"', '"two\nlines"', '"three\n\nlines, ""quoted"""', "plain", '"é\n"']
    rows = [_row(f"0{1 + i % 9}/01/2024 00:00:{i % 60:02d}", i, 55 + i / 1000, 10, name=rng.choice(names), eta=rng.choice(names)) for i in range(3000)]
    _write(os.path.join(scratch, "a.csv"), rows[:2900])
    _write(os.path.join(scratch, "b.csv"), rows[2900:])
    whole = ps.read_positions_csv(spark, scratch, split=False)
    for size in (1 << 20, 5000, 137):
        cut = ps.read_positions_csv(spark, scratch, range_bytes=size)
        assert cut.columns == whole.columns and cut.count() == 3000
        assert cut.exceptAll(whole).count() == 0 and whole.exceptAll(cut).count() == 0
    split = ps.read_positions_csv(spark, os.path.join(scratch, "a.csv"), range_bytes=5000, keep_source=True)
    assert split.rdd.getNumPartitions() > 1
    assert sorted(r[0] for r in split.select("record_no").collect()) == list(range(1, 2901))
    order = [r["MMSI"] for r in split.orderBy("record_no").collect()]
    assert order == list(range(2900))  # record numbers follow the file


def test_reads_shorter_than_a_record(spark, scratch, monkeypatch):
    raw = b"h\n" + b"".join(b'"%s\n%d"\n' % (b"x" * 50, i) for i in range(20))
    p = os.path.join(scratch, "f.csv")
    with open(p, "wb") as f:
        f.write(raw)
    assert sorted((r["record_no"], r["record"]) for r in cr.csv_records(cr.files(spark, p), 33).collect()) == _plain_records(raw)
    got = b"".join(d.tobytes() for _, d in cr._reads(p, 3, 400, 7))
    assert got == raw[3:400]


def test_empty_and_bad_files(spark, scratch):
    for name, raw in (("empty.csv", b""), ("header.csv", b"h1,h2"), ("header2.csv", b"h1,h2\n"), ("latin.csv", b"h\n\xe9x\n"), ("blank.csv", b"h\n\n\na\n")):
        with open(os.path.join(scratch, name), "wb") as f:
            f.write(raw)
    got = {(os.path.basename(r["path"]), r["record_no"], r["record"]) for r in cr.csv_records(cr.files(spark, scratch)).collect()}
    assert got == {("latin.csv", 1, "�x"), ("blank.csv", 3, "a")}


# ------------------------------------------------------------------ archives
def _plan_text(df):
    return df._jdf.queryExecution().toString()


def test_archive_members_are_partitions(spark, scratch):
    for k in range(2):
        _zip(os.path.join(scratch, f"a{k}.zip"), {f"m{i}.csv": [_row("01/01/2024 00:00:01", 10 * k + i, 55.0, 10.0)] for i in range(5)} | {"readme.txt": ["x"]})
    os.makedirs(os.path.join(scratch, "_hidden"))
    _zip(os.path.join(scratch, "_hidden", "h.zip"), {"m.csv": [_row("01/01/2024 00:00:01", 99, 55.0, 10.0)]})
    raw = ps.archive_records(spark, scratch)
    assert raw.rdd.getNumPartitions() == 10 and "content" not in _plan_text(raw) and "zip_records" in _plan_text(raw)
    assert sorted(r["MMSI"] for r in ps.read_archives(spark, scratch).collect()) == [0, 1, 2, 3, 4, 10, 11, 12, 13, 14]
    assert ps.archive_records(spark, scratch, suffix=".none").count() == 0


def test_archive_of_three_gigabytes_is_read_by_ranges(spark, scratch):
    """A sparse file: 3 GB of nothing, then the members.  Reading it whole would take memory and minutes."""
    p = os.path.join(scratch, "S2A_BIG.SAFE.zip")
    with open(p, "wb") as f:
        f.seek(3 << 30)
        f.write(b"\0")
    with zipfile.ZipFile(p, "a", zipfile.ZIP_DEFLATED) as z:
        z.writestr("day.csv", HEADER + "\n" + _row("01/01/2024 00:00:01", 7, 55.0, 10.0) + "\n")
        z.writestr("S2A_BIG.SAFE/MTD_TL.xml", "<r><SENSING_TIME>2024-01-02T10:30:21Z</SENSING_TIME></r>")
    assert os.path.getsize(p) > 3 << 30
    assert [r["MMSI"] for r in ps.read_archives(spark, scratch).collect()] == [7]
    from trackscene.sources.scene_archives import index_scene_archives
    r = index_scene_archives(spark, scratch).collect()
    assert [(x["file_name"], str(x["sensing_time"])) for x in r] == [("S2A_BIG", "2024-01-02 10:30:21")]


def test_damaged_archives(spark, scratch):
    good, bad, cut = (os.path.join(scratch, n) for n in ("good.zip", "bad.zip", "cut.zip"))
    _zip(good, {"a.csv": [_row("01/01/2024 00:00:01", 1, 55.0, 10.0)]})
    with open(bad, "wb") as f:
        f.write(b"no archive at all")
    with zipfile.ZipFile(cut, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", HEADER + "\n" + "\n".join(_row("01/01/2024 00:00:01", i, 55.0, 10.0) for i in range(500)) + "\n")
    raw = bytearray(open(cut, "rb").read())
    raw[len(raw) // 3] ^= 0xFF
    with open(cut, "wb") as f:
        f.write(raw)
    with pytest.raises(Exception):
        ps.archive_records(spark, scratch).collect()
    rows = ps.archive_records(spark, scratch, tolerant=True).collect()
    assert {os.path.basename(r["path"]) for r in rows if r["record_no"] is None} == {"bad.zip", "cut.zip"}
    got, rejects = ps.read_folder_tolerant(spark, scratch)
    assert [r["MMSI"] for r in got.collect()] == [1]
    assert {os.path.basename(r["source"]) for r in rejects.collect()} == {"bad.zip", "cut.zip"}
    ids = with_row_id(got, ("_source", "member")).collect()
    assert [r["id"] for r in ids] == [r["record_no"] for r in ids] == [1]


# ------------------------------------------------------------------ ids
def test_running_total_needs_no_single_task(spark):
    rng = random.Random(3)
    rows = [(f"f{i % 50:02d}", i, rng.randrange(100)) for i in range(2000)]
    df = spark.createDataFrame(rows, "f string, i long, n long").repartition(7)
    got, total = running_total(df, ["f", "i"], "n", "before")
    want, run = {}, 0
    for f, i, n in sorted(rows):
        want[f, i], run = run, run + n
    assert {(r["f"], r["i"]): r["before"] for r in got.collect()} == want and total == run
    for w in re.findall(r"windowspecdefinition\(([^)]*)", _plan_text(got)):
        assert "_range" in w  # every window has a partition key
    empty, none = running_total(df.where("n < 0"), ["f", "i"], "n", "before")
    assert empty.count() == 0 and none == 0


def test_ids_go_on_over_loads_and_repeat(spark, scratch):
    marks = os.path.join(scratch, "marks")
    for k in range(3):
        os.makedirs(os.path.join(scratch, f"load{k}"))
        for j in range(2):
            _write(os.path.join(scratch, f"load{k}", f"{j}.csv"), [_row("01/01/2024 00:00:01", 100 * k + 10 * j + i, 55.0, 10.0, name='"a\nb"') for i in range(5)])

    def ids(k, load):
        df = ps.read_positions_csv(spark, os.path.join(scratch, f"load{k}"), keep_source=True, range_bytes=200)
        return {r["MMSI"]: r["id"] for r in with_row_id(df, ("path",), marks=marks, load=load).select("MMSI", "id").collect()}

    first, second = ids(0, "a"), ids(1, "b")
    assert sorted(first.values()) == list(range(1, 11)) and sorted(second.values()) == list(range(11, 21))
    assert ids(0, "a") == first and sorted(ids(2, "c").values()) == list(range(21, 31)) and ids(1, "b") == second
    with pytest.raises(ValueError):
        reserve_ids(spark, marks, "a", 11)
    assert [first[m] for m in sorted(first)] == list(range(1, 11))  # in the order of files and records


def test_stream_replay_and_ids(spark, scratch):
    src, table, ckpt, marks = (os.path.join(scratch, n) for n in ("in", "table", "ckpt", "marks"))
    os.makedirs(src)
    run = lambda: ingest_new_positions(spark, src, table, checkpoint=ckpt, marks=marks, range_bytes=300)
    _write(os.path.join(src, "a.csv"), [_row("01/01/2024 00:00:01", i, 55.0, 10.0, name='"x\ny"') for i in range(9)])
    assert run() == 1 and run() == 0
    _write(os.path.join(src, "b.csv"), [_row("01/01/2024 00:00:01", 100 + i, 55.0, 10.0) for i in range(4)])
    assert run() == 1
    rows = lambda: sorted((r["MMSI"], r["id"], r["_epoch"]) for r in spark.read.parquet(table).collect())
    want = rows()
    assert [r[1] for r in want] == list(range(1, 14)) and {r[2] for r in want} == {0, 1}
    os.remove(os.path.join(ckpt, "commits", "1"))  # the last micro-batch was written but not committed: it is replayed
    crc = os.path.join(ckpt, "commits", ".1.crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert run() == 1 and rows() == want
    with pytest.raises(ValueError):  # a new checkpoint would number its epochs from 0 again
        ingest_new_positions(spark, src, table, checkpoint=ckpt + "-other")


def test_locate():
    assert ar.locate("file:/tmp/x.zip")[1] == "/tmp/x.zip" and ar.locate("file:///tmp/x.zip")[1] == "/tmp/x.zip" and ar.locate("/tmp/x.zip")[1] == "/tmp/x.zip"
