"""Nearest reports kept up to date by a stream equal the batch result; positions laid out by day are pruned while a query runs."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from trackscene.operators import match
from trackscene.streaming.nearest import add_changes, current_closest, follow_nearest

START = dt.datetime(2024, 1, 1, 10, 30)
POSITIONS = "id bigint, ts timestamp_ntz, mmsi bigint, lon double, lat double, ship_type string, length bigint"


def _scenes(spark, days=(0, 3)):
    rows = [(f"S2_{d}", START + dt.timedelta(days=d), 8.0, 54.0, 12.0, 57.0) for d in days]
    return spark.createDataFrame(rows, "api_id string, sensing_time timestamp_ntz, xmin double, ymin double, xmax double, ymax double")


def _rows(n, seed):
    rng = random.Random(seed)
    return [(i, START + dt.timedelta(days=rng.choice([0, 0, 1, 3]), minutes=rng.randrange(-40, 40), seconds=rng.choice([0, 0, 17])), rng.randrange(12),
             rng.uniform(7.5, 12.5), rng.uniform(53.5, 57.5), "Cargo", 10 + i % 50) for i in range(n)]


@pytest.mark.parametrize("seed", [1])
def test_stream_equals_batch_after_any_split_and_order(spark, scratch, seed):
    rows = _rows(400, seed)
    src, changes, ckpt = (os.path.join(scratch, n) for n in ("in", "changes", "ckpt"))
    rng = random.Random(seed)
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(1, 400), 3))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 400])]
    parts.append(parts[0])  # reports that come twice
    scenes = _scenes(spark)
    columns = ["id", "ts", "mmsi", "lon", "lat", "ship_type", "length", "api_id", "sensing_time", "rel", "time_diff"]
    sizes = []
    for k, part in enumerate(parts):
        spark.createDataFrame(part, POSITIONS).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(POSITIONS).parquet(src)
        # the second run forgets at once: what it knew is compared where the table is read
        assert follow_nearest(spark, stream, scenes, changes, ckpt, minutes=30, forget_hours=0 if k == 1 else 24) >= 1
        seen = [r for p in parts[:k + 1] for r in p]
        want = match.closest_fixes(match.match_window(spark.createDataFrame(sorted(set(seen)), POSITIONS), scenes, 30), columns=columns)
        got = current_closest(spark, changes, columns=columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        sizes.append(spark.read.parquet(f"{changes}/_epoch=*").count())
    matched = match.match_window(spark.createDataFrame(rows, POSITIONS), scenes, 30).count()
    assert sizes[-1] < matched  # only improvements are written
    add_changes(match.match_window(spark.createDataFrame(rows, POSITIONS), scenes, 30), changes, "batch")
    assert sorted(map(tuple, current_closest(spark, changes, columns=columns).collect())) == sorted(map(tuple, want.collect()))


def test_replayed_micro_batch_changes_nothing(spark, scratch):
    src, changes, ckpt = (os.path.join(scratch, n) for n in ("in", "changes", "ckpt"))
    scenes = _scenes(spark)
    for k in range(2):
        spark.createDataFrame(_rows(100, 10 + k), POSITIONS).coalesce(1).write.mode("append").parquet(src)
        follow_nearest(spark, spark.readStream.schema(POSITIONS).parquet(src), scenes, changes, ckpt, minutes=30)
    want = sorted(map(str, current_closest(spark, changes).collect()))
    last = max(int(f) for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit())
    for f in (f"{last}", f".{last}.crc"):  # written, but not committed
        if os.path.exists(os.path.join(ckpt, "commits", f)):
            os.remove(os.path.join(ckpt, "commits", f))
    assert follow_nearest(spark, spark.readStream.schema(POSITIONS).parquet(src), scenes, changes, ckpt, minutes=30) >= 1
    assert sorted(map(str, current_closest(spark, changes).collect())) == want


# ------------------------------------------------------------------ layout by day
def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_without_scenes_are_not_read(spark, scratch):
    rows = _rows(500, 5) + [(900 + i, None, 1, 9.0, 55.0, "x", 1) for i in range(3)]
    table = os.path.join(scratch, "by_day")
    plain = spark.createDataFrame(rows, POSITIONS)
    match.write_by_day(plain, table)
    schema = match.read_by_day(spark, table).schema
    folder = os.path.join(table, "day=2024-01-02")  # no scene lies on that day
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(os.path.join(folder, name), "wb") as f:
                f.write(b"not parquet: whoever reads this fails")
    for name in [n for n in os.listdir(folder) if n.endswith(".crc")]:
        os.remove(os.path.join(folder, name))
    scenes = _scenes(spark)
    pos = match.read_by_day(spark, table, schema)
    with pytest.raises(Exception):
        pos.agg(F.sum("length")).collect()
    closest = match.closest_fixes(match.match_window(pos, scenes, 30, day="day").drop("day"))
    assert "dynamicpruning" in _plan(closest).lower()
    want = match.closest_fixes(match.match_window(plain, scenes, 30))
    assert sorted(map(str, closest.select(want.columns).collect())) == sorted(map(str, want.collect()))
    predicted = match.predict_positions(pos, scenes, 30, day="day")
    assert "dynamicpruning" in _plan(predicted).lower()
    assert sorted(map(str, predicted.collect())) == sorted(map(str, match.predict_positions(plain, scenes, 30).collect()))


def test_windows_over_midnight_find_both_days(spark, scratch):
    scenes = spark.createDataFrame([("S", dt.datetime(2024, 1, 2, 0, 5), 8.0, 54.0, 12.0, 57.0)],
                                   "api_id string, sensing_time timestamp_ntz, xmin double, ymin double, xmax double, ymax double")
    rows = [(i, dt.datetime(2024, 1, 1, 23, 30) + dt.timedelta(minutes=5 * i), 1, 9.0, 55.0, "c", 1) for i in range(20)]
    plain = spark.createDataFrame(rows, POSITIONS)
    match.write_by_day(plain, os.path.join(scratch, "t"))
    pos = match.read_by_day(spark, os.path.join(scratch, "t"))
    got = match.match_window(pos, scenes, 20, day="day")
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in match.match_window(plain, scenes, 20).collect()) == list(range(3, 12))
