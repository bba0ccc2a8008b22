"""Nearest reports of each scene, kept up to date while reports arrive (A11 + E3).

A report stream meets the scenes in the bucketed join of ``match_window``; the
state of a (mmsi, scene) holds its nearest report on either side, and only an
improvement leaves.  Improvements are written by micro-batch, and the current
table is the nearest of all that was written: taking the least is the same in
any order and any number of times, so files may arrive in any order, late, or
twice, and a replayed micro-batch overwrites its own folder.  State is
forgotten by a timer some time after the last report of a scene; a report that
comes later still is compared again where the table is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.match import closest_fixes, match_window

KEYS = ("mmsi", "api_id", "sensing_time")
#: When a report reached the stream: the clock of the timers, on which no report is ever late.
ARRIVED = "arrived_at"
#: The state backend that keeps timers and typed state.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NearestReports(StatefulProcessor):
    """Per (mmsi, api_id, sensing_time): order of the nearest report before and after; emits reports that are nearer."""

    def __init__(self, columns: Sequence[str], id_col: str, forget_ms: int):
        self.columns, self.id_col, self.forget_ms = list(columns), id_col, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        order = T.StructType([T.StructField("abs_us", T.LongType()), T.StructField("id", T.LongType())])
        self.side = {rel: handle.getValueState(rel, order) for rel in ("before", "after")}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best: dict[str, tuple[tuple[int, int], pd.DataFrame]] = {}
        arrived = 0
        for pdf in rows:
            arrived = max(arrived, int(pdf[ARRIVED].max().timestamp() * 1000))
            pdf = pdf.assign(_abs=pdf["diff_us"].abs()).sort_values(["_abs", self.id_col])
            for rel, part in pdf.groupby("rel", sort=False):
                first = part.iloc[:1]
                order = (int(first["_abs"].iloc[0]), int(first[self.id_col].iloc[0]))
                if rel not in best or order < best[rel][0]:
                    best[rel] = order, first[self.columns]
        for rel, (order, row) in best.items():
            known = self.side[rel].get() if self.side[rel].exists() else None
            if known is None or order < (known[0], known[1]):
                self.side[rel].update(order)
                yield row
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(arrived + self.forget_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in self.side.values():
            state.clear()
        return iter(())

    def close(self) -> None:
        pass


def follow_nearest(spark: SparkSession, positions: DataFrame, scenes: DataFrame, changes: str, checkpoint: str, *, minutes: float = 10,
                   forget_hours: float = 24, id_col: str = "id") -> int:
    """Match the reports that a streaming ``positions`` (id, mmsi, ts, lon, lat, ...) brings since the last run, and write
    improvements below ``changes``; returns the number of micro-batches.

    ``scenes`` is a batch table (api_id, sensing_time and its box); it is read
    as it stands at each start.  Scenes added later see the reports that arrive
    after them; match earlier ones with ``closest_fixes`` and append the result
    to ``changes`` with ``add_changes``.
    """
    arriving = positions.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, "0 seconds")
    matched = match_window(arriving, scenes, minutes, id_col=id_col)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in matched.schema.fields if f.name != ARRIVED])
    out = matched.groupBy(*KEYS).transformWithStateInPandas(
        NearestReports(schema.names, id_col, int(forget_hours * 3_600_000)), outputStructType=schema, outputMode="update", timeMode="eventTime")
    batches = 0

    def write(batch: DataFrame, epoch: int) -> None:
        nonlocal batches
        batch.write.mode("overwrite").parquet(f"{changes}/_epoch={epoch}")
        batches += 1

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STATE_STORE)  # read when the query starts, and put back then
    try:
        q = out.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set(key, before)
    return batches


def add_changes(matched: DataFrame, changes: str, name: str) -> None:
    """Add the rows of a batch match (``match_window``) under a name of their own; the same name again replaces them."""
    matched.write.mode("overwrite").parquet(f"{changes}/_epoch={name}")


def current_closest(spark: SparkSession, changes: str, schema: T.StructType | None = None, columns: Sequence[str] | None = None, id_col: str = "id") -> DataFrame:
    """E3 as it stands: the nearest report on each side of every (mmsi, scene), of all improvements written so far."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    m = r.parquet(f"{changes}/_epoch=*")
    return closest_fixes(m, KEYS, id_col, columns)
