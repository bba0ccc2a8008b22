"""Incremental arrival of position files (A11) with Structured Streaming.

The reference re-lists its bucket and skips objects whose target already
exists.  Here the file source keeps the set of processed files in its
checkpoint, and ``trigger(availableNow=True)`` processes exactly what arrived
since the last run and stops.  The stream carries file names alone; each
micro-batch reads its files in ranges like a batch load.  A micro-batch writes
its own folder of the table and overwrites it when it is replayed after a loss,
so no row is stored twice and no stored row is read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_utc
from ..sources.csv_records import RANGE_BYTES, csv_records
from ..sources.positions import parse_records, with_row_id


def arriving_files(spark: SparkSession, source_dir: str, glob: str = "*.csv", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (path, length) of the files that arrive in ``source_dir``; contents are not read."""
    r = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
         .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir).select("path", "length")


def ingest_new_positions(spark: SparkSession, source_dir: str, table_path: str, *, name: str = "positions", checkpoint: str | None = None,
                         max_files_per_trigger: int | None = None, marks: str | None = None, range_bytes: int = RANGE_BYTES) -> int:
    """Add the rows of files that arrived since the last run to the parquet table at ``table_path``; returns the
    number of micro-batches run.

    Rows have ``_source``, ``record_no`` and the columns of a position file;
    ``_epoch`` names the micro-batch, whose folder is overwritten as a whole.
    With ``marks`` rows also get ``id``, going on after all earlier loads and the
    same when a micro-batch is replayed (``with_row_id``).  The checkpoint lives
    under the session's ``spark.checkpoint.dir`` unless one is given; without
    either it fails.  Table, marks and checkpoint belong together: a new
    checkpoint on an old table would overwrite its epochs, so it is refused.
    """
    pin_utc(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not (checkpoint or shared):
        raise ValueError("pass a checkpoint folder or set spark.checkpoint.dir: the list of processed files must outlive the session")
    ckpt = checkpoint or os.path.join(shared, f"ingest-{name}")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    there = lambda p: (q := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(q)
    if there(table_path) and not there(ckpt):
        raise ValueError(f"{table_path} exists, but not its checkpoint {ckpt}")
    batches = 0

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        nonlocal batches
        rows = parse_records(csv_records(batch, range_bytes), ["path", "record_no"])
        if marks:
            rows = with_row_id(rows, ("path",), marks=marks, load=f"{name}-{epoch_id}")
        rows.withColumnRenamed("path", "_source").write.mode("overwrite").parquet(f"{table_path}/_epoch={epoch_id}")
        batches += 1

    q = (arriving_files(spark, source_dir, max_files_per_trigger=max_files_per_trigger).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return batches
