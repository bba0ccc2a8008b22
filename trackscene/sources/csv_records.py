"""Records of large CSV files, split by byte ranges though fields may hold quoted newlines (A1).

A newline ends a record only outside quotes, so a range cannot know its records
without knowing whether it begins inside quotes.  Two passes settle that:

1. every range counts its quotes, and its newlines at even and at odd parity;
2. a prefix sum over the ranges of each file gives the parity at which a range
   begins, which of the two counts holds, and so the number of its first record.

A record belongs to the range that holds the newline before it; the task reads
on past its range until that record ends.  The header, which no newline
precedes, belongs to none.  Quotes toggle wherever they stand, as in the
database's COPY; a doubled quote toggles twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .archive_source import locate

#: Bytes of a range, and of a read within it.
RANGE_BYTES, READ_BYTES = 64 << 20, 4 << 20
QUOTE, NEWLINE = 0x22, 0x0A


def files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, length) of the files at ``path`` (a file, folder or glob) by Spark's listing; contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return (r.option("pathGlobFilter", glob) if glob else r).load(path).select("path", "length")


def _reads(path: str, lo: int, hi: int, piece: int) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes) of [lo, hi) in pieces."""
    fs, name = locate(path)
    with fs.open_input_file(name) as f:
        f.seek(lo)
        while lo < hi:
            raw = f.read(min(piece, hi - lo))
            if not raw:
                return
            yield lo, np.frombuffer(raw, np.uint8)
            lo += len(raw)


def _newlines(data: np.ndarray, parity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places of newlines, parity of the quotes before each, parity after all)."""
    at = np.flatnonzero(data == NEWLINE)
    quotes = np.flatnonzero(data == QUOTE)
    odd = (np.searchsorted(quotes, at) + parity) & 1
    return at, odd, (parity + len(quotes)) & 1


def ranges(found: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """(path, length, lo, hi, inside, first_no, n): the ranges of ``found`` (path, length), whether each begins inside
    quotes, the number of its first record in the file (from 1) and how many records it has."""
    cut = found.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("lo"))
    cut = cut.withColumn("hi", F.least(F.col("lo") + size, F.col("length")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                parity, ends = 0, [0, 0]
                for at, data in _reads(r["path"], r["lo"], r["hi"], READ_BYTES):
                    places, odd, parity = _newlines(data, parity)
                    inner = places + at + 1 < r["length"]  # a newline that ends the file begins no record
                    ends[0] += int((inner & (odd == 0)).sum())
                    ends[1] += int((inner & (odd == 1)).sum())
                yield pa.RecordBatch.from_arrays([pa.array([r[k]]) for k in ("path", "length", "lo", "hi")] + [pa.array([parity]), pa.array([ends[0]]), pa.array([ends[1]])],
                                                 names=["path", "length", "lo", "hi", "odd", "even_ends", "odd_ends"])

    spread = cut_lineage(cut)
    n = max(1, spread.count())
    counted = cut_lineage(spread.repartition(n).mapInArrow(count, "path string, length long, lo long, hi long, odd long, even_ends long, odd_ends long"))
    w = Window.partitionBy("path").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)  # a row per range of a file
    out = counted.withColumn("inside", F.coalesce(F.sum("odd").over(w), F.lit(0)) % 2)
    out = out.withColumn("n", F.when(F.col("inside") == 0, F.col("even_ends")).otherwise(F.col("odd_ends")))
    out = out.withColumn("first_no", F.coalesce(F.sum("n").over(w), F.lit(0)) + 1)
    return cut_lineage(out.select("path", "length", "lo", "hi", "inside", "first_no", "n"))


def _text(data: np.ndarray, at: list[int]) -> pa.Array:
    """The records data[at[0]:at[1]], data[at[1]:at[2]], ... without their line ends."""
    raw = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.array(at, np.int64)), pa.py_buffer(data.tobytes())])
    try:
        text = raw.cast(pa.large_string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8 become the replacement character
        text = pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.large_string())
    return pc.ascii_rtrim(text, "\r\n").cast(pa.string())


def csv_records(found: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """(path, record_no, record) of the CSV files ``found`` (path, length); the header of each is left out.

    record_no counts a file's records from 1, in order; blank lines count but
    give no row.  Each task reads a range; no file has to fit anywhere, and
    record numbers need no shuffle of the records.  An empty file, or one with
    a header alone, gives no rows.
    """
    cut = ranges(found, size)
    n = max(1, cut.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                parity, number = r["inside"], r["first_no"]
                held: np.ndarray | None = None  # bytes of the record that has begun

                def rows(data, at):
                    nonlocal number
                    text = _text(data, at)
                    no = pa.array(np.arange(number, number + len(text)))
                    number += len(text)
                    out = pa.RecordBatch.from_arrays([pa.array([r["path"]] * len(text), pa.string()), no, text], names=["path", "record_no", "record"])
                    return out.filter(pc.greater(pc.binary_length(text), 0))

                done = False
                for at, data in _reads(r["path"], r["lo"], r["length"], READ_BYTES):
                    places, odd, parity = _newlines(data, parity)
                    ends = places[odd == 0]
                    past = np.flatnonzero(ends + at >= r["hi"])
                    if len(past):  # the record under way here is the last of this range
                        ends, done = ends[:past[0] + 1], True
                    if held is None:
                        if not len(ends) or ends[0] + at >= r["hi"]:
                            if done or at + len(data) >= r["hi"]:
                                done = True
                                break
                            continue
                        data, ends = data[ends[0] + 1:], ends[1:] - ends[0] - 1
                    else:
                        data, ends = np.concatenate([held, data]), ends + len(held)
                    held = np.zeros(0, np.uint8)
                    if len(ends):
                        cuts = [0, *(ends + 1).tolist()]
                        yield rows(data[:cuts[-1]], cuts)
                        held = data[cuts[-1]:]
                    else:
                        held = data
                    if done:
                        break
                if held is not None and len(held) and not done:  # the last record of a file need not end in a newline
                    yield rows(held, [0, len(held)])

    return cut.repartition(n).mapInArrow(read, "path string, record_no long, record string")
