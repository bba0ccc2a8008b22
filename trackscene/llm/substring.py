"""Substring dedup (operator 2): content-defined chunks by a gear rolling hash, deduplicated by digest.

A text is cut where the gear hash of the 16 bytes before a place is low, so cuts
follow the content and an insertion moves only the chunks it
touches.  Chunks travel as 128-bit digests in packed arrays, dealt by digest; a
batch sends each digest once, with its first place there, so a passage that a
third of all rows share costs one entry per batch.  The first place of a digest
in (doc_id, position) order is its original; the rest repeat it.  Runs of
repeated chunks long enough to be a passage are reported, shorter ones are
chance.  The query takes ``anchors`` for chunks: overlapping spans chosen among
their neighbours, so that every passage of some length has one in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, U64, mix64, pack, pieces, shuffle_partitions, span_hashes, stash, utf8

WINDOW = 16
#: Bytes of a chunk on average, and none longer than MOST bytes.
MEAN, MOST = 20, 64
#: Least bytes of a run of repeated chunks: a passage of 50 words has 250 to 350, of which its edges lose 16 + 2 * MEAN on average.
LEAST_RUN = 112
#: Places in a row of which ``anchors`` takes one at least.
REACH = 40
PIECE_BYTES, BATCH_BYTES = 1 << 19, 1 << 23
BROADCAST_IDS = 1_000_000

#: One random 32-bit number for each byte value.
GEAR = (mix64(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93)) >> U64(32)).astype(np.uint32)

ENTRY = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("at", "<u4"), ("size", "<u4")])


def cuts(data: np.ndarray, off: np.ndarray, mean: int = MEAN, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the chunks of rows lying one after another in ``data``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = GEAR[data]
    step = 1
    while step < WINDOW:  # sum of gear << distance over the window, by doubling
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    ends = np.flatnonzero(h < np.uint32((1 << 32) // mean)) + 1
    # a place nearer to its row's begin than the window looks into the row before it: no cut there
    row = np.searchsorted(off, ends - 1, "right") - 1
    ends = ends[ends - off[row] >= WINDOW]
    ends = np.unique(np.concatenate([ends, off[1:][off[1:] > off[:-1]]]))
    starts = np.concatenate([[0], ends[:-1]])
    size = ends - starts
    if (size > most).any():  # long chunks are cut at every ``most`` bytes
        parts = -(-size // most)
        first = np.repeat(np.cumsum(parts) - parts, parts)
        k = np.arange(int(parts.sum())) - first
        starts = np.repeat(starts, parts) + k * most
        ends = np.minimum(starts + most, np.repeat(ends, parts))
    return starts, ends


def _slide(x: np.ndarray, pick, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) of x[i:i + width] for every such i."""
    step = 1
    while 2 * step <= width:
        x = pick(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return pick(x[:-rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, off: np.ndarray, size: int = LEAST_RUN, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the spans of ``size`` bytes whose hash is least of some ``reach`` neighbours, and of each row's first and last.

    Which of ``reach`` spans is least depends on their ``size + reach - 1`` bytes
    alone, so a passage that long has a common anchor wherever it stands.
    """
    n = np.diff(off)
    rows = n >= size
    edges = np.concatenate([off[:-1][rows], off[1:][rows] - size])
    take = edges
    if len(data) >= size + reach - 1:
        at = np.arange(len(data) - size + 1)
        h = span_hashes(BYTE_CODE[data], at, at + size)
        low = _slide(h, np.minimum, reach)
        # places that lie in one row with the last byte of their last span
        first = at[:len(low)]
        row = np.repeat(np.arange(len(n)), n)
        low[row[:len(low)] != row[first + reach + size - 2]] = 0
        pad = np.zeros(reach - 1, U64)
        most = _slide(np.concatenate([pad, low, pad]), np.maximum, reach)  # of the least values of all windows over a place
        take = np.concatenate([np.flatnonzero((h == most) & (most > 0)), edges])
    take = np.unique(take)
    return take, take + size


def repeated_chunks(docs: DataFrame, cut=cuts) -> DataFrame:
    """(doc_id, at, size, first_doc, first_at): every chunk (bytes) of ``cut`` that another place before it already holds."""
    buckets = 4 * shuffle_partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        held, size = [], 0

        def deal(held, turn):
            e = np.concatenate(held)
            e = e[np.lexsort((e["at"], e["doc"], e["h2"], e["h1"]))]
            new = np.concatenate([[True], (e["h1"][1:] != e["h1"][:-1]) | (e["h2"][1:] != e["h2"][:-1])])
            # what repeats within the batch is known to repeat; its first place is settled where the digest goes
            again = e[~new]
            origin = e[new][np.cumsum(new) - 1][~new]
            yield from by_bucket(e[new], (e["h1"][new] % U64(buckets)).astype(np.int32), 0)
            if len(again):
                pairs = np.concatenate([again.view(np.uint8).reshape(len(again), -1), origin.view(np.uint8).reshape(len(again), -1)], axis=1)
                for a in range(0, len(again), 1 << 15):
                    yield pa.RecordBatch.from_arrays([pa.array([(turn + a) % buckets], pa.int32()), pa.array([1], pa.int32()),
                                                      pa.array([pairs[a:a + (1 << 15)].tobytes()], pa.binary())], names=["bucket", "kind", "packed"])

        def by_bucket(e, b, kind):
            order = np.argsort(b, kind="stable")
            e, b = e[order], b[order]
            at = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            cut = np.append(at, len(b))
            yield pa.RecordBatch.from_arrays([pa.array(b[at]), pa.array(np.full(len(at), kind, np.int32)),
                                              pa.array([e[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary())],
                                             names=["bucket", "kind", "packed"])

        with np.errstate(over="ignore"):
            for batch in batches:
                data, off = utf8(batch.column(1))
                ids = np.array([-1 if i is None else i for i in batch.column(0).to_pylist()], np.int64)
                for a, b in pieces(off, PIECE_BYTES):
                    raw, o = data[off[a]:off[b]], off[a:b + 1] - off[a]
                    s, t = cut(raw, o)
                    if not len(s):
                        continue
                    e = np.empty(len(s), ENTRY)
                    codes = BYTE_CODE[raw]
                    e["h1"], e["h2"] = span_hashes(codes, s, t), span_hashes(mix64(codes), s, t)
                    row = np.searchsorted(o, s, "right") - 1
                    e["doc"], e["at"], e["size"] = ids[a:b][row], s - o[row], t - s
                    held.append(e)
                    size += len(raw)
                    if size >= BATCH_BYTES:
                        yield from deal(held, turn)
                        held, size, turn = [], 0, turn + 1
            if held:
                yield from deal(held, turn)

    def settle(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        kinds, packed = group.column("kind").to_pylist(), group.column("packed").to_pylist()
        e = np.frombuffer(b"".join(p for k, p in zip(kinds, packed) if k == 0), ENTRY)
        e = e[np.lexsort((e["at"], e["doc"], e["h2"], e["h1"]))]
        if len(e):
            new = np.concatenate([[True], (e["h1"][1:] != e["h1"][:-1]) | (e["h2"][1:] != e["h2"][:-1])])
            again, origin = e[~new], e[new][np.cumsum(new) - 1][~new]
        else:
            again = origin = e
        known = np.frombuffer(b"".join(p for k, p in zip(kinds, packed) if k == 1), ENTRY).reshape(-1, 2)
        again, origin = np.concatenate([again, known[:, 0]]), np.concatenate([origin, known[:, 1]])
        return pa.table({"doc_id": again["doc"].astype(np.int64), "at": again["at"].astype(np.int32), "size": again["size"].astype(np.int32),
                         "first_doc": origin["doc"].astype(np.int64), "first_at": origin["at"].astype(np.int32)})

    return (docs.mapInArrow(run, "bucket int, kind int, packed binary").groupBy("bucket")
            .applyInArrow(settle, "doc_id long, at int, size int, first_doc long, first_at int"))


def repeated_spans(docs: DataFrame, least_run: int = LEAST_RUN, cut=cuts) -> DataFrame:
    """(doc_id, start, size, first_doc): runs of repeated chunks of at least ``least_run`` bytes, in UTF-8 bytes of the text.

    Every passage repeated anywhere before, in doc_id order, is reported for
    the later place; the first place is not.  ``first_doc`` is where (a batch
    knows) the run's first chunk stands earlier.  A run ends where a chunk is
    new.  Null and empty texts have no chunks; null ids are reported as -1;
    rows with one id are one document's places; an empty table gives no rows.
    With ``anchors`` for ``cut`` every passage of LEAST_RUN + REACH - 1 bytes is
    found; with chunks one in a hundred of 51 words is not.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    c = repeated_chunks(d, cut).distinct()
    # runs by doc: the windows hold one document's chunks
    from pyspark.sql import Window
    w = Window.partitionBy("doc_id").orderBy("at")
    c = c.withColumn("new", (F.coalesce(F.lag(F.col("at") + F.col("size")).over(w), F.lit(-1)) < F.col("at")).cast("int"))
    c = c.withColumn("run", F.sum("new").over(w))
    runs = c.groupBy("doc_id", "run").agg(F.min("at").alias("start"), F.max(F.col("at") + F.col("size")).alias("end"),
                                          F.min_by("first_doc", "at").alias("first_doc"))
    return runs.where(F.col("end") - F.col("start") >= least_run).select(
        "doc_id", F.col("start").cast("long").alias("start"), (F.col("end") - F.col("start")).cast("long").alias("size"), "first_doc")


def _keyed(docs: DataFrame) -> DataFrame:
    """row and a long key: the id, or for null and repeated ids a number of 60 bits below -2**62, from the md5 of id and text.

    Rows that repeat both id and text, by all 128 bits, become one.
    """
    d = pack(docs, doc_id=F.col("doc_id").cast("long"), text=F.col("text").cast("string"))
    again = stash(d.where("doc_id is not null").groupBy(F.col("doc_id").alias("_again")).count().where("count > 1").select("_again"))
    few = again.count() <= BROADCAST_IDS
    d = d.join(F.broadcast(again) if few else again, F.col("doc_id") == F.col("_again"), "left")
    d = d.withColumn("own", F.col("doc_id").isNotNull() & F.col("_again").isNull())
    digest = F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.when(F.col("text").isNull(), "null").otherwise("text"), F.col("text")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")  # 60 bits
    key = F.when(F.col("own"), F.col("doc_id")).otherwise(F.lit(-(1 << 62)) - 1 - number)
    d = d.select("row", key.alias("key"), "own", digest.alias("digest"))
    once = d.where("not own").groupBy("key", "digest").agg(F.first("row").alias("row"))
    return d.where("own").select("row", "key").union(once.select("row", "key"))


def remove_repeats(docs: DataFrame, least_run: int = LEAST_RUN, cut=cuts) -> DataFrame:
    """``docs`` with the repeated spans cut out of ``text`` (bytes of cut characters at an edge are replaced by nothing).

    The spans are a list per row; rows without any are not rewritten.  Rows whose
    id is null or on several rows are told apart by a key of id and text; they
    come before all others, in order of that key, and of rows that repeat both id
    and text one stays.
    """
    rows = stash(_keyed(docs))
    spans = (repeated_spans(rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), least_run, cut)
             .groupBy(F.col("doc_id").alias("_id")).agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias("_spans")))
    spans = stash(spans)
    few = spans.count() <= BROADCAST_IDS // 4
    j = rows.join(F.broadcast(spans) if few else spans, F.col("key") == F.col("_id"), "left").select("row", "_spans")
    names = docs.columns

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = names.index("text")
        for batch in batches:
            cols = batch.column(0).flatten()
            texts, lists = cols[k].to_pylist(), batch.column(1).to_pylist()
            out = []
            for t, s in zip(texts, lists):
                if t and s:
                    raw, at, parts = t.encode(), 0, []
                    for x in s:
                        parts.append(raw[at:x["start"]].decode(errors="ignore"))
                        at = x["start"] + x["size"]
                    t = "".join([*parts, raw[at:].decode(errors="ignore")])
                out.append(t)
            cols[k] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return j.mapInArrow(without, docs.schema)


def query(docs: DataFrame) -> DataFrame:
    return repeated_spans(docs, cut=anchors)
