"""WARC fixity audit by Merkle trees (operator 9).

A replica is a table of records (file, offset, size, bytes).  A record's hash is
a leaf; the leaves of a file in offset order are cut into ranges of FAN, their
hashes hashed into a node, and so on up to the file's root.  Two replicas are
compared at the roots, and only the children of mismatching nodes are compared
on the next level, down to the records.  Every node is an aggregate of at most
FAN rows, and below the roots only what differs is joined.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import shuffle_partitions, stash

FAN = 16
RECORDS = "file string, seq long, offset long, size long, record binary"


def record_bytes(url: str | None, page: str | None, ident: str) -> bytes:
    """One gzip member holding a WARC/1.1 response record; the same input gives the same bytes."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (page or "").encode()
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{ident}>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n"
            f"WARC-Target-URI: {uri}\r\nWARC-Payload-Digest: sha256:{hashlib.sha256((page or '').encode()).hexdigest()}\r\n"
            f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(body)}\r\n\r\n").encode()
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head + body + b"\r\n\r\n") + z.flush()


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of a gzip member made by any WARC writer."""
    raw = zlib.decompress(record, 47)
    head, _, body = raw.partition(b"\r\n\r\n")
    lines = [x.decode("utf-8", "replace").split(":", 1) for x in head.split(b"\r\n")[1:]]
    headers = {k.strip(): v.strip() for k, v in (x for x in lines if len(x) == 2)}
    return headers, body[:int(headers.get("Content-Length", len(body)))]


def pages_to_records(pages: DataFrame, files: int | None = None) -> DataFrame:
    """(file, seq, offset, size, record): ``pages`` (page_id, url, html) as records, files being ranges of page_id.

    Null urls and texts are empty, a null page_id comes first, pages with one
    id lie in the order of their url and html, and repeated rows are records of
    their own.  An empty table gives no records.
    """
    n = files or shuffle_partitions(pages.sparkSession)
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    d = d.repartitionByRange(n, "page_id").sortWithinPartitions("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, seq, offset = f"part-{TaskContext.get().partitionId():05d}.warc.gz", 0, 0
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                rows = []
                for page_id, url, page in zip(*(c.to_pylist() for c in part.columns)):
                    rows.append((name, seq, offset, record_bytes(url, page, str(uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}")))))
                    seq, offset = seq + 1, offset + len(rows[-1][3])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                     pa.array([len(r[3]) for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())],
                    names=["file", "seq", "offset", "size", "record"])

    return d.mapInArrow(run, RECORDS)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of ``*.warc.gz`` files below ``path`` with their offsets; a file is read by one task, record by record."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                offset = seq = 0
                while offset < len(raw):
                    z, at = zlib.decompressobj(31), offset
                    while not z.eof and at < len(raw):
                        z.decompress(raw[at:at + 65536])
                        at = min(at + 65536, len(raw))
                    end = at - len(z.unused_data) if z.eof else len(raw)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name.rsplit("/", 1)[-1]]), pa.array([seq], pa.int64()), pa.array([offset], pa.int64()),
                         pa.array([end - offset], pa.int64()), pa.array([raw[offset:end]], pa.binary())],
                        names=["file", "seq", "offset", "size", "record"])
                    offset, seq = end, seq + 1

    return files.select("path", "content").mapInArrow(run, RECORDS)


def leaves(records: DataFrame) -> DataFrame:
    """(file, seq, offset, size, hash) of each record; where it lies is part of its hash, null bytes are empty."""
    where = F.concat_ws(":", F.col("offset").cast("string"), F.col("size").cast("string"))
    return records.select("file", "seq", "offset", "size", F.sha2(F.concat(
        F.encode(where, "UTF-8"), F.lit(b"\n"), F.coalesce("record", F.lit(b""))), 256).alias("hash"))


def merkle_levels(leaf: DataFrame, levels: int, fan: int = FAN) -> list[DataFrame]:
    """The levels of every file's tree, leaves first: (file, node, lo, hi, hash), a node over at most ``fan`` nodes below."""
    level = stash(leaf.select("file", F.col("seq").alias("node"), F.col("offset").alias("lo"), (F.col("offset") + F.col("size")).alias("hi"), "hash"))
    out = [level]
    for _ in range(levels):
        below = F.sort_array(F.collect_list(F.struct("node", "hash")))
        level = stash(level.groupBy("file", F.floor(F.col("node") / fan).cast("long").alias("up")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), below.alias("below"))
            .select("file", F.col("up").alias("node"), "lo", "hi",
                    F.sha2(F.concat_ws("|", F.transform("below", lambda x: F.concat_ws(":", x["node"].cast("string"), x["hash"]))), 256).alias("hash")))
        out.append(level)
    return out


def audit(a: DataFrame, b: DataFrame, fan: int = FAN) -> DataFrame:
    """(file, seq, offset, size, status) of every record in which replica ``b`` differs from ``a``: changed, missing or extra.

    ``a`` and ``b`` are record tables; seq numbers a file's records from 0 in
    offset order.  Offsets are of ``a``, of ``b`` for extra records.  Equal
    replicas, and two empty ones, give no rows; a file that only one replica has
    is missing or extra as a whole.
    """
    la, lb = stash(leaves(a)), stash(leaves(b))
    most = max([0, *[r[0] for r in (la.agg(F.max("seq")).collect() + lb.agg(F.max("seq")).collect()) if r[0] is not None]])
    levels = 0
    while fan ** levels <= most:
        levels += 1
    ta, tb = merkle_levels(la, levels, fan), merkle_levels(lb, levels, fan)
    wrong = None
    for x, y in zip(reversed(ta), reversed(tb)):
        x, y = (t.select("file", "node", F.col("hash").alias(h)) for t, h in ((x, "ha"), (y, "hb")))
        if wrong is not None:  # children of mismatching nodes only
            up = wrong.select(F.col("file").alias("_f"), F.col("node").alias("_up"))
            x, y = (t.join(up, (t["file"] == up["_f"]) & (F.floor(t["node"] / fan) == up["_up"]), "left_semi") for t in (x, y))
        wrong = stash(x.join(y, ["file", "node"], "full_outer").where(~F.col("ha").eqNullSafe(F.col("hb"))))
    status = F.when(F.col("ha").isNull(), "extra").when(F.col("hb").isNull(), "missing").otherwise("changed")
    bad = wrong.select("file", F.col("node").alias("seq"), status.alias("status"))
    pa_, pb = (t.select("file", "seq", F.col("offset").alias(f"o{k}"), F.col("size").alias(f"s{k}")) for t, k in ((la, "a"), (lb, "b")))
    j = bad.join(pa_, ["file", "seq"], "left").join(pb, ["file", "seq"], "left")
    return j.select("file", "seq", F.coalesce("oa", "ob").alias("offset"), F.coalesce("sa", "sb").alias("size"), "status")


def damaged(records: DataFrame, one_in: int = 97) -> DataFrame:
    """A replica with known damage, for tests: in one record of ``one_in``, by its hash, the middle byte is flipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                out = []
                for r in part.column(4).to_pylist():
                    if r and zlib.crc32(r) % one_in == 0:
                        k = len(r) // 2
                        r = r[:k] + bytes([r[k] ^ 1]) + r[k + 1:]
                    out.append(r)
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(out, pa.binary())], names=["file", "seq", "offset", "size", "record"])

    return records.mapInArrow(run, RECORDS)


def query(pages: DataFrame) -> DataFrame:
    """Audit of a damaged replica of the whole table written as WARC records: what was damaged, located."""
    a = pages_to_records(pages)
    path = f"{checkpoint_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    a.write.parquet(path)
    a = pages.sparkSession.read.schema(RECORDS).parquet(path)
    return audit(a, damaged(a))
