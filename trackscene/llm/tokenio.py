"""Token-ID / binary output (operator 4): fixed-width bit packing in blocks of whole documents.

A token file is a folder of shards in ascending doc_id order.  A shard is a
Parquet file of blocks; a block holds whole documents, its ids packed in the
fewest bits the vocabulary needs (least significant bit first), and where each
document begins.  Any document is found by (shard, block, offset), and a block
unpacks by numpy without loops.  Shards are written and committed by Spark, so
a lost task leaves no half file and any storage that Spark reaches will do.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cap_arrow_bytes, checkpoint_dir
from .common import shuffle_partitions, text_of
from .pretoken import WordIds, texts_in_pieces

#: A block is closed once it has this many ids; a longer document has a block of its own.
BLOCK_IDS = 1 << 16

BLOCKS = ("shard int, block int, first long, n_ids long, width int, payload binary, "
          "doc_id array<long>, doc_at array<long>")

_ENCODERS: dict[str, tuple[TextIds, int]] = {}


def pack(ids: np.ndarray, width: int) -> bytes:
    """The ids in ``width`` bits each, least significant bit first, the last byte filled with zeros."""
    if width % 8 == 0:
        return np.ascontiguousarray(ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width // 8]).tobytes()
    bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, n: int) -> np.ndarray:
    """``n`` ids from number ``start`` on; only the bytes that hold them are read."""
    if n <= 0:
        return np.zeros(0, np.uint64)
    a, b = start * width, (start + n) * width
    raw = np.frombuffer(payload, np.uint8)[a // 8:(b + 7) // 8]
    if width % 8 == 0:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width // 8] = raw.reshape(n, width // 8)
        return wide.view("<u8").ravel()
    bits = np.unpackbits(raw, bitorder="little")[a % 8:a % 8 + n * width].reshape(n, width)
    return (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


class TextIds:
    """Ids of whole texts as the library gives them: by match, and by the library itself where a text holds an added token."""

    def __init__(self, words: WordIds, added: list[str], whole: Callable[[str], list[int]]):
        self.words, self.added, self.whole = words, added, whole

    def ids(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text) of texts lying one after another in ``text``, ``sizes`` code points each."""
        flat, off = self.words.ids(text, sizes)
        if not any(a in text for a in self.added):
            return flat, off
        at = np.cumsum([0, *sizes]).tolist()
        parts = [flat[a:b] for a, b in zip(off[:-1], off[1:])]
        for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
            one = text[a:b]
            if any(x in one for x in self.added):
                parts[k] = np.array(self.whole(one), np.uint32)
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def encoder(path: str) -> tuple[TextIds, int]:
    """(ids by text, bits of an id) of a byte-level BPE ``tokenizers`` file.

    The library encodes every distinct match of its own pre-tokeniser once per
    worker; a text's ids are those of its matches one after another.  Matches
    cannot see the file's added tokens, so a text that holds one goes to the
    library whole.
    """
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)

        def encode(words: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch_fast(words, add_special_tokens=False)]

        added = [a.content for a in t.get_added_tokens_decoder().values()]
        whole = TextIds(WordIds(encode), added, lambda text: t.encode(text, add_special_tokens=False).ids)
        _ENCODERS[path] = whole, max(1, (t.get_vocab_size() - 1).bit_length())
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shards: int | None = None,
                 block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of every whole text of ``docs`` (doc_id, text), each followed by ``end_id``, to ``path``.

    Documents lie in ascending doc_id order (null first; rows with one id in
    order of their texts).  A null text has the end id alone; an empty table
    gives shards without blocks.  Other columns are not read.  ``shards``
    (default: the shuffle partitions) is how many ranges of ids are made; only
    the texts move, once.
    """
    cap_arrow_bytes(docs.sparkSession)
    n = shards or shuffle_partitions(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    d = d.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, width = encoder(tokenizer)
        shard, block, first, held = TaskContext.get().partitionId(), 0, 0, 0
        doc_id: list = []
        ids: list[np.ndarray] = []
        sizes: list[int] = []

        def close():
            flat = np.concatenate(ids)
            at = np.cumsum([0, *sizes])
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                pa.array([len(flat)], pa.int64()), pa.array([width], pa.int32()), pa.array([pack(flat, width)], pa.binary()),
                pa.array([doc_id], pa.list_(pa.int64())), pa.array([at.tolist()], pa.list_(pa.int64()))],
                names=["shard", "block", "first", "n_ids", "width", "payload", "doc_id", "doc_at"]), len(flat)

        for batch in batches:
            for a, b, joined, n_cp in texts_in_pieces(batch.column(1)):
                flat, off = words.ids(joined, n_cp)
                off = off.tolist()
                for k, doc in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    doc_id.append(doc)
                    ids += [flat[off[k]:off[k + 1]], np.array([end_id], np.uint32)]
                    sizes.append(off[k + 1] - off[k] + 1)
                    held += sizes[-1]
                    if held >= block_ids:
                        out, size = close()
                        yield out
                        block, first, held, doc_id, ids, sizes = block + 1, first + size, 0, [], [], []
        if sizes:
            yield close()[0]

    d.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """(shard, before): the ids in all shards before; from the blocks' sizes alone, a row per shard in the window."""
    per = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return per.select("shard", F.coalesce(before, F.lit(0)).alias("before"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, shard, start in the shard, ids array<int>) of every document, end ids included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                flat = unpack(r["payload"], r["width"], 0, r["n_ids"]).astype(np.int32)
                at = np.array(r["doc_at"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_id"], pa.int64()), pa.array(np.full(len(at) - 1, r["shard"]), pa.int32()),
                     pa.array(r["first"] + at[:-1], pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))],
                    names=["doc_id", "shard", "start", "ids"])

    return read_blocks(spark, path).mapInArrow(run, "doc_id long, shard int, start long, ids array<int>")


def read_document(spark: SparkSession, path: str, doc_id: int) -> np.ndarray | None:
    """Random access: the ids of one document, by the block that holds it; None if there is none."""
    hit = read_blocks(spark, path).where(F.array_contains("doc_id", F.lit(doc_id).cast("long"))).limit(1).collect()
    if not hit:
        return None
    k = hit[0]["doc_id"].index(doc_id)
    a, b = hit[0]["doc_at"][k:k + 2]
    return unpack(bytes(hit[0]["payload"]), hit[0]["width"], a, b - a)


def document_sums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                flat = unpack(r["payload"], r["width"], 0, r["n_ids"]).astype("<u4")
                at = r["doc_at"]
                crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_id"], pa.int64()), pa.array(np.full(len(crc), r["shard"]), pa.int32()),
                     pa.array(r["first"] + np.array(at[:-1]), pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "shard", "at", "n_tokens", "ids_crc32"])

    blocks = read_blocks(spark, path)
    d = blocks.mapInArrow(run, "doc_id long, shard int, at long, n_tokens long, ids_crc32 long")
    s = shard_starts(blocks)
    return d.join(F.broadcast(s), "shard").select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def query(docs: DataFrame, tokenizer: str) -> DataFrame:
    import uuid
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer)
    return document_sums(spark, path)
