"""Byte-level BPE encoding and decoding by merge replay (operator 6).

The distinct matches of a piece of the corpus are laid out as one sequence of
tokens, bytes at first, with an index beside it: for every position the rank of
the pair that begins there.  A wave takes from the index, for all words at
once, the positions of each word's lowest rank, merges them, and looks up the
ranks of the touched neighbours only.  Ranks are thus applied in order within
every word, and as merges never cross a match the result equals a replay of
all merges over the whole corpus.  A worker keeps the ids of matches it has met
(bounded), so nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, pack
from .pretoken import WordIds, texts_in_pieces

#: Distinct matches a worker keeps (it only saves work), and rows of a batch read at a time.
KEEP_WORDS, FEW_ROWS = 150_000, 500
#: The rank of a pair that no merge joins.
NONE = np.int32(2**31 - 1)

_MODELS: dict[str, MergeModel] = {}


class MergeModel:
    """The ranks of a ``.tiktoken`` file (a line each: base64 of the token, its rank)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.token = {r: t for t, r in self.rank.items()}
        # every way to put a token together from two others; the rank of a token is its id
        keys = [(self.rank[t[:i]] << 20 | self.rank[t[i:]], r) for t, r in self.rank.items()
                for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank]
        keys.sort()
        self.pair_key = np.array([k for k, _ in keys], np.int64)
        self.pair_id = np.array([r for _, r in keys], np.int32)
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        left, right = np.divmod(np.arange(65536), 256)
        self.byte_pair = self.pair_rank(self.of_byte[left], self.of_byte[right])
        ids = np.arange(max(self.token) + 1)
        parts = [self.token.get(int(i), b"") for i in ids]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.words = WordIds(lambda words: self.replay([w.encode() for w in words]), KEEP_WORDS)

    @classmethod
    def load(cls, path: str) -> MergeModel:
        if path not in _MODELS:
            _MODELS[path] = cls(path)
        return _MODELS[path]

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of what two tokens give together, NONE if it is no token."""
        key = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.pair_key, key)
        at[at == len(self.pair_key)] = 0
        return np.where(self.pair_key[at] == key, self.pair_id[at], NONE)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word, as little-endian unsigned 32-bit integers."""
        sizes = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        tok = self.of_byte[raw]
        pair = np.full(len(tok), NONE, np.int32)
        inner = word[:-1] == word[1:]
        pair[:-1][inner] = self.byte_pair[raw[:-1][inner].astype(np.int64) * 256 + raw[1:][inner]]
        while len(tok):
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            count = np.diff(np.append(begin, len(tok)))
            low = np.repeat(np.minimum.reduceat(pair, begin), count)
            over = low == NONE
            if over.any():  # words without a pair left are done
                done.append((word[over], tok[over]))
                stay = ~over
                word, tok, pair, low = word[stay], tok[stay], pair[stay], low[stay]
                if not len(tok):
                    break
            hit = pair == low
            # of pairs that overlap each other the leftmost goes first: every second of a run
            i = np.arange(len(tok))
            run = np.maximum.accumulate(np.where(hit & ~np.concatenate([[False], hit[:-1]]), i, 0))
            hit &= (i - run) % 2 == 0
            at = np.flatnonzero(hit)
            tok[at] = pair[at]
            alive = np.ones(len(tok), bool)
            alive[at + 1] = False
            at -= np.searchsorted(at + 1, at, "right")  # where the merged tokens lie once the others have gone
            tok, word, pair = tok[alive], word[alive], pair[alive]
            touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
            pair[touched] = NONE
            touched = touched[touched + 1 < len(tok)]
            touched = touched[word[touched] == word[touched + 1]]
            pair[touched] = self.pair_rank(tok[touched], tok[touched + 1])
        if not done:
            return [b""] * len(words)
        word, tok = np.concatenate([w for w, _ in done]), np.concatenate([t for _, t in done])
        order = np.argsort(word, kind="stable")
        cut = np.searchsorted(word[order], np.arange(len(words) + 1)).tolist()
        ids = tok[order].astype("<u4")
        return [ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, byte offset of every id and the total)."""
        per = self.sizes[ids]
        run = np.concatenate([[0], np.cumsum(per)])
        take = np.repeat(self.begin[ids] - run[:-1], per) + np.arange(run[-1])
        return self.bytes[take], run


def encode(docs: DataFrame, ranks: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` array<int>: the tokens of each whole text. ``ranks`` is the path of a rank file.

    A null or empty text has no tokens.  Texts of any length are taken whole;
    rows keep their other columns (one named ``ids`` is replaced), repeated
    rows stay, and an empty table gives no rows.
    """
    p = pack(docs, text=column(text).cast("string"))
    schema = T.StructType([p.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = MergeModel.load(ranks).words
        for batch in batches:
            for a, b, joined, sizes in texts_in_pieces(batch.column(1)):
                flat, off = words.ids(joined, sizes)
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["row", "ids"])

    return _beside(docs, p.mapInArrow(run, schema), ids, "ids")


def _beside(docs: DataFrame, packed: DataFrame, name: str, made: str) -> DataFrame:
    """The rows of ``docs`` with the column made beside them, under ``name``."""
    return packed.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != name], F.col(made).alias(name))


def decode(docs: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out`` binary: the bytes of the ids. Null or empty lists give no bytes; unknown ids fail."""
    p = pack(docs, ids=column(ids))
    schema = T.StructType([p.schema["row"], T.StructField("out", T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = MergeModel.load(ranks)
        for batch in batches:
            got = [model.decode(np.array(x or [], np.int64))[0].tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], names=["row", "out"])

    return _beside(docs, p.mapInArrow(run, schema), out, "out")


def digests(docs: DataFrame, ranks: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (``with_ids`` adds ids array<int>): encode and decode in one pass.

    A null or empty text has no tokens; rows keep their number and order of work.
    """
    d = docs.select("doc_id", text)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = MergeModel.load(ranks)
        for batch in (x.slice(i, FEW_ROWS) for x in batches for i in range(0, x.num_rows, FEW_ROWS)):
            for a, b, joined, sizes in texts_in_pieces(batch.column(1)):
                ids, off = model.words.ids(joined, sizes)
                raw, run_off = model.decode(ids)
                raw, ids = memoryview(np.ascontiguousarray(raw)), ids.astype("<u4")
                cut = run_off[off].tolist()
                off = off.tolist()
                sha = [hashlib.sha256(ids[s:e]).hexdigest() for s, e in zip(off[:-1], off[1:])]
                back = [hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip(cut[:-1], cut[1:])]
                cols = [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(np.diff(off), pa.int64()), pa.array(sha), pa.array(back)]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return d.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def query(docs: DataFrame, ranks: str) -> DataFrame:
    return digests(docs, ranks)
