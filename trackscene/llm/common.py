"""Helpers shared by the operators: written tables, safe columns, and numpy kernels over Arrow text buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: The white space that ends a word, as a character class, as characters and as bytes.
WS = r"\x20\x09-\x0D"
WS_CHARS = " \t\n\x0b\x0c\r"
WORD = rf"[^{WS}]+"

U64 = np.uint64
ONE = U64(1)


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage through storage that every executor shares, so a lost
    executor costs a reread and not a recomputation of all that came before.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def column(name: str) -> Column:
    """A column by its exact name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def pack(docs: DataFrame, **needed: Column) -> DataFrame:
    """``row`` (all columns of ``docs`` as one struct) and the columns needed beside it.

    An operator that returns the rows it got works on this, so no name of its
    own can clash with an input column; ``select("row.*")`` gives the rows back.
    """
    return docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in needed.items()])


def text_of(name: str = "text") -> Column:
    """The text column, null counted as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


# ------------------------------------------------------------------ Arrow
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string(),
          "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64())}


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a schema string of simple types."""
    return pa.schema([(name, _KINDS[kind]) for name, kind in (f.split(" ", 1) for f in schema.split(", "))])


def arrow_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(col, k.type) for col, k in zip(zip(*rows), schema)], schema=schema)


# ------------------------------------------------------------------ Arrow text buffers
def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):  # several chunks that did not combine
        col = pa.concat_arrays(col.chunks)
    col = pc.fill_null(col.cast(pa.large_string()), "")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64, len(col) + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(off: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text each (one row at least), which bounds the kernels' memory."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))
_POW = {"up": np.ones(1, U64), "down": np.ones(1, U64)}
#: One random 64-bit value for each byte value.
BYTE_CODE = mix64(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POW[kind]
    if len(have) < n:
        base = _BASE if kind == "up" else _BASE_INV
        out = np.full(max(n, 1 << 16), base, U64)
        out[0] = 1
        _POW[kind] = have = np.multiply.accumulate(out)
    return have[:n]


class Spans:
    """64-bit hashes of spans of a sequence of 64-bit codes, equal for equal spans wherever they lie.

    A polynomial over prefix sums; the odd base has an inverse modulo 2**64, which moves each span to position 0.
    """

    def __init__(self, codes: np.ndarray):
        self.sums = np.zeros(len(codes) + 1, U64)
        np.cumsum(codes * _powers("up", len(codes)), out=self.sums[1:])
        self.down = _powers("down", len(codes) + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the spans [start, end)."""
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix64(h ^ ((end - start).astype(U64) * U64(0xA24BAED4963EE407)))


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Spans(codes).hash(start, end)


_IS_WS = np.zeros(256, bool)
_IS_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, index of the first word of each row and the total) of the words of rows lying one after another."""
    inside = ~_IS_WS[data]
    left = np.empty(len(data), bool)
    left[:1] = True
    left[1:] = ~inside[:-1]
    first = off[:-1][off[:-1] < len(data)]
    left[first] = True  # a row begins a new word though no white space lies before it
    start = np.flatnonzero(inside & left)
    right = np.empty(len(data), bool)
    right[-1:] = True
    right[:-1] = left[1:] | ~inside[1:]
    end = np.flatnonzero(inside & right) + 1
    return start, end, np.searchsorted(start, off)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]
