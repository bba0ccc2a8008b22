"""MinHash near-dedup (operator 12): a multi-index Hamming join of b-bit signatures.

1. Every text becomes its set of 3-word shingles, and the set a signature of
   ``POSITIONS`` minimum hashes, ``BITS`` bits of each.  Equal sets are one
   class, named by 128 bits, so copies never meet.
2. Two signatures that differ in at most ``MOST_APART`` of their first
   ``POSITIONS`` positions agree, by pigeonhole, on all but one position of at
   least one of ``CHUNKS`` chunks.  Each class is therefore posted under every
   chunk with each of its positions left out in turn.  All pairs within the
   distance share a key; none is lost.  ``MORE`` further positions sharpen the
   distance: at most ``ALL_APART`` of all may differ.  A pair of similarity 0.85
   is farther apart with a probability below 1e-5.
3. Each class first meets the hub of each of its keys, a pair for each posting
   at most.  The hub is the member with most others in all its keys together, so
   a large group of near copies falls to its centre.  Of those within the
   distance the nearest is verified on the full sets, and verified links are
   joined to components.
4. What is left are keys with members of several components.  Up to ``RUN``
   members are compared in one task; only pairs of different components leave
   it that are within the distance and that the parity bitmaps of the sets allow
   (bits that differ stand for members that differ, so no link is lost), and a
   pair leaves the first of its keys alone.  In a larger key the members outside
   its largest component meet the others; where they are many, the key is cut
   into cells by size, as only sets of like size can be similar enough, and
   cells still too large by pairs of tiles.  What is found is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cap_arrow_bytes
from .common import ONE, U64, mix64, pieces, stash, utf8
from .components import components
from .ngram import parity, shingle_sets

WORDS, LEAST = 3, (85, 100)
#: Minimum hashes of a signature, bits kept of each, chunks they are split into, and positions that may differ.
POSITIONS, BITS, CHUNKS = 32, 16, 8
PER_CHUNK = POSITIONS // CHUNKS
MOST_APART = 2 * CHUNKS - 1
#: Further positions of a byte each, and positions of all that may differ.
MORE, ALL_APART = 96, 39
SIG, FINE = [f"s{i}" for i in range(POSITIONS * BITS // 64)], [f"f{i}" for i in range(MORE // 8)]
#: Longs of the parity bitmap of a set.
MAP = [f"p{i}" for i in range(8)]
ALL = SIG + FINE + MAP
#: Members of a key that one task compares; members outside the largest component that meet the others at once in larger keys.
RUN, FEW = 4096, 64
PIECE_BYTES = 1 << 19

_MULT = mix64(np.arange(1, POSITIONS + MORE + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | ONE


def signatures(sets: list[np.ndarray], fine: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, signatures, further positions) of non-empty sets: 128 bits of each whole set, and its minimum hashes' low bits."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets)])[:-1]
    name = np.stack([np.add.reduceat(mix64(flat ^ U64(0x243F6A8885A308D3)), at), np.add.reduceat(mix64(flat * U64(0x13198A2E03707345) + ONE), at)], 1)
    if not fine:
        return name, np.zeros((len(sets), 0), np.uint16), np.zeros((len(sets), 0), np.uint8)
    low = mix64(np.stack([np.minimum.reduceat(flat * m, at) for m in _MULT], 1))
    return name, (low[:, :POSITIONS] & U64((1 << BITS) - 1)).astype(np.uint16), (low[:, POSITIONS:] & U64(255)).astype(np.uint8)


def _row_sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, row after the last, sets) of the texts in column 1, in pieces of bounded size."""
    data, off = utf8(batch.column(1))
    with np.errstate(over="ignore"):
        for a, b in pieces(off, PIECE_BYTES):
            yield a, b, list(shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a], words))


def profile(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, id, s0, s1, ..., f0, ... of every row: size, name and signature of its set; null names for empty sets."""
    kinds = "doc_id long, n long, id binary, " + ", ".join(f"{s} long" for s in ALL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sets in _row_sets(batch, words):
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                ids, sig = [None] * len(sets), np.zeros((len(sets), len(ALL)), np.int64)
                if len(full):
                    with np.errstate(over="ignore"):
                        name, low, more = signatures([sets[i] for i in full])
                    sig[full] = np.concatenate([np.ascontiguousarray(low).view(np.int64), np.ascontiguousarray(more).view(np.int64),
                                                    np.stack([parity(sets[i]) for i in full])], 1)
                    for i, x in zip(full, name):
                        ids[i] = x.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                                                  *map(pa.array, sig.T.copy())], names=["doc_id", "n", "id", *ALL])

    return stash(docs.select("doc_id", "text").mapInArrow(run, kinds))


def chunk_keys(sig: np.ndarray, skip: np.ndarray, seed: np.ndarray, errors: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, chunk, first position left out) of every way to leave ``errors`` positions out of a chunk not in the bit mask ``skip``.

    Signatures that differ in at most ``errors`` positions of a chunk have a
    key of it in common; ``seed`` tells the groups apart in which keys count.
    """
    rows, keys, used, out = [], [], [], []
    for c in range(CHUNKS):
        free = np.flatnonzero((skip >> c) & 1 == 0)
        part = sig[free, c * PER_CHUNK:(c + 1) * PER_CHUNK].astype(U64)
        for stay in combinations(range(PER_CHUNK), PER_CHUNK - errors):
            mark = c * 256 + sum(1 << i for i in stay)
            h = mix64(seed[free] ^ U64(mark) * U64(0xD1342543DE82EF95))
            for i in stay:
                h = mix64(h * U64(0xC2B2AE3D27D4EB4F) + part[:, i])
            rows.append(free)
            keys.append(h)
            used.append(np.full(len(free), c))
            out.append(np.full(len(free), next((i for i in range(PER_CHUNK) if i not in stay), 0)))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(used), np.concatenate(out)


def _longs(batch: pa.RecordBatch, names: list[str], kind) -> np.ndarray:
    longs = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names], 1)
    return np.ascontiguousarray(longs).view(kind).reshape(len(longs), -1)


def _sig_of(batch: pa.RecordBatch) -> np.ndarray:
    return _longs(batch, SIG, np.uint16)


def posted(classes: DataFrame) -> DataFrame:
    """(key, used, out, id): every class under its keys with one error in a chunk; ``used`` marks the chunk, ``out`` is the position left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                none = np.zeros(batch.num_rows, np.int64)
                with np.errstate(over="ignore"):
                    row, key, c, out = chunk_keys(_sig_of(batch), none, none.astype(U64), 1)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array((1 << c).astype(np.int32)), pa.array(out.astype(np.int32)),
                                                  batch.column(0).take(pa.array(row))], names=["key", "used", "out", "id"])

    return classes.select("id", *SIG).mapInArrow(run, "key long, used int, out int, id binary")


def bits_allow(bits: np.ndarray, size: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """Whether sets of ``size`` members together whose bitmaps differ in ``bits`` may be similar enough."""
    a, b = least
    return (a + b) * bits <= (b - a) * size


def within(pairs: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b, apart) of the pairs, classes in the structs x and y, that are within the distance and that the bitmaps allow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart, far = ((_longs(batch, [f"x{c}" for c in names], kind) != _longs(batch, [f"y{c}" for c in names], kind)).sum(axis=1)
                          for names, kind in ((SIG, np.uint16), (FINE, np.uint8)))
            bits = np.bitwise_count(_longs(batch, [f"x{c}" for c in MAP], np.uint64) ^ _longs(batch, [f"y{c}" for c in MAP], np.uint64)).sum(axis=1, dtype=np.int64)
            size = sum(batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("xn", "yn"))
            near = pa.array((apart <= MOST_APART) & (apart + far <= ALL_APART) & bits_allow(bits, size, least))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((apart + far).astype(np.int32))], names=["a", "b", "apart"]).filter(near)

    sig = [F.col(f"{t}.{s}").alias(f"{t}{s}") for t in "xy" for s in ["n", *ALL]]
    return pairs.select("a", "b", *sig).mapInArrow(run, "a binary, b binary, apart int")


def _sizes_allow(x: str, y: str, least: tuple[int, int]) -> Column:
    return F.least(f"{x}.n", f"{y}.n") * least[1] >= F.greatest(f"{x}.n", f"{y}.n") * least[0]


def linked(x: np.ndarray, y: np.ndarray, least: tuple[int, int]) -> bool:
    """Whether two sorted sets are similar enough, on all their members."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return least[1] * common >= least[0] * (len(x) + len(y) - common)


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, least: tuple[int, int]) -> DataFrame:
    """(a, b, linked) of distinct pairs of classes, on their full sets; the sets of ``b`` travel to those of ``a``."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    pick = stash(classes.join(ids, "id", "left_semi").select(F.col("doc_id").alias("_pick")).distinct())
    d = docs.join(pick, F.col("doc_id").eqNullSafe(F.col("_pick")), "left_semi").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, sets in _row_sets(batch, words):
                full = [s for s in sets if len(s)]
                if full:
                    with np.errstate(over="ignore"):
                        names = [x.tobytes() for x in signatures(full, fine=False)[0]]
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([s.tobytes() for s in full], pa.binary())], names=["id", "s"])

    # rows that repeat a set (repeated or null ids) give it more than once
    sets = d.mapInArrow(run, "id binary, s binary").join(ids, "id", "left_semi")
    sets = stash(sets.groupBy("id").agg(F.first("s").alias("s")))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [linked(np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64), least) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "linked"])

    j = pairs.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")).hint("merge"), "b")
    j = j.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")).hint("merge"), "a").select("a", "b", "sa", "sb")
    return stash(j.mapInArrow(test, "a binary, b binary, linked boolean"))


def pairs_apart(p: DataFrame, classes: DataFrame, least: tuple[int, int], few: int = FEW, splits: int = 0, run: int = RUN) -> DataFrame:
    """(a, b): all pairs of a key of ``p`` (key, used, id, component) within the distance and of different components.

    Keys of up to ``run`` members are compared in one task.  In a larger key the
    members outside its largest component meet all members of other components;
    so a key of one large group and a few others costs few pairs for each
    member.  Larger keys with more than ``few`` others are cut into cells of
    about ``run`` members.  ``splits`` times they are split first, which pays
    only where the members of a key are unlike in most other chunks.
    """
    sizes = p.groupBy("key", "component").agg(F.count("*").alias("c"))
    key = sizes.groupBy("key").agg(F.sum("c").alias("m"), F.max(F.struct("c", "component")).alias("top"))
    key = stash(key.select("key", "m", (F.col("m") - F.col("top.c")).alias("others"), F.col("top.component").alias("top")).where("others > 0"))
    full = classes.select("id", "n", *ALL)
    whole = p.join(key.where(F.col("m") <= run).select("key"), "key").join(full, "id")
    whole = whole.withColumnRenamed("key", "cell").withColumn("side", F.lit(0)).withColumn("guest", F.lit(False))
    if not key.where(F.col("m") > run).limit(1).count():
        return _compared(whole, least)
    large = p.join(key.where(F.col("m") > run).drop("m"), "key")
    some = large.where(F.col("others") <= few).join(full, "id")
    many = large.where(F.col("others") > few)
    if not splits:
        sized = stash(many.join(classes.select("id", "n"), "id").select("key", "used", "out", "id", "component", "n"))
        return _compared(whole.unionByName(_cells(sized, least, run).join(full.drop("n"), "id")), least).union(_met(some, least))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            used = batch.column(1).to_numpy(zero_copy_only=False)
            for done in np.unique(used):  # the chunks left over share the errors that may be left
                at = np.flatnonzero(used == done)
                rows = batch.take(pa.array(at))
                with np.errstate(over="ignore"):
                    row, key, c, _ = chunk_keys(_sig_of(rows), used[at].astype(np.int64), rows.column(0).to_numpy(zero_copy_only=False).view(U64),
                                             MOST_APART // (CHUNKS - int(done).bit_count()))
                more = rows.take(pa.array(row))
                none = pa.nulls(len(row), pa.int32())  # a pair of split keys leaves each of them
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array((done | (1 << c)).astype(np.int32)), none, more.column(2), more.column(3)],
                                                 names=["key", "used", "out", "id", "component"])

    many = many.join(full, "id").select("key", "used", "id", "component", *SIG)
    parts = stash(many.mapInArrow(split, "key long, used int, out int, id binary, component binary"))
    return _compared(whole, least).union(_met(some, least)).union(pairs_apart(parts, classes, least, few, splits - 1, run))


def _cells(p: DataFrame, least: tuple[int, int], run: int) -> DataFrame:
    """``p`` (key, ..., id, n) dealt to cells of about ``run`` rows, in which every pair of a key of like size meets once.

    A set lies in the band of its size and is a guest in the next one, as sets
    that are similar enough lie in one band or in neighbours; two guests do not
    meet.  A band of more rows is dealt to tiles, and a cell holds one tile or
    the two sides of a pair of tiles.
    """
    width = max(1e-3, (math.log(least[1]) - math.log(least[0])) * (1 + 1e-9))
    guest = F.explode(F.array(F.lit(False), F.lit(True))).alias("guest")
    b = p.select("*", guest).withColumn("band", F.floor(F.log("n") / width) + F.col("guest").cast("int"))
    per = b.groupBy("key", "band").agg(F.count("*").alias("m"), F.count(F.when(~F.col("guest"), 1)).alias("own"))
    per = per.where("own > 0 and m > 1").select("key", "band", F.when(F.col("m") <= run, 1).otherwise(F.ceil(2 * F.col("m") / run)).cast("int").alias("tiles"))
    b = b.join(per, ["key", "band"]).withColumn("tile", F.pmod(F.xxhash64("id", "key"), "tiles").cast("int"))
    b = b.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("tile", "met"), F.greatest("tile", "met")
    side = F.when(F.col("tile") == F.col("met"), 0).when(F.col("tile") < F.col("met"), 1).otherwise(2)
    return b.select(F.xxhash64("key", "band", low, high).alias("cell"), side.alias("side"), "guest", "used", "out", "id", "component", "n")


def _first_key(differ: np.ndarray, chunk: int, out: int) -> np.ndarray:
    """Whether the key of ``chunk`` without position ``out`` is the first that pairs differing so have in common."""
    wrong = differ.reshape(len(differ), CHUNKS, PER_CHUNK)
    first = np.argmax(wrong.sum(axis=2) <= 1, axis=1)
    return (first == chunk) & (np.argmax(wrong[:, chunk], axis=1) == out)  # no position wrong: the key without position 0


def _compared(p: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b) of different components within the distance, of cells that fit in a task: members lie together by cell.

    Members of side 0 meet all of their cell, those of side 1 meet those of side 2; guests do not meet guests.
    """
    n = int(p.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = "cell long, side int, guest boolean, used int, out int, id binary, component binary, n long, " + ", ".join(f"{s} long" for s in ALL)
    names = [k.split(" ")[0] for k in kinds.split(", ")]
    d = p.select(*names).repartition(n, "cell").sortWithinPartitions("cell")
    a, b = least

    def pairs(t: pa.Table) -> pa.RecordBatch:
        """Of whole cells lying one after another."""
        t = t.combine_chunks()
        cell, size, side, guest = (t.column(c).to_numpy() for c in ("cell", "n", "side", "guest"))
        sig, fine, bits = (_longs(t.to_batches()[0], c, k) for c, k in ((SIG, np.uint16), (FINE, np.uint8), (MAP, np.uint64)))
        chunk, out = (t.column(c).fill_null(-1).to_numpy() for c in ("used", "out"))
        _, comp = np.unique(np.array(t.column("component").to_pylist(), object), return_inverse=True)
        begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        left, right = [], []
        for s, e in zip(begin.tolist(), [*begin[1:].tolist(), len(cell)]):
            order = s + np.argsort(size[s:e], kind="stable")
            one = not side[s:e].any()
            x, y = (order, order) if one else (order[side[order] == 1], order[side[order] == 2])
            n, comps, guests, maps = size[y], comp[y], guest[y], bits[y].T.copy()
            # sets of like size lie together
            first, last = np.searchsorted(n * b, size[x] * a, "left"), np.searchsorted(n * a, size[x] * b, "right")
            if one:
                first = np.maximum(first, np.arange(1, len(x) + 1))
            for i, f, l in zip(x.tolist(), first.tolist(), last.tolist()):
                if f >= l:
                    continue
                at = comps[f:l] != comp[i]
                if guest[i]:
                    at &= ~guests[f:l]
                # few of the bitmap's longs tell most pairs apart
                most = (b - a) * (n[f:l] + size[i]) // (a + b)
                differ = np.bitwise_count(maps[0, f:l] ^ bits[i, 0]) + np.bitwise_count(maps[1, f:l] ^ bits[i, 1])
                at = np.flatnonzero(at & (differ <= most))
                if not len(at):
                    continue
                differ, most, at = differ[at].astype(np.int64), most[at], at + f
                for j in range(2, len(MAP), 2):
                    differ += np.bitwise_count(maps[j, at] ^ bits[i, j])
                    differ += np.bitwise_count(maps[j + 1, at] ^ bits[i, j + 1])
                    near = differ <= most
                    differ, most, at = differ[near], most[near], at[near]
                if not len(at):
                    continue
                other = y[at]
                wrong = sig[other] != sig[i]
                apart = wrong.sum(axis=1)
                near = apart <= MOST_APART
                if out[i] >= 0:
                    near &= _first_key(wrong, int(chunk[i]).bit_length() - 1, int(out[i]))
                other, apart = other[near], apart[near]
                other = other[apart + (fine[other] != fine[i]).sum(axis=1) <= ALL_APART]
                left.append(np.full(len(other), i))
                right.append(other)
        ids = t.column("id").combine_chunks()
        x, y = (ids.take(pa.array(np.concatenate(z) if z else np.zeros(0, np.int64))) for z in (left, right))
        swap = pc.greater(x, y)
        return pa.RecordBatch.from_arrays([pc.if_else(swap, y, x), pc.if_else(swap, x, y)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            if not t.num_rows:
                continue
            cell = t.column("cell").to_numpy()
            last = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            held = t.slice(last)
            if last:
                yield pairs(t.slice(0, last))
        if held is not None and held.num_rows:
            yield pairs(held)

    return d.mapInArrow(run, "a binary, b binary")


def _met(p: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b) within the distance: members outside the largest component of a key with the members of other components."""
    x, y = p.where(F.col("component") != F.col("top")).alias("x"), p.alias("y")
    cond = (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & _sizes_allow("x", "y", least)
    # two that are both outside meet twice: once is enough
    cond = cond & ((F.col("y.component") == F.col("y.top")) | (F.col("x.id") < F.col("y.id")))
    low, high = F.least("x.id", "y.id"), F.greatest("x.id", "y.id")
    return within(x.join(y, cond).select(low.alias("a"), high.alias("b"), F.struct(*[F.col(f"x.{s}") for s in ["n", *ALL]]).alias("x"),
                                         F.struct(*[F.col(f"y.{s}") for s in ["n", *ALL]]).alias("y")), least).select("a", "b")


def near_copies(docs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST, few: int = FEW) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Two rows are linked when their signatures are within the distance and the
    Jaccard similarity of their full shingle sets is at least ``least[0] /
    least[1]``.  component_id is the smallest doc_id reachable over links,
    itself included; kept tells whether that is the row's own.  A text of fewer
    words is one shingle.  Null and empty texts have no shingles, link with
    nothing, are components of their own and kept.  Rows with one id and
    different texts are told apart by their sets; null ids are linked like
    others but name no component.  An empty table gives no rows, and other
    columns are not read.
    """
    cap_arrow_bytes(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = profile(d, words)
    classes = stash(rows.where("n > 0").groupBy("id").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n", *ALL)]))
    p = stash(posted(classes))
    shared = p.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    p = stash(p.join(shared, "key"))
    x, y = classes.alias("x"), classes.alias("y")
    hubs = p.join(p.groupBy("id").agg(F.sum("m").alias("met")), "id").groupBy("key").agg(F.max(F.struct("met", "id")).alias("x")).select("key", F.col("x.id").alias("hub"))
    star = p.join(hubs, "key").where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    star = within(star.join(y, F.col("b") == F.col("y.id")).join(x, F.col("a") == F.col("x.id")).where(_sizes_allow("x", "y", least)), least)
    nearest = stash(star.groupBy("b").agg(F.min(F.struct("apart", "a")).alias("x")).select("x.a", "b"))
    seen = verified(nearest, d, classes, words, least)
    comp = components(seen.where("linked"))
    members = stash(p.join(comp, "id", "left").select("key", "used", "out", "id", F.coalesce("component", "id").alias("component")))
    left = pairs_apart(members, classes, least, few).distinct()
    tried = seen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = stash(left.join(tried, ["a", "b"], "left_anti"))
    for one_each in (True, True, False):  # a pair for each class first: what that joins need not be tried
        if not left.limit(1).count():
            break
        some = stash(left.groupBy("a").agg(F.min("b").alias("b")).union(left.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")).distinct()) if one_each else left
        seen = stash(seen.union(verified(some, d, classes, words, least)))
        comp = components(seen.where("linked"))
        of = lambda c: comp.select(F.col("id").alias(c), F.col("component").alias(f"_{c}"))
        left = left.join(some, ["a", "b"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left")
        left = stash(left.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b"))
    named = classes.select("id", "doc_id").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = named.join(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select("id", "component_id")
    # written first, so that the join below deals both sides out itself and can split a class of many copies
    out = rows.select("doc_id", "n", "id").join(stash(named), "id", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def query(docs: DataFrame) -> DataFrame:
    return near_copies(docs)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, len(s)::BIGINT AS n, unnest(s) AS g FROM s),
f AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b USING (g) JOIN f USING (g)
  WHERE a.doc_id != b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r(x, low) AS (SELECT x, x FROM c UNION SELECT c.y, r.low FROM r JOIN c ON c.x = r.x),
m AS (SELECT x, min(low) AS low FROM r GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(least(s.doc_id, m.low), s.doc_id) AS component_id,
  s.doc_id IS NOT DISTINCT FROM coalesce(least(s.doc_id, m.low), s.doc_id) AS kept
FROM s LEFT JOIN m ON m.x = s.doc_id
"""
