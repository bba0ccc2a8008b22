"""N-gram Jaccard join (operator 10): prefix filtering, rarest n-grams first.

1. Every text becomes its set of 5-word shingles (64-bit numbers).  A fixed-size
   count table of all shingles of all rows tells common ones from rare ones, and
   equal sets are one class, named by a 64-bit digest, so copies never meet.
2. Two sets with Jaccard >= t share an n-gram among the first
   n - ceil(t n) + 1 of each in any common order; rare ones go first.  These
   prefixes are posted to buckets in packed arrays, and only n-grams posted more
   than once go on.  What the count table shows as very frequent goes on without
   being gathered, in pieces of bounded size.
3. Links are looked for in two rounds.  First each class meets the hubs of its
   n-grams, a pair for each posting at most; a hub is the member in which the
   n-gram comes earliest, that is which has the fewest n-grams of its own, so a
   large group of near copies falls to its centre.  Linked classes are joined to
   components.  The second round takes all pairs of an n-gram that are still in
   different components, so no link between them is lost.
4. A pair leaves the join only if length, position and the parity bitmaps of
   the two sets allow the similarity (bits that differ stand for n-grams that
   differ).  Sets too large for that bitmap have a wider one of a bit or two a
   member, which pairs of them must pass too; what is left is verified once on
   the sets, after the suffix filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cap_arrow_bytes
from .common import BYTE_CODE, ONE, U64, lower_ascii, mix64, pack, pieces, shuffle_partitions, span_hashes, stash, utf8, word_spans
from .components import components

WORDS, LEAST = 5, (80, 100)
PIECE_BYTES = 1 << 19
#: Slots of the count table: 4 MB at any size of the corpus.
SLOT_BITS, RANGE_BITS = 20, 16
#: Longs of a class's parity bitmap.
BITMAP = 8
BITS = [f"b{i}" for i in range(BITMAP)]
#: Members beyond which a set has a wide bitmap besides.
WIDE_FROM = 64 * BITMAP
#: Postings gathered before they are dealt to buckets, and ids up to which a set of ids is sent to all executors.
FLUSH, BROADCAST_IDS = 1 << 19, 200_000


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted set of shingles of each row: ``words`` words in sequence, or the whole sequence if it is shorter."""
    data = lower_ascii(data)
    start, end, first = word_spans(data, off)
    h = span_hashes(BYTE_CODE[data], start, end) if len(start) else np.zeros(0, U64)
    roll = np.zeros(max(0, len(h) - words + 1), U64)
    for j in range(words):
        roll = roll * U64(0xC2B2AE3D27D4EB4F) + h[j:len(h) - words + 1 + j]
    roll = mix64(roll)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            yield np.unique(roll[a:b - words + 1])
        elif b > a:
            whole = U64(b - a)
            for x in h[a:b]:
                whole = mix64((whole * U64(0xC2B2AE3D27D4EB4F) + x) ^ U64(0x5851F42D4C957F2D))
            yield np.array([whole], U64)
        else:
            yield np.zeros(0, U64)


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, order aside."""
    return int(mix64(s ^ U64(0x243F6A8885A308D3)).sum(dtype=U64)), int(mix64(s * U64(0x13198A2E03707345) + ONE).sum(dtype=U64))


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, set) of each row of (doc_id, text)."""
    data, off = utf8(batch.column(1))
    ids = batch.column(0).to_pylist()
    with np.errstate(over="ignore"):
        for a, b in pieces(off, PIECE_BYTES):
            yield from zip(ids[a:b], shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a], words))


def parity(s: np.ndarray) -> np.ndarray:
    """A bitmap in which each member flips a bit: two sets differ in at least as many members as their bitmaps in bits."""
    bits = np.bincount((mix64(s) >> U64(64 - 9)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def wide_parity(s: np.ndarray) -> bytes | None:
    """A parity bitmap of a bit a member at least, its size a power of two; None for sets that the plain one serves."""
    if len(s) <= WIDE_FROM:
        return None
    k = (len(s) - 1).bit_length()
    bits = np.bincount((mix64(s) >> U64(64 - k)).astype(np.int64), minlength=1 << k) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def wide_allows(x: bytes, y: bytes, n: int, least: tuple[int, int]) -> bool:
    """Whether the wide bitmaps of two sets of ``n`` members together allow them to be similar enough."""
    a, b = least
    x, y = (np.unpackbits(np.frombuffer(w, np.uint8), bitorder="little") for w in (x, y))
    while len(x) != len(y):  # the larger one folds: neighbours stand for the same leading bits
        if len(x) > len(y):
            x = x[0::2] ^ x[1::2]
        else:
            y = y[0::2] ^ y[1::2]
    return (a + b) * int(np.count_nonzero(x != y)) <= (b - a) * n


def _signed(x) -> np.ndarray:
    return np.array(x, U64).view(np.int64)


def profile(docs: DataFrame, words: int) -> tuple[DataFrame, np.ndarray]:
    """((doc_id, n, id, wide, bits): size, digest and bitmaps of each row's set; the count table of all shingles)."""
    names = ["doc_id", "n", "id", "part", "slots", "wide", *BITS]
    kinds = "doc_id long, n long, id long, part int, slots binary, wide binary, " + ", ".join(f"{b} long" for b in BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SLOT_BITS, np.int64)

        def count(seen):
            if seen:
                at = (np.concatenate(seen) >> U64(64 - SLOT_BITS)).astype(np.int64)
                slots[:] += np.bincount(at, minlength=len(slots))

        for batch in batches:
            ids, n, d, bits, wide, seen, held = [], [], [], [], [], [], 0
            for doc, s in _sets(batch, words):
                ids.append(doc)
                n.append(len(s))
                d.append(digest(s)[0])
                bits.append(parity(s))
                wide.append(wide_parity(s))
                seen.append(s)
                held += len(s)
                if held > 1 << 20:
                    count(seen)
                    seen, held = [], 0
            count(seen)
            m = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(_signed(d)),
                                              pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.array(wide, pa.binary()),
                                              *map(pa.array, np.array(bits, np.int64).reshape(m, BITMAP).T.copy())], names=names)
        if slots.any():
            parts = slots.reshape(-1, 1 << RANGE_BITS)
            m = len(parts)
            yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64())] * 3 + [
                pa.array(range(m), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()), pa.nulls(m, pa.binary()), *[pa.nulls(m, pa.int64())] * BITMAP], names=names)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in parts:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(raw, np.int64)
                total[k] = total[k] + x if k in total else x
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                         names=["part", "slots"])

    ranges = 1 << (SLOT_BITS - RANGE_BITS)
    got = stash(docs.mapInArrow(run, kinds))
    counts = got.where("part is not null").select("part", "slots").repartition(ranges, "part").mapInArrow(add, "part int, slots binary")
    table = np.zeros((ranges, 1 << RANGE_BITS), np.int64)
    for r in counts.collect():  # 16 rows whatever the corpus
        table[r["part"]] = np.frombuffer(bytes(r["slots"]), np.int64)
    return got.where("part is null").drop("part", "slots"), table.ravel()


def frequent_count(slots: np.ndarray) -> int:
    """The count from which an n-gram's postings are not gathered by n-gram: far above what rare ones add up to in a slot."""
    return max(1 << 14, int(4 * slots.mean()) + (1 << 12))


POSTING = np.dtype([("g", "<u8"), ("id", "<i8"), ("n", "<u4"), ("pos", "<u4")])


def postings(docs: DataFrame, slots: np.ndarray, words: int, least: tuple[int, int]) -> DataFrame:
    """(g, id, n, pos): prefix n-grams that more than one class has, with their place in the class's order."""
    spark = docs.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    frequent = frequent_count(slots)
    table = spark.sparkContext.broadcast(np.minimum(slots, (1 << 31) - 1).astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, held, size, turn = table.value, set(), [], 0, TaskContext.get().partitionId()

        def flush(held, turn):
            p = np.concatenate(held)
            hot = counts[(p["g"] >> U64(64 - SLOT_BITS)).astype(np.int64)] > frequent
            b = np.where(hot, buckets + turn % buckets, (mix64(p["g"]) % U64(buckets)).astype(np.int64))
            order = np.argsort(b, kind="stable")
            p, b = p[order], b[order]
            at = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            cut = np.append(at, len(b))
            return pa.RecordBatch.from_arrays(
                [pa.array(b[at].astype(np.int32)), pa.array([p[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary())],
                names=["bucket", "packed"])

        for batch in batches:
            for _, s in _sets(batch, words):
                if not len(s):
                    continue
                d = digest(s)
                if d in seen:
                    continue  # this task has posted the class
                seen.add(d)
                n = len(s)
                order = np.argsort(counts[(s >> U64(64 - SLOT_BITS)).astype(np.int64)], kind="stable")
                g = s[order[:n - -(-least[0] * n // least[1]) + 1]]
                p = np.empty(len(g), POSTING)
                p["g"], p["id"], p["n"], p["pos"] = g, _signed([d[0]])[0], n, np.arange(len(g))
                held.append(p)
                size += len(p)
                if size >= FLUSH:
                    yield flush(held, turn)
                    held, size, turn = [], 0, turn + 7
        if held:
            yield flush(held, turn)

    def shared(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        p = np.frombuffer(b"".join(group.column("packed").to_pylist()), POSTING)
        if key[0].as_py() < buckets:
            p = p[np.lexsort((p["id"], p["g"]))]
            first = np.concatenate([[True], (p["g"][1:] != p["g"][:-1]) | (p["id"][1:] != p["id"][:-1])])
            p = p[first]  # several tasks may have posted one class
            same = p["g"][1:] == p["g"][:-1]
            p = p[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        return pa.table({"g": _signed(p["g"]), "id": p["id"].astype(np.int64), "n": p["n"].astype(np.int32), "pos": p["pos"].astype(np.int32)})

    got = docs.mapInArrow(run, "bucket int, packed binary").groupBy("bucket").applyInArrow(shared, "g long, id long, n int, pos int")
    return stash(got)


def _possible(x: str, y: str, least: tuple[int, int]) -> Column:
    """Whether the sets of two postings (prefixes of their columns) may be similar enough, by length and position."""
    a, b = least
    nx, ny, px, py = (F.col(f"{t}.{k}") for k in ("n", "pos") for t in (x, y))
    overlap = F.least(px, py) + 1 + F.least(nx - 1 - px, ny - 1 - py)
    return (b * F.least(nx, ny) >= a * F.greatest(nx, ny)) & ((a + b) * overlap >= a * (nx + ny))


def _near_bits(x: str, y: str, least: tuple[int, int]) -> Column:
    """Whether the bitmaps of two classes allow their sets to be similar enough."""
    a, b = least
    differ = sum((F.bit_count(F.col(f"{x}.{k}").bitwiseXOR(F.col(f"{y}.{k}"))) for k in BITS), F.lit(0))
    return (a + b) * differ <= (b - a) * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def jaccard_links(x: np.ndarray, y: np.ndarray, least: tuple[int, int]) -> bool:
    """Exact test of two sorted sets, after the suffix filter: parts of the two between equal pivots bound the overlap."""
    a, b = least
    need = -(-a * (len(x) + len(y)) // (a + b))
    pivots = (np.arange(1, 32, dtype=U64) << U64(59))
    px = np.diff(np.searchsorted(x, pivots), prepend=0, append=len(x))
    py = np.diff(np.searchsorted(y, pivots), prepend=0, append=len(y))
    if np.minimum(px, py).sum() < need:
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return b * common >= a * (len(x) + len(y) - common)


def set_table(docs: DataFrame, rows: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, s): the sets of the classes ``ids``, each made from one row that has it."""
    # one row a class first, so that a class of very many copies is no hot key of the join
    one = rows.groupBy("id").agg(F.min(F.coalesce("doc_id", F.lit(-1))).alias("_pick"))
    pick = stash(one.join(ids, "id", "left_semi").select("_pick").distinct())
    few = pick.count() <= BROADCAST_IDS
    d = docs.join(F.broadcast(pick) if few else pick, F.coalesce(docs["doc_id"], F.lit(-1)) == pick["_pick"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got, size = [], 0
            for _, s in _sets(batch, words):
                if len(s):
                    got.append(s)
                    size += len(s)
                if size > FLUSH:
                    yield rows_of(got)
                    got, size = [], 0
            if got:
                yield rows_of(got)

    def rows_of(got):
        return pa.RecordBatch.from_arrays([pa.array(_signed([digest(s)[0] for s in got])), pa.array([s.tobytes() for s in got], pa.binary())],
                                          names=["id", "s"])

    sets = d.mapInArrow(run, "id long, s binary")
    repeated = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    return stash(sets.dropDuplicates(["id"]) if repeated else sets)  # without repeated ids each class was picked once


def _near_wide(pairs: DataFrame, wide: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose wide bitmaps allow the similarity; one that lacks a bitmap stays."""
    j = pairs.join(wide.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("wide").alias("wa")).hint("merge"), "a", "left")
    j = j.join(wide.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("wb")).hint("merge"), "b", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, wa, wb = batch.column(2).to_pylist(), batch.column(3), batch.column(4)
            ok = [m is None or wide_allows(wa[i].as_buffer(), wb[i].as_buffer(), m, least) for i, m in enumerate(n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return j.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "wa", "wb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, bits: DataFrame, wide: DataFrame, docs: DataFrame, rows: DataFrame, words: int, least: tuple[int, int],
             seen: DataFrame | None = None) -> DataFrame:
    """(a, b, linked) of each pair of classes (a, b) that the bitmaps allow, once, less those in ``seen``."""
    p = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    p = p if seen is None else p.join(seen, ["a", "b"], "left_anti")
    x, y = bits.alias("x"), bits.alias("y")
    p = p.join(x, F.col("a") == F.col("x.id")).join(y, F.col("b") == F.col("y.id")).where(_near_bits("x", "y", least)).select("a", "b")
    p = stash(_near_wide(p, wide, least))
    if not p.limit(1).count():
        return p.withColumn("linked", F.lit(False))
    sets = set_table(docs, rows, p.select(F.col("a").alias("id")).union(p.select("b")).distinct(), words)
    # merge joins at every size: sets are never broadcast, and a hub of many pairs is a skewed key that Spark splits
    j = p.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")).hint("merge"), "a")
    j = j.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")).hint("merge"), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = batch.column(2), batch.column(3)
            ok = [jaccard_links(np.frombuffer(sa[i].as_buffer(), U64), np.frombuffer(sb[i].as_buffer(), U64), least) for i in range(len(sa))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "linked"])

    return stash(j.mapInArrow(run, "a long, b long, linked boolean"))


def near_copies(docs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST, with_class: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Two rows are linked when the Jaccard similarity of their shingle sets is at
    least ``least[0] / least[1]``; component_id is the smallest doc_id reachable
    over links, itself included (``with_class`` adds the names of each row's
    class and component).  A text of fewer words is one shingle.  Null
    and empty texts have no shingles, link with nothing, and are components of
    their own.  Rows with one id and different texts are told apart by their
    sets; null ids are linked like others but are no component's name.  An empty
    table gives no rows, and other columns are not read.
    """
    cap_arrow_bytes(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, slots = profile(d, words)
    p = postings(d, slots, words, least)
    posted = p.select("id").distinct()
    bits = stash(rows.select("id", "n", *BITS).join(posted, "id", "left_semi").dropDuplicates(["id"]))
    wide = stash(rows.where("wide is not null").select("id", "n", "wide").join(posted, "id", "left_semi").dropDuplicates(["id"]))
    hubs = p.groupBy("g").agg(F.count("*").alias("m"), F.min(F.struct("pos", "id", "n")).alias("hub"))
    p = stash(p.join(hubs, "g").where("id != hub.id"))
    met = p.alias("x").where(_possible("x", "x.hub", least)).select(F.col("id").alias("a"), F.col("hub.id").alias("b"))
    seen = verified(met, bits, wide, d, rows, words, least)
    comp = components(seen.where("linked"))
    # all pairs of an n-gram without its hub, which has met all others, that are still apart
    c = p.where("m > 2").select("g", "id", "pos").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = c.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("g")
    c = stash(c.join(open_, "g", "left_semi").join(bits, "id"))
    x, y = c.alias("x"), c.alias("y")
    left = x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component"))
                  & _possible("x", "y", least) & _near_bits("x", "y", least)).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    rest = verified(left, bits, wide, d, rows, words, least, seen)
    if rest.where("linked").limit(1).count():
        comp = components(seen.union(rest).where("linked"))
    classes = (rows.where("n > 0").groupBy("id").agg(F.min("doc_id").alias("doc")).join(comp, "id", "left")
               .withColumn("component", F.coalesce("component", "id")))
    named = classes.join(classes.groupBy("component").agg(F.min("doc").alias("component_id")), "component").select("id", "component", "component_id")
    # written first, so that the join below deals both sides out itself and can split a class of many copies
    out = rows.join(stash(named), "id", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    more = [F.col("id").alias("class"), "component"] if with_class else []
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), *more)


def keep_one(docs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame:
    """``docs`` with one row of each component, that of its smallest doc_id; rows without words all stay.

    Where ids repeat or are null, rows are told by id and shingle set, the
    smallest of both stays, and of rows that repeat both any one.
    """
    near = stash(near_copies(docs, words, least, with_class=True))
    odd = near.where("doc_id is null").limit(1).count() or near.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    if not odd:
        gone = stash(near.where("doc_id != component_id").select(F.col("doc_id").alias("_gone")))
        few = gone.count() <= 5 * BROADCAST_IDS
        d = pack(docs, doc_id=F.col("doc_id").cast("long"))
        return d.join(F.broadcast(gone) if few else gone, F.col("doc_id") == F.col("_gone"), "left_anti").select("row.*")
    stays = (near.where("n_shingles > 0").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "class")).alias("x"))
             .select(F.col("x.doc_id").alias("_id"), F.col("x.class").alias("_class")))
    p = pack(docs, doc_id=F.col("doc_id").cast("long"), text=F.col("text").cast("string"))

    def name_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.RecordBatch.from_arrays(batch.columns[1:], names=["doc_id", "text"])
            d = [digest(s)[0] if len(s) else None for _, s in _sets(pair, words)]
            ids = pa.array([None if x is None else int(_signed([x])[0]) for x in d], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], ids], names=["row", "doc_id", "named"])

    from pyspark.sql import types as T
    d = p.mapInArrow(name_class, T.StructType([p.schema["row"], p.schema["doc_id"], T.StructField("named", T.LongType())]))
    kept = d.join(stays, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("named") == F.col("_class")), "left_semi")
    once = kept.groupBy("doc_id", "named").agg(F.first("row").alias("row")).select("row.*")
    return once.unionByName(d.where("named is null").select("row.*"))


def query(docs: DataFrame) -> DataFrame:
    return near_copies(docs)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, len(s)::BIGINT AS n, unnest(s) AS g FROM s),
f AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b USING (g) JOIN f USING (g)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING a.doc_id != b.doc_id AND 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(x, low) AS (SELECT x, x FROM c UNION SELECT c.y, r.low FROM r JOIN c ON c.x = r.x),
m AS (SELECT x, min(low) AS low FROM r GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(least(s.doc_id, m.low), s.doc_id) AS component_id
FROM s LEFT JOIN m ON m.x = s.doc_id
"""
