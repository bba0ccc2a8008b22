"""Conversation prefix trie (operator 11): fixed-length block hashing.

1. Turns become digests (role and text, 128 bits) and byte counts; texts never
   move.  A range sort deals the turns of all conversations out evenly, so one
   conversation of any length is spread over many tasks.  Each task packs its
   turns into chunks with a running hash of the sequence so far.  The hash is a
   polynomial modulo a prime, so hashes of neighbouring parts compose, and a
   conversation cut by partition borders needs one small row per border.
2. Rebuilding a conversation replaces its first turns by those of another one:
   at most ``HEAD`` digests per conversation are joined, and the composed hash
   gives all later prefixes without touching the turns again.
3. Conversations are grouped by successive blocks of ``BLOCK`` turns: a row is
   (digest before the block, digest after it).  Groups combine map-side, so
   thousands of copies are one row per task.  Only blocks with siblings (other
   blocks after the same prefix) are refined turn by turn.
4. Sums over subtrees need no walk over levels.  A conversation owns the nodes
   of which it is the smallest member; those are the end of its path.  What is
   distinct below a node is then a sum over its members of what they own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, arrow_schema, shuffle_partitions, stash

#: Turns of a block, most turns taken over from another conversation, and most turns in a packed row.
BLOCK, HEAD, CHUNK = 4, 8, 256
#: Conversations of a family share the turns of its first one.
FAMILY = 5
#: Ids packed into one row on their way to the hash of a node's ends.
PACK_IDS = 1 << 15

#: The prime and the base of the sequence hash (fixed values).
PRIME, BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F
ROOT = bytes(16)


def extend(h: int, digest: bytes) -> int:
    """The hash of a sequence, one element longer."""
    return (h * BASE + int.from_bytes(digest, "big")) % PRIME


def joined(left: int, right: int, n: int) -> int:
    """The hash of two sequences one after another; the right one has ``n`` elements."""
    return (left * pow(BASE, n, PRIME) + right) % PRIME


def _raw(h: int) -> bytes:
    return h.to_bytes(16, "big")


def _num(b: bytes) -> int:
    return int.from_bytes(b, "big")


def hash_of(digests) -> int:
    h = 0
    for d in digests:
        h = extend(h, d)
    return h


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, d, n): digest of role and text, and the text's UTF-8 bytes; null role or text is empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("d"),
        F.octet_length(text).cast("long").alias("n"))


CHUNKS = "conv_id long, part int, start long, bytes_before long, hash_before binary, hash_after binary, n int, n_bytes long, ds array<binary>, ns array<long>"
_ARROW_CHUNKS = arrow_schema(CHUNKS)


def chunks(turns: DataFrame) -> DataFrame:
    """Turns in order, packed: a row has up to CHUNK successive turns of a conversation, as one partition holds them."""
    # rows that repeat everything are told apart by where they lie, so that no key is too large for a partition
    t = stash(turns).withColumn("_tie", F.monotonically_increasing_id())
    keys = ["conv_id", F.asc_nulls_first("turn"), "d", "_tie"]
    t = t.repartitionByRange(shuffle_partitions(turns.sparkSession), *keys).sortWithinPartitions(*keys).select("conv_id", "d", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, start, size, h, ds, ns, out = None, 0, 0, 0, [], [], []

        def close():
            nonlocal start, size, h, ds, ns
            if ds:
                after = h
                for d in ds:
                    after = extend(after, d)
                out.append((conv, part, start, size, _raw(h), _raw(after), len(ds), sum(ns), ds, ns))
                start, size, h, ds, ns = start + len(ds), size + sum(ns), after, [], []

        for batch in batches:
            for c, d, n in zip(*(col.to_pylist() for col in batch.columns)):
                if c != conv:
                    close()
                    conv, start, size, h = c, 0, 0, 0
                elif len(ds) == CHUNK:
                    close()
                ds.append(d)
                ns.append(n)
            if out:
                yield arrow_rows(out, _ARROW_CHUNKS)
                out = []
        close()
        if out:
            yield arrow_rows(out, _ARROW_CHUNKS)

    return stash(t.mapInArrow(run, CHUNKS))


def offsets(packed: DataFrame) -> DataFrame:
    """(conv_id, part, off_n, off_bytes, off_hash): what lies in earlier partitions, for conversations cut by a border."""
    cut = packed.groupBy("conv_id").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("conv_id")
    seg = packed.join(cut, "conv_id", "left_semi").groupBy("conv_id", "part").agg(
        F.max_by(F.struct((F.col("start") + F.col("n")).alias("n"), (F.col("bytes_before") + F.col("n_bytes")).alias("b"), "hash_after"), "start").alias("x"))
    seg = seg.select("conv_id", "part", "x.n", "x.b", "x.hash_after")

    def scan(rows: pd.DataFrame) -> pd.DataFrame:  # a row per partition that holds a part of the conversation
        rows = rows.sort_values("part")
        n, b, h, out = 0, 0, 0, []
        for r in rows.itertuples():
            out.append((r.conv_id, r.part, n, b, _raw(h)))
            n, b, h = n + r.n, b + r.b, joined(h, _num(bytes(r.hash_after)), r.n)
        return pd.DataFrame(out, columns=["conv_id", "part", "off_n", "off_bytes", "off_hash"])

    return stash(seg.groupBy("conv_id").applyInPandas(scan, "conv_id long, part int, off_n long, off_bytes long, off_hash binary"))


def placed(packed: DataFrame) -> DataFrame:
    """The chunks with what lies before them in the whole conversation: off_n, off_bytes, off_hash (null: nothing)."""
    return packed.join(offsets(packed), ["conv_id", "part"], "left").withColumn("at", F.coalesce("off_n", F.lit(0)) + F.col("start"))


def heads(chunked: DataFrame) -> DataFrame:
    """(conv_id, own_n, own_bytes, hd, hs): length, bytes and the first HEAD turns of each conversation."""
    left = F.lit(HEAD) - F.col("at").cast("int")
    first = F.when(F.col("at") < HEAD, F.struct("at", F.slice("ds", F.lit(1), left).alias("d"), F.slice("ns", F.lit(1), left).alias("s")))
    g = chunked.groupBy("conv_id").agg(F.sum("n").alias("own_n"), F.sum("n_bytes").alias("own_bytes"),
                                       F.sort_array(F.collect_list(first)).alias("h"))  # at most HEAD parts
    return g.select("conv_id", "own_n", "own_bytes", F.flatten("h.d").alias("hd"), F.flatten("h.s").alias("hs"))


def plans(head: DataFrame) -> DataFrame:
    """(conv_id, h, bd, bs, hd, hs, len, total): how each conversation is rebuilt, and its length and bytes then."""
    c = head.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int"))
    b = head.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("hd").alias("bd"), F.col("hs").alias("bs"))
    j = c.join(b, "base", "left")
    for k in ("bd", "bs"):  # the turns taken over
        j = j.withColumn(k, F.slice(F.coalesce(k, F.array()), F.lit(1), F.col("h")))
    for k in ("hd", "hs"):  # the own turns they replace
        j = j.withColumn(k, F.slice(k, F.lit(1), F.col("h")))
    total = lambda k: F.aggregate(k, F.lit(0).cast("long"), lambda a, x: a + x)
    return j.select("conv_id", "h", "bd", "bs", "hd", "hs", (F.size("bd") + F.greatest(F.col("own_n") - F.col("h"), F.lit(0))).cast("long").alias("len"),
                    (total("bs") + F.col("own_bytes") - total("hs")).alias("total"))


BLOCKS = "conv_id long, k long, at long, head binary, digests array<binary>, sizes array<long>, pre long, whole boolean, len long, total long"
_ARROW_BLOCKS = arrow_schema(BLOCKS)


def pieces_of_blocks(chunked: DataFrame, plan: DataFrame) -> DataFrame:
    """The rebuilt conversations cut at multiples of BLOCK turns: prefix digests before (``head``) and after each turn."""
    need = ["conv_id", "at", "start", "off_bytes", "off_hash", "bytes_before", "hash_before", "ds", "ns", "h", "bd", "bs", "hd", "hs", "len", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                h, nb, at = r["h"], len(r["bd"]), r["at"]
                if at == 0:
                    ds, ns, p, depth, pre = r["bd"] + r["ds"][h:], r["bs"] + r["ns"][h:], 0, 0, 0
                else:
                    skip = max(h - at, 0)
                    ds, ns, own = r["ds"][skip:], r["ns"][skip:], max(at, h)
                    replaced = hash_of(r["hd"])
                    so_far = joined(_num(r["off_hash"] or ROOT), _num(r["hash_before"]), r["start"]) if at >= h else replaced
                    bytes_so_far = (r["off_bytes"] or 0) + r["bytes_before"] if at >= h else sum(r["hs"])
                    p = (so_far + (hash_of(r["bd"]) - replaced) * pow(BASE, own - h, PRIME)) % PRIME
                    depth, pre = nb + own - h, bytes_so_far - sum(r["hs"]) + sum(r["bs"])
                i = 0
                while i < len(ds):
                    k = depth // BLOCK
                    m = min(len(ds) - i, (k + 1) * BLOCK - depth)
                    head, digests = _raw(p), []
                    for d in ds[i:i + m]:
                        p = extend(p, d)
                        digests.append(_raw(p))
                    whole = depth == k * BLOCK and (m == BLOCK or depth + m == r["len"])
                    out.append((r["conv_id"], k, depth, head, digests, ns[i:i + m], pre, whole, r["len"], r["total"]))
                    pre, depth, i = pre + sum(ns[i:i + m]), depth + m, i + m
            if out:
                yield arrow_rows(out, _ARROW_BLOCKS)

    p = stash(chunked.join(plan, "conv_id").select(*need).mapInArrow(run, BLOCKS))
    parts = F.sort_array(F.collect_list(F.struct("at", "head", "digests", "sizes", "pre")))  # at most BLOCK of them
    met = (p.where("not whole").groupBy("conv_id", "k", "len", "total").agg(parts.alias("x"))
           .select("conv_id", "k", F.col("x")[0]["head"].alias("head"), F.flatten("x.digests").alias("digests"), F.flatten("x.sizes").alias("sizes"),
                   F.col("x")[0]["pre"].alias("pre"), "len", "total"))
    names = met.columns
    return p.where("whole").select(names).unionByName(met).withColumn("end", F.element_at("digests", -1))


def refined(blocks: DataFrame, sums: dict) -> DataFrame:
    """The nodes of the distinct blocks: depth, digest, parent, size, pre and ``sums`` over the blocks that share them.

    A block without siblings is a chain: its nodes are its own.  Only where
    blocks go on from one prefix, turns are compared one by one.
    """
    per = F.transform("digests", lambda d, i: F.struct(
        d.alias("digest"), F.when(i == 0, F.col("head")).otherwise(F.get("digests", i - 1)).alias("parent"), F.get("sizes", i).alias("size"),
        (F.col("pre") + F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x)).alias("pre"),
        (F.col("k") * BLOCK + i + 1).alias("depth")))

    def nodes(b: DataFrame) -> DataFrame:
        return b.select(F.explode(per).alias("x"), *sums).select("x.*", *sums)

    sib = blocks.where("k > 0").groupBy("k", "head").agg(F.count("*").alias("_m"))
    b = blocks.where("k > 0").join(sib, ["k", "head"])
    apart = nodes(blocks.where("k = 0").unionByName(b.where("_m > 1").drop("_m"))).groupBy("depth", "digest").agg(
        *[F.first(c).alias(c) for c in ("parent", "size", "pre")], *[f(F.col(c)).alias(c) for c, f in sums.items()])
    chain = nodes(b.where("_m = 1"))
    return chain.unionByName(apart)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of (digest, conv_id): the SHA-256 of each node's ids in order.

    The ids are sorted by range, so a node of very many ends is packed by many
    tasks; the hash itself runs over the packed pieces of a node in order.
    """
    keys = ["digest", "conv_id"]
    e = ends.repartitionByRange(shuffle_partitions(ends.sparkSession), *keys).sortWithinPartitions(*keys)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = arrow_schema("digest binary, first long, ids string")
        node, ids, out = None, [], []
        for batch in batches:
            for d, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (d != node or len(ids) == PACK_IDS):
                    out.append((node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = d
                ids.append(c)
            if out:
                yield arrow_rows(out, kind)
                out = []
        if ids:
            yield arrow_rows([(node, ids[0], ",".join(map(str, ids)))], kind)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = arrow_schema("digest binary, ends_sha256 string")
        node, sha, out = None, None, []
        for batch in batches:
            for d, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if d != node:
                    if node is not None:
                        out.append((node, sha.hexdigest()))
                    node, sha = d, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield arrow_rows(out, kind)
                out = []
        if node is not None:
            yield arrow_rows([(node, sha.hexdigest())], kind)

    p = stash(e.mapInArrow(packed, "digest binary, first long, ids string"))
    return p.repartition(shuffle_partitions(ends.sparkSession), "digest").sortWithinPartitions("digest", "first").mapInArrow(hashed, "digest binary, ends_sha256 string")


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: the columns of ``NODES``.

    ``conversations`` has conv_id, turn, role, text; other columns are not
    read.  Turns are ordered by ``turn``, null first, ties by a digest of role
    and text; null role or text is empty; repeated rows are turns of their own.
    Rows without conv_id belong to no conversation.  Rebuilt, conversation c
    has the first h turns of c - c % 5 (all if fewer, none if there is no such
    conversation) and its own after its first h, with h = crc32(c) % 9.  Texts
    and conversations of any length are whole.  An empty table gives no rows.
    """
    spark = conversations.sparkSession
    chunked = stash(placed(chunks(turn_digests(conversations))))
    plan = stash(plans(heads(chunked)))
    root = plan.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("len").alias("deepest"), F.sum("total").alias("total")).first()
    if root["conv_id"] is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    rows = stash(pieces_of_blocks(chunked, plan))
    key = ["k", F.size("digests").alias("m"), "end"]
    blocks = stash(rows.groupBy(*key).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("len").alias("deepest"),
                                          *[F.first(c).alias(c) for c in ("head", "digests", "sizes", "pre")]))
    # what each conversation owns: the bytes from its first own node on, and its end if nothing goes on from there
    first = refined(blocks, {"conv_id": F.min, "deepest": F.max})
    owners = stash(first.groupBy("conv_id").agg(F.min(F.struct("depth", "pre")).alias("x"), F.sum((F.col("deepest") == F.col("depth")).cast("long")).alias("leaf"))
                   .select("conv_id", F.col("x.pre").alias("own_from"), "leaf"))
    mine = rows.join(owners, "conv_id", "left").select(
        "k", F.size("digests").alias("m"), "end", "conv_id", "total", F.coalesce(F.col("total") - F.col("own_from"), F.lit(0)).alias("own"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    sums = mine.groupBy("k", "m", "end").agg(F.sum("total").alias("total"), F.sum("own").alias("own"), F.sum("leaf").alias("leaf"),
                                             F.min(F.struct("conv_id", "own", "total")).alias("owner"))
    nodes = refined(stash(blocks.drop("conv_id").join(sums, ["k", "m", "end"])),
                    {"n_convs": F.sum, "total": F.sum, "own": F.sum, "leaf": F.sum, "owner": F.min})
    # all bytes below, copies counted, less the distinct ones: those of the owner from here on and what the others own
    saved = F.col("total") - F.col("n_convs") * F.col("pre") - (F.col("own") - F.col("owner.own") + F.col("owner.total") - F.col("pre"))
    nodes = stash(nodes.select(F.col("owner.conv_id").alias("conv_id"), "depth", "digest", "parent", "n_convs", F.col("leaf").alias("n_leaves"), saved.alias("saved_tokens")))
    all_own = plan.join(owners, "conv_id").agg(F.sum(F.col("total") - F.col("own_from")).alias("own"), F.sum("leaf").alias("leaf")).first()
    top = spark.createDataFrame([(root["conv_id"], 0, ROOT, None, root["n_convs"], all_own["leaf"] if root["deepest"] else 1, root["total"] - (all_own["own"] or 0))],
                                "conv_id long, depth long, digest binary, parent binary, n_convs long, n_leaves long, saved_tokens long")
    ends = rows.where(F.col("k") * BLOCK + F.size("digests") == F.col("len")).select(F.col("end").alias("digest"), "conv_id").unionByName(
        plan.where("len = 0").select(F.lit(ROOT).alias("digest"), "conv_id"))
    children = nodes.groupBy(F.col("parent").alias("digest")).agg(F.count("*").alias("n_children"))
    named = nodes.unionByName(top).join(children, "digest", "left").join(end_hashes(ends), "digest", "left")
    above = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = named.where("depth > 1").join(above, "parent").unionByName(
        named.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root["conv_id"]).cast("long"))))
    return out.select(*[F.coalesce(c, F.lit(0)).cast("long").alias(c) if c == "n_children" else
                        F.coalesce(c, F.lit(hashlib.sha256(b"").hexdigest())).alias(c) if c == "ends_sha256" else F.col(c).cast("long").alias(c) for c in NODES])


def query(conversations: DataFrame) -> DataFrame:
    return prefix_trie(conversations)


ORACLE = r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, md5(length(role)::VARCHAR || ':' || role || text)) AS own FROM t GROUP BY c),
p AS (SELECT c, own, xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295::BIGINT), 4294967295) % 9 AS h FROM o),
r AS (SELECT p.c, list_concat(coalesce(b.own, [])[1:p.h], p.own[p.h + 1:]) AS turns FROM p LEFT JOIN o b ON b.c = p.c - p.c % 5),
d AS (SELECT c, len(turns) AS n, list_transform(turns, lambda x: strlen(x.t)) AS sizes,
    list_transform(range(0, len(turns) + 1), lambda i: md5(turns[1:i]::VARCHAR || i)) AS path FROM r),
m AS (SELECT c, n, path, i AS depth, path[i + 1] AS node, coalesce(path[i], '') AS parent, CASE WHEN i = 0 THEN 0 ELSE sizes[i] END AS size FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM d)),
g AS (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(path[1:depth + 1]) AS up, any_value(size) AS size, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = depth), '') AS ends FROM m GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM g GROUP BY parent),
x AS (SELECT g.*, coalesce(k.n_children, 0) AS n_children FROM g LEFT JOIN k USING (node)),
s AS (SELECT node, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
    FROM (SELECT unnest(up) AS node, n_children, n_convs, size FROM x) GROUP BY node)
SELECT x.conv_id, x.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, x.n_convs::BIGINT AS n_convs, x.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM x JOIN s USING (node) LEFT JOIN x u ON u.node = x.parent
"""
