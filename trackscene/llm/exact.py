"""Exact dedup (operator 3).

Texts are equal when identical after deleting white space.  Every row gets a
128-bit hash of its normalised text; rows whose hash occurs once are done
without their text ever moving.  Of the others, the normalised texts
themselves are grouped, so equality inside a hash group is decided on bytes;
the grouping combines map-side, and a group that holds a third of all rows
leaves one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, pack, stash, text_of

#: Keys of this many repeated hashes (16 bytes each, some 100 in memory) are sent to all executors; more are joined by shuffle.
BROADCAST_KEYS = 200_000


def normalised(name: str = "text") -> Column:
    return F.translate(text_of(name), WS_CHARS, "")


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text))


def with_groups(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text,
    then the smallest doc_id stays (null ids last).  A null text is an empty
    one, and all empty texts are one group.  Repeated rows with one doc_id
    count in group_size; those of the id that stays are all marked kept.  An
    empty table gives no rows, and other columns are not read.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_t"))
    d = d.withColumn("_n", F.translate("_t", WS_CHARS, ""))
    base = stash(d.select("doc_id", F.char_length("_t").alias("cp"), hash_of(F.col("_n")).alias("h"),
                          F.unhex(F.sha2("_n", 256)).alias("sha")))
    many = stash(base.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    few = many.count() <= BROADCAST_KEYS
    # the byte check: group the texts themselves, of the repeated hashes only
    same = (d.select(hash_of(F.col("_n")).alias("h"), "_n").join(F.broadcast(many) if few else many, "h", "left_semi")
            .groupBy("h", "_n").agg(F.count("*").alias("group_size"))
            .select("h", F.unhex(F.sha2("_n", 256)).alias("sha"), "group_size").where("group_size > 1"))
    # ~doc_id falls as doc_id grows, and null is the least
    best = (base.join(F.broadcast(many) if few else many, "h", "left_semi").groupBy("h", "sha")
            .agg(F.max(F.struct("cp", F.bitwise_not("doc_id").alias("nid"))).alias("best")))
    g = same.join(best, ["h", "sha"]).select("h", "sha", "group_size", F.bitwise_not("best.nid").alias("keep_id"))
    # written first: few groups are sent to all executors, and beyond that the join deals both sides
    # out itself, so that Spark can split a group of very many copies
    g = stash(g)
    j = base.join(F.broadcast(g) if few else g, ["h", "sha"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return j.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one that ``with_groups`` keeps.

    Rows are told by doc_id and text, so ids that occur with several texts do
    no harm; of rows that repeat both, the one with the longest original text
    stays.  Dropped rows are sent to all executors if few, else joined by shuffle.
    """
    g = stash(with_groups(docs).select("doc_id", F.unhex("text_sha256").alias("_sha"), "kept"))
    gone = stash(g.where("not kept").select(F.col("doc_id").alias("_gone"), "_sha").distinct())
    d = pack(docs, doc_id=F.col("doc_id").cast("long"), key=F.unhex(F.sha2(normalised(), 256)))
    out = d.join(_sent(gone), F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.col("key") == F.col("_sha")), "left_anti")
    again = stash(g.where("kept").groupBy(F.col("doc_id").alias("_again"), "_sha").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    if again.limit(1).count() == 0:
        return out.select("row.*")
    on = F.col("doc_id").eqNullSafe(F.col("_again")) & (F.col("key") == F.col("_sha"))
    single = out.join(_sent(again), on, "left_anti").select("row.*")
    text = text_of("row.text")
    once = (out.join(_sent(again), on, "left_semi").groupBy("doc_id", "key")
            .agg(F.max_by("row", F.struct(F.char_length(text), text)).alias("row")).select("row.*"))
    return single.unionByName(once)


def _sent(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def query(docs: DataFrame) -> DataFrame:
    return with_groups(docs)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
g AS (SELECT n, count(*)::BIGINT AS group_size, max(length(t)) AS cp FROM d GROUP BY n),
k AS (SELECT d.n, min(doc_id) AS keep_id FROM d JOIN g ON d.n = g.n AND length(d.t) = g.cp GROUP BY d.n)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(d.n) AS text_sha256
FROM d JOIN g ON d.n = g.n JOIN k ON d.n = k.n
"""
