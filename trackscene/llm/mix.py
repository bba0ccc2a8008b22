"""Mixing sources to target weights (operator 1).

Tokens are summed per source, every source gets a target by its weight, and
each document is emitted ``floor(rate)`` times plus one hash-seeded Bernoulli
copy with probability equal to the fraction, where ``rate`` is target / source
size.  Only the table of sums (a row per source) is ever ordered; documents are
summed map-side first and meet their rate through a join on the source, whose
small side Spark broadcasts by its measured size, so a source with a third of
all rows stays in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, pack, text_of

#: The mix of the query: weights by code point of the source, the share of all sizes, and the most repeats.
WEIGHTS, SHARE, MOST = (5, 2, 1), (3, 2), 2


def word_count(name: str = "text") -> Column:
    return F.regexp_count(text_of(name), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE,
                   most: int = MOST) -> DataFrame:
    """(source, source_size) with weight and target.

    Sources in code-point order, null last, take ``weights`` in turn and share
    ``share`` of all sizes.  A target stops at ``most`` times its source's size
    and the excess goes to the others by weight, until none is above: that is
    one level L with target = min(most * size, weight * L).  Sources sorted by
    most * size / weight reach their stop in that order, so running sums give
    L.  All sums are integers, and the only division is the last one.  A source
    of size 0 has target 0.  The windows hold one row per source, no documents.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), (turn + 1).cast("int"))
    s = sizes.withColumn("weight", w)
    # exact order of size / weight without division: every weight divides their product
    product = 1
    for x in weights:
        product *= x
    order = Window.orderBy(F.col("source_size") * F.floor(F.lit(product) / F.col("weight")), F.col("_source").asc_nulls_last())
    whole = Window.partitionBy()
    s = s.withColumns({
        "_before": F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_w_rest": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "_all": F.sum("source_size").over(whole)})
    # level if all sources before this one are at their stop: (share * all - most * before) / rest of the weights
    num, den = F.col("_all") * share[0] - F.col("_before") * (most * share[1]), F.col("_w_rest") * share[1]
    stops = F.col("source_size") * most * den <= num * F.col("weight")
    s = s.withColumns({"_num": num, "_den": den, "_stops": stops})
    at = F.min(F.when(~F.col("_stops"), F.struct(F.col("source_size") * F.floor(F.lit(product) / F.col("weight")),
                                                F.col("_num"), F.col("_den")))).over(whole)
    s = s.withColumn("_level", at)
    target = F.when(F.col("_stops"), (F.col("source_size") * most).cast("double")).otherwise(
        (F.col("weight") * F.col("_level._num")).cast("double") / F.col("_level._den").cast("double"))
    return s.select("_source", "source_size", "weight", target.alias("target"))


def unit_draw(seed: str, *cols: str) -> Column:
    """A number in [0, 1) from the md5 of the seed and the columns: the same in every run and engine."""
    key = F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def with_copies(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """(row, doc_id, size, source_size, target, copies) of ``docs`` (doc_id, text, source, ...); row has all its columns.

    ``size`` counts words (null text: 0).  Rows with the same doc_id draw the
    same number, so repeated rows are repeated alike.  No documents give no
    rows; null sources are one source; null doc_ids draw as one id.  Other
    columns may have any names.
    """
    d = pack(docs, doc_id=F.col("doc_id"), source=F.col("source").cast("string"), size=word_count())
    sizes = d.groupBy(F.col("source").alias("_source")).agg(F.sum("size").alias("source_size"))
    t = source_targets(sizes, weights, share, most).select("_source", "source_size", "target")
    j = d.join(t, d["source"].eqNullSafe(t["_source"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    j = j.withColumn("_rate", rate)
    whole = F.floor("_rate")
    extra = (unit_draw(seed, "doc_id") < F.col("_rate") - whole).cast("long")
    return j.select("row", "doc_id", "size", "source_size", "target", (whole.cast("long") + extra).alias("copies"))


def mix_sources(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: each document as often as ``with_copies`` says, in the columns of ``docs``."""
    c = with_copies(docs, seed, weights, share, most)
    return c.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def query(docs: DataFrame) -> DataFrame:
    c = with_copies(docs.select("doc_id", "text", "source"))
    return c.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
s AS (SELECT source, n, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS w FROM s0),
fill AS (  -- rounds of resharing: whoever is above the stop is fixed there
  SELECT 0 AS round, source, n, w, FALSE AS fixed,
         (sum(n) OVER () * 3)::HUGEINT AS num, (sum(w) OVER () * 2)::HUGEINT AS den FROM s
  UNION ALL
  SELECT round + 1, source, n, w, nf,
         ((sum(n) OVER () * 3) - coalesce(sum(n * 4) FILTER (WHERE nf) OVER (), 0))::HUGEINT,
         coalesce(sum(w * 2) FILTER (WHERE NOT nf) OVER (), 0)::HUGEINT
  FROM (SELECT *, fixed OR (n * 2 * den <= num * w) AS nf FROM fill)
  WHERE round < 200),
last AS (SELECT * FROM fill WHERE round = 200),
t AS (SELECT source, n AS source_size,
        CASE WHEN fixed OR den = 0 THEN (2 * n)::DOUBLE ELSE (w * num)::DOUBLE / den::DOUBLE END AS target FROM last),
r AS (SELECT doc_id, size, source_size::BIGINT AS source_size, target,
        CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, floor(rate)::BIGINT + CASE WHEN
        ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 < rate - floor(rate)
        THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies::BIGINT AS copies FROM c
"""
