"""Running totals over a whole table without one task for all rows, and stored id ranges."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def running_total(df: DataFrame, order: list[str], value: str, out: str) -> tuple[DataFrame, int]:
    """``df`` with ``out`` = the sum of ``value`` over all rows before it in ``order``, and the sum of all.

    Two levels: a range sort deals the rows out in order, a window inside each
    range sums there, and the ranges' totals (a row for each partition) are
    summed once.  ``order`` must tell rows apart.  The sorted rows are written
    before they are read twice, so both levels see the same ranges.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    d = cut_lineage(d)
    before, offsets = 0, []
    for r in d.groupBy("_range").agg(F.sum(value).alias("s")).orderBy("_range").collect():  # at most n rows
        offsets.append((r["_range"], before))
        before += int(r["s"] or 0)
    w = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    base = F.create_map(*[F.lit(x) for pair in offsets for x in pair])[F.col("_range")] if offsets else F.lit(0)
    return d.withColumn(out, base.cast("long") + F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long")).drop("_range"), before


def reserve_ids(spark, marks: str, load: str, n: int) -> int:
    """The first id of ``load``, which takes ``n`` ids after those of all loads before; the same again when it is repeated.

    ``marks`` is a Parquet folder with a row for each load; one writer at a
    time.  A load that is repeated with another number of rows is refused once
    later loads have taken ids.
    """
    seen: list = []
    try:
        seen = spark.read.parquet(marks).select("load", "first_id", "next_id").collect()  # a row for each load
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    own = [r for r in seen if r["load"] == load]
    if own:
        if own[0]["next_id"] - own[0]["first_id"] != n:
            raise ValueError(f"load {load!r} had {own[0]['next_id'] - own[0]['first_id']} rows, now {n}")
        return own[0]["first_id"]
    first = max((r["next_id"] for r in seen), default=1)
    spark.createDataFrame([(load, first, first + n)], "load string, first_id long, next_id long").coalesce(1).write.mode("append").parquet(marks)
    return first


def with_row_id(df: DataFrame, source_cols=("path", "member"), line_col: str = "record_no", out: str = "id", *,
                marks: str | None = None, load: str | None = None) -> DataFrame:
    """A unique BIGINT id, the same in every rerun: the records of the sources before, and the number inside the source.

    Sources (files, archive members) are numbered in the order of
    ``source_cols``, null first.  Only a row for each source is shuffled and
    sorted; records meet their source's offset in a join.  With ``marks`` and
    ``load`` ids go on after those of earlier loads (``reserve_ids``), and a
    load that is repeated gets its own ids again.
    """
    spark = df.sparkSession
    per = df.groupBy(*source_cols).agg(F.max(line_col).cast("long").alias("_n"))
    offsets, total = running_total(per, list(source_cols), "_n", "_off")
    first = reserve_ids(spark, marks, load, total) if marks else 1
    d, o = df.alias("_d"), offsets.alias("_o")
    same = [F.col(f"_d.`{c}`").eqNullSafe(F.col(f"_o.`{c}`")) for c in source_cols]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return d.join(o, cond).select("_d.*", (F.col("_o._off") + F.col(f"_d.`{line_col}`") + F.lit(first - 1)).cast("bigint").alias(out))
