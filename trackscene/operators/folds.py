"""Sampling, folds, class statistics.

Randomness is ``md5(key || ':' || seed)`` so every engine (and every rerun)
agrees.  Per-group top-n uses ``row_number() <= n``, which Spark plans with a
partial ``WindowGroupLimit`` before the shuffle: a group holding a third of
all rows still ships only n rows per map task.

``stratified_folds`` needs the exact rank of a row inside its class.  A plain
window over the class would put a whole (possibly huge) class into one task,
so the rank is assembled from (a) a small count table per (class, md5 prefix
bucket) with running offsets and (b) a row number inside each bucket; buckets
split every class uniformly because md5 is uniform.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(key, seed: int | str) -> Column:
    """Deterministic pseudo-random order key shared with SQL engines."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))


def top_n_per_group(df: DataFrame, n: int, group: str | list[str], order: list[Column]) -> DataFrame:
    """First ``n`` rows per group in ``order`` (ties must be broken by the caller)."""
    g = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*g).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def limit_per_scene(points: DataFrame, n: int, scene: str = "api_id", id_col: str = "id") -> DataFrame:
    """The first ``n`` points by id within each scene."""
    return top_n_per_group(points, n, scene, [F.col(id_col)])


def sample_per_class(df: DataFrame, n: int, seed: int, class_col: str = "label", key: str = "key") -> DataFrame:
    """Up to ``n`` random rows per class (md5 order, reproducible)."""
    return top_n_per_group(df, n, class_col, [hash_order(key, seed), F.col(key)])


#: Folds when the two shares differ, and the bounds.
USUAL_FOLDS, FEWEST_FOLDS, MOST_FOLDS = 5, 3, 20


def folds_count(val_frac: float, test_frac: float) -> int:
    """K = round(1/val) when val == test > 0, else 5; clamped to 3..20."""
    same = val_frac > 0 and math.isclose(val_frac, test_frac, rel_tol=0.0, abs_tol=1e-6)
    wanted = round(1.0 / val_frac) if same else USUAL_FOLDS
    return sorted((FEWEST_FOLDS, wanted, MOST_FOLDS))[1]


def stratified_folds(df: DataFrame, k: int, seed: int, class_col: str = "label", key: str = "key",
                     bucket_hex_digits: int = 4) -> DataFrame:
    """fold = (global rank in (class, md5) order) mod K.

    Classes are laid end to end and dealt round-robin, so every fold gets
    per-class sizes that differ by at most one.  Output adds ``fold`` (BIGINT).
    """
    h = hash_order(key, seed)
    with_b = (df.withColumn("_h", h)
              .withColumn("_b", F.conv(F.substring("_h", 1, bucket_hex_digits), 16, 10).cast("int")))
    counts = with_b.groupBy(class_col, "_b").agg(F.count(F.lit(1)).alias("_n"))
    # running offset over the small (class, bucket) table; its size is bounded by classes x 16^digits
    w_all = Window.orderBy(class_col, "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w_all), F.lit(0))).drop("_n")
    w_in = Window.partitionBy(class_col, "_b").orderBy("_h", key)
    ranked = with_b.withColumn("_r", F.row_number().over(w_in))
    out = ranked.join(offsets, [class_col, "_b"], "inner")
    return (out.withColumn("fold", ((F.col("_off") + F.col("_r") - 1) % k).cast("bigint"))
            .drop("_h", "_b", "_r", "_off"))


def train_rows(folds: DataFrame, r: int, k: int, key: str = "key") -> DataFrame:
    """train = all rows that are neither test nor val in round r: a predicate on the fold, no join."""
    return folds.where(~F.col("fold").isin(r, (r + 1) % k))


def class_counts(df: DataFrame, class_col: str = "label") -> DataFrame:
    """rows per class."""
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))


def class_weights_all_folds(folds: DataFrame, k: int, n_classes: int, class_col: str = "label") -> DataFrame:
    """F5 for every round r of K at once (round, class, weight): the rows are counted
    once per (class, fold), and a fold's count goes to the rounds it trains in."""
    per = folds.groupBy(class_col, "fold").agg(F.count(F.lit(1)).alias("n"))
    r = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint"))).alias("round")
    trains = per.select("*", r).where((F.col("fold") != F.col("round")) & (F.col("fold") != (F.col("round") + 1) % k))
    n = trains.groupBy("round", class_col).agg(F.sum("n").alias("n"))
    dim = folds.sparkSession.range(n_classes).select(F.col("id").alias(class_col), r)
    j = dim.join(n, ["round", class_col], "left")
    total = F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy("round"))
    return j.select("round", class_col, (total / F.greatest(F.lit(1), F.coalesce("n", F.lit(1)))).cast("double").alias("weight"))


def class_weights(train: DataFrame, n_classes: int, class_col: str = "label") -> DataFrame:
    """weight = total / max(1, n_c); a class absent from train counts as 1.

    Labels are indices 0..n_classes-1 (the manifest drops anything else), so the
    total is the sum over the class table; that table has n_classes rows, so
    the un-partitioned window over it is tiny.
    """
    spark = train.sparkSession
    dim = spark.range(n_classes).select(F.col("id").alias(class_col))
    j = dim.join(class_counts(train, class_col), class_col, "left")
    total = F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy())
    return j.select(F.col(class_col), (total / F.greatest(F.lit(1), F.coalesce("n", F.lit(1))))
                    .cast("double").alias("weight"))
