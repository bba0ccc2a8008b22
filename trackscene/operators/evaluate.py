"""Classifier evaluation as aggregations.

Input: one row per prediction with ``y_true``, ``y_pred`` (class indices),
optionally ``scores`` (array, one per class) and ``fold``.  Every metric is a
grouped aggregation over (fold, class) cells -- the class grid is generated
with ``range`` (n_folds x n_classes^2 rows), never by a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def argmax_first(scores) -> Column:
    """Index of the first maximum (ties -> lowest index)."""
    s = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(s, F.array_max(s)) - 1).cast("bigint")


def in_top_k(scores, label, k: int) -> Column:
    """true label among the k best scores (ties ordered by class index)."""
    s = F.col(scores) if isinstance(scores, str) else scores
    lab = F.col(label) if isinstance(label, str) else label
    ranked = F.array_sort(F.transform(s, lambda x, i: F.struct((-x).alias("neg"), i.alias("idx"))))
    return F.array_contains(F.transform(F.slice(ranked, 1, k), lambda t: t["idx"]), lab.cast("int"))


def _grid(spark, n_classes: int, n_folds: int | None) -> DataFrame:
    cells = n_classes * n_classes * (n_folds or 1)
    g = spark.range(cells)
    cols = [(F.col("id") % n_classes).alias("y_pred"),
            ((F.col("id") / n_classes).cast("bigint") % n_classes).alias("y_true")]
    if n_folds:
        cols.insert(0, (F.col("id") / (n_classes * n_classes)).cast("bigint").alias("fold"))
    return g.select(*cols)


def confusion(pred: DataFrame, n_classes: int, n_folds: int | None = None) -> DataFrame:
    """F10 (per fold when ``n_folds``): dense matrix, zero cells included."""
    keys = (["fold"] if n_folds else []) + ["y_true", "y_pred"]
    counts = pred.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    grid = _grid(pred.sparkSession, n_classes, n_folds)
    return grid.join(counts, keys, "left").select(*keys, F.coalesce("n", F.lit(0)).alias("n"))


def confusion_normalized(cm: DataFrame) -> DataFrame:
    """each row divided by max(row sum, 1e-6)."""
    part = ["fold", "y_true"] if "fold" in cm.columns else ["y_true"]
    row = F.sum("n").over(Window.partitionBy(*part))
    return cm.withColumn("rate", F.col("n") / F.greatest(row.cast("double"), F.lit(1e-6)))


def confusion_sum(cm: DataFrame) -> DataFrame:
    """confusion summed over folds."""
    return cm.groupBy("y_true", "y_pred").agg(F.sum("n").cast("bigint").alias("n"))


def per_class(cm: DataFrame) -> DataFrame:
    """F12 per class (and fold): tp, support, predicted, precision, recall, f1
    with 0 on zero division."""
    by = ["fold"] if "fold" in cm.columns else []
    # a cell of the matrix counts for its true class and for its predicted one: one aggregation, no join
    zero, n = F.lit(0).cast("bigint"), F.col("n").cast("bigint")
    both = F.array(F.struct(F.col("y_true").alias("cls"), F.when(F.col("y_true") == F.col("y_pred"), n).otherwise(zero).alias("tp"),
                            n.alias("support"), zero.alias("predicted")),
                   F.struct(F.col("y_pred").alias("cls"), zero.alias("tp"), zero.alias("support"), n.alias("predicted")))
    j = cm.select(*by, F.inline(both)).groupBy(*by, "cls").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    j = j.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return j.withColumn("f1", f1)


def summary_metrics(pc: DataFrame) -> DataFrame:
    """F12/F13 roll-up per fold: accuracy, macro f1 (unweighted over all classes),
    weighted f1 (by support), macro/weighted precision and recall."""
    by = ["fold"] if "fold" in pc.columns else []
    tot = F.sum("support")
    return pc.groupBy(*by).agg(
        F.coalesce(F.try_divide(F.sum("tp").cast("double"), tot.cast("double")), F.lit(0.0)).alias("acc"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        F.coalesce(F.try_divide(F.sum(F.col("precision") * F.col("support")), tot.cast("double")), F.lit(0.0))
        .alias("weighted_precision"),
        F.coalesce(F.try_divide(F.sum(F.col("recall") * F.col("support")), tot.cast("double")), F.lit(0.0))
        .alias("weighted_recall"),
        F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), tot.cast("double")), F.lit(0.0))
        .alias("weighted_f1"),
        tot.cast("bigint").alias("support"))


def classification_report(pred: DataFrame, class_names: Sequence[str]) -> DataFrame:
    """sklearn-style report as rows: one per class, 'macro avg',
    'weighted avg' and 'accuracy' (f1 column holds the accuracy)."""
    n = len(class_names)
    pc = per_class(confusion(pred, n))
    names = F.element_at(F.array(*[F.lit(c) for c in class_names]), (F.col("cls") + 1).cast("int"))
    rows = pc.select(names.alias("label"), "precision", "recall", "f1", F.col("support").cast("bigint").alias("support"))
    sm = summary_metrics(pc)
    none = F.lit(None).cast("double")
    lines = [("macro avg", F.col("macro_precision"), F.col("macro_recall"), F.col("macro_f1")),
             ("weighted avg", F.col("weighted_precision"), F.col("weighted_recall"), F.col("weighted_f1")),
             ("accuracy", none, none, F.col("acc"))]
    totals = sm.select(F.inline(F.array(*[F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"), "support")
                                          for name, p, r, f in lines])))
    return rows.unionByName(totals)


def topk_by_fold(pred: DataFrame, k: int = 2) -> DataFrame:
    """per fold the sample count, accuracy and top-k accuracy."""
    by = ["fold"] if "fold" in pred.columns else []
    hit = F.when(in_top_k("scores", "y_true", k), 1).otherwise(0)
    return pred.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                                 F.avg(F.when(F.col("y_true") == F.col("y_pred"), 1.0).otherwise(0.0)).alias("acc"),
                                 F.avg(hit.cast("double")).alias(f"top{k}"))


def cv_summary(folds: DataFrame, pred_test: DataFrame, n_classes: int, n_folds: int, k: int = 2) -> DataFrame:
    """per fold r: n_train, n_val (= size of fold r+1), n_test, acc,
    top-k, macro f1, weighted f1 on the test fold."""
    sizes = (folds.groupBy("fold").agg(F.count(F.lit(1)).alias("_size"))
             .withColumn("_total", F.sum("_size").over(Window.partitionBy())))  # K rows
    val = sizes.select(((F.col("fold") - 1 + n_folds) % n_folds).cast("bigint").alias("fold"),
                       F.col("_size").alias("n_val"))
    test = sizes.select("fold", F.col("_size").alias("n_test"), "_total")
    pc = per_class(confusion(pred_test, n_classes, n_folds))
    sm = summary_metrics(pc).select("fold", "acc", "macro_f1", "weighted_f1")
    tk = topk_by_fold(pred_test, k).select("fold", F.col(f"top{k}"))
    j = test.join(val, "fold").join(sm, "fold").join(tk, "fold")
    return j.select("fold", (F.col("_total") - F.col("n_val") - F.col("n_test")).cast("bigint").alias("n_train"),
                    F.col("n_val").cast("bigint"), F.col("n_test").cast("bigint"),
                    "acc", F.col(f"top{k}"), "macro_f1", "weighted_f1")


def cv_stats(summary: DataFrame, metrics: Sequence[str] = ("acc", "top2", "macro_f1", "weighted_f1")) -> DataFrame:
    """F14 roll-up: mean and population std of every metric, and the fold count."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return summary.agg(*aggs, F.count(F.lit(1)).alias("folds"))
