"""Accuracy, confusion, one-vs-rest AUC, and their summary over folds.

``predictions`` is (fold, doc_id, label, pred); ``scores`` is
(fold, doc_id, label, class, score). All folds are evaluated in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmine.operators.ordering import BUCKET, running, with_buckets
from newsmine.session import cut


def accuracy_by_fold(predictions: DataFrame) -> DataFrame:
    hit = (F.col("pred") == F.col("label")).cast("int")
    return predictions.groupBy("fold").agg(F.avg(hit).alias("accuracy"))


def confusion(predictions: DataFrame) -> DataFrame:
    """Counts for every (truth, prediction) pair of classes, zeros shown, folds summed."""
    counts = predictions.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))
    # At most one value per class: the grid is unrolled from that short list.
    names = counts.agg(
        F.array_union(F.collect_set("label"), F.collect_set("pred")).alias("names")
    )
    grid = names.select(F.explode("names").alias("label"), "names").select(
        "label", F.explode("names").alias("pred")
    )
    return grid.join(counts, ["label", "pred"], "left").select(
        "label", "pred", F.coalesce("n", F.lit(0)).alias("n")
    )


def auc_ovr(scores: DataFrame) -> DataFrame:
    """(fold, class, auc): chance that a member scores above a non-member, ties half.

    Equal scores are merged first; the number of non-members below is a running
    total over score buckets, so no (fold, class) group is sorted in one task.
    A class without members, or without others, has no AUC (NaN).
    """
    member = F.col("label") == F.col("class")
    binned = with_buckets(scores.where(F.col("score").isNotNull()), F.col("score"))
    ties = binned.groupBy("fold", "class", BUCKET, "score").agg(
        F.sum(member.cast("long")).alias("pos"), F.sum((~member).cast("long")).alias("neg")
    )
    below = running(cut(ties), ["fold", "class"], ["score"], F.col("neg"), "below", inclusive=False)
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return below.groupBy("fold", "class").agg(
        F.when(pairs > 0, wins / pairs).otherwise(float("nan")).alias("auc")
    )


def auc_mean(aucs: DataFrame) -> DataFrame:
    return aucs.groupBy("class").agg(F.round(F.avg("auc"), 4).alias("auc"))


def cv_summary(accuracy: DataFrame, aucs: DataFrame) -> DataFrame:
    """(metric, value) rows: mean and population deviation of accuracy, mean AUC per class."""
    overall = accuracy.agg(
        F.round(F.avg("accuracy"), 4).alias("m"), F.round(F.stddev_pop("accuracy"), 4).alias("s")
    )
    named = F.array(
        F.struct(F.lit("accuracy_mean").alias("metric"), F.col("m").alias("value")),
        F.struct(F.lit("accuracy_std").alias("metric"), F.col("s").alias("value")),
    )
    per_class = auc_mean(aucs).select(
        F.concat(F.lit("auc:"), F.col("class").cast("string")).alias("metric"),
        F.col("auc").alias("value"),
    )
    return overall.select(F.inline(named)).unionByName(per_class)
