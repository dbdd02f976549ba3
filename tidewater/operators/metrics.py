"""Evaluation from a confusion table: one grouped count, then tiny frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.session import settle


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    hit = F.when(F.col(label) == F.col(predicted), 1).otherwise(0)
    return df.agg(
        F.count("*").alias("n"),
        F.sum(hit).cast("bigint").alias("correct"),
        F.avg(hit).alias("accuracy"),
        (1 - F.avg(hit)).alias("error_rate"),
    )


def per_class(conf: DataFrame) -> DataFrame:
    """True positives, support and predicted count of every class."""
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    actual = conf.select(F.col("label").alias("cls"), F.col("n").alias("support"), hit.alias("tp"), F.lit(0).alias("chosen"))
    chosen = conf.select(F.col("predicted").alias("cls"), F.lit(0).alias("support"), F.lit(0).alias("tp"), F.col("n").alias("chosen"))
    tp, support, said = F.sum("tp").cast("bigint"), F.sum("support").cast("bigint"), F.sum("chosen").cast("bigint")
    scored = actual.unionByName(chosen).groupBy("cls").agg(tp.alias("tp"), support.alias("support"), said.alias("chosen"))
    p, r = F.try_divide("tp", "chosen"), F.try_divide("tp", "support")
    return scored.withColumn("precision", p).withColumn("recall", r).withColumn(
        "f1", F.try_divide(2 * F.col("tp"), F.col("chosen") + F.col("support"))
    )


def weighted_prf(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Class scores weighted by support; a class never predicted scores 0."""
    c = per_class(confusion(df, label, predicted))

    def weighted(name: str):
        v = F.sum(F.coalesce(F.col(name), F.lit(0.0)) * F.col("support")) / F.sum("support")
        return v.alias(f"weighted_{name}")

    return c.agg(weighted("precision"), weighted("recall"), weighted("f1"))


def macro_prf(df: DataFrame, label: str, predicted: str, classes: Sequence | None = None) -> DataFrame:
    """Unweighted mean over classes; a 0/0 score is null and left out."""
    c = per_class(confusion(df, label, predicted))
    if classes is not None:
        c = c.filter(F.col("cls").isin(list(classes)))
    return c.agg(*[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")])


def scores_by(df: DataFrame, by: Sequence[str], label: str, predicted: str) -> DataFrame:
    """Accuracy and macro scores of many experiments at once, one confusion
    count per group."""
    by = list(by)
    conf = df.groupBy(*by, F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    roles = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), hit.alias("tp"), F.lit(0).cast("bigint").alias("chosen")),
        F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("chosen")),
    )
    per = conf.select(*by, F.inline(roles)).groupBy(*by, "cls").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "chosen")])
    return per.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg(F.try_divide("tp", "chosen")).alias("macro_precision"),
        F.avg(F.try_divide("tp", "support")).alias("macro_recall"),
        F.avg(F.try_divide(2 * F.col("tp"), F.col("chosen") + F.col("support"))).alias("macro_f1"),
    )


def kappa(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Cohen's kappa: agreement beyond what the margins give by chance."""
    c = per_class(confusion(df, label, predicted))
    s = c.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.sum(F.col("support").cast("double") * F.col("chosen")).alias("m")
    )
    po, pe = F.col("tp") / F.col("n"), F.col("m") / (F.col("n").cast("double") * F.col("n"))
    return s.select(po.alias("observed"), pe.alias("expected"), F.try_divide(po - pe, 1 - pe).alias("kappa"))


def confusion_pairs(df: DataFrame, label: str, predicted: str, k: int) -> DataFrame:
    """Class pairs mixed up most often, both directions added."""
    c = confusion(df, label, predicted).filter(F.col("label") != F.col("predicted"))
    return (
        c.groupBy(F.least("label", "predicted").alias("a"), F.greatest("label", "predicted").alias("b"))
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "a", "b")
        .limit(k)
    )


def regression(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    err = F.col(truth) - F.col(predicted)
    sse, y = F.sum(err * err), F.col(truth)
    return df.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.try_divide(sse, F.var_pop(y) * F.count(y))).alias("r2"),
    )


def _matched_rows(conf: DataFrame) -> int:
    """Rows in the matched cells, taking cells by falling count.

    A cell that leads both its label and its cluster is what that order would
    take, so all such cells go at once."""
    left, matched = settle(conf, "cells"), 0
    while True:
        rank = F.struct(-F.col("n"), F.col("label"), F.col("predicted"))
        by_a = left.groupBy("label").agg(F.min(rank).alias("_ra"))
        by_b = left.groupBy("predicted").agg(F.min(rank).alias("_rb"))
        lead = left.join(by_a, "label").join(by_b, "predicted").filter((F.col("_ra") == rank) & (F.col("_rb") == rank))
        lead = settle(lead.select("label", "predicted", "n"), "lead")
        got = lead.agg(F.sum("n")).first()[0]
        if got is None:
            return matched
        matched += got
        rest = left.join(lead.select("label"), "label", "left_anti").join(lead.select("predicted"), "predicted", "left_anti")
        left = settle(rest, "cells")


def cluster_match(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Raw id agreement, and agreement under a greedy one-to-one matching that
    takes (label, cluster) cells by falling count.
    """
    conf = settle(confusion(df, label, cluster), "confusion")
    same = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0))
    total, raw = conf.agg(F.sum("n"), same).first()
    matched = _matched_rows(conf)
    row = (total or 0, raw / total if total else None, matched / total if total else None)
    return df.sparkSession.createDataFrame([row], "n bigint, raw_agreement double, matched_agreement double")


def threshold_curve(counts: DataFrame, score: str, gold: str, n: str, total_gold: int, thresholds: Sequence[float], below: bool) -> DataFrame:
    """Precision and recall at every threshold from one count per score value.

    ``counts`` holds, per score, the pairs and the gold pairs among them.  Pairs
    are kept when score < t (``below``) or score > t.  Each score is sent to the
    first threshold that keeps it; a running sum does the rest, so the pairs are
    read once however many thresholds there are.
    """
    spark = counts.sparkSession
    order = sorted(thresholds, reverse=not below)
    slot = F.lit(None).cast("int")
    for i in reversed(range(len(order))):
        keep = F.col(score) < F.lit(order[i]) if below else F.col(score) > F.lit(order[i])
        slot = F.when(keep, F.lit(i)).otherwise(slot)
    sums = counts.withColumn("_i", slot).groupBy("_i").agg(F.sum(n).alias("_n"), F.sum(gold).alias("_g"))
    grid = spark.createDataFrame(list(enumerate(order)), "_i int, threshold double")
    upto = W.orderBy("_i").rowsBetween(W.unboundedPreceding, W.currentRow)  # a row per threshold
    full = grid.join(sums, "_i", "left").na.fill(0, ["_n", "_g"])
    kept, correct = F.sum("_n").over(upto), F.sum("_g").over(upto)
    return full.select("threshold", kept.cast("bigint").alias("kept"), correct.cast("bigint").alias("correct")).select(
        "threshold", "kept", "correct",
        F.try_divide("correct", "kept").alias("precision"),
        F.try_divide(F.col("correct"), F.lit(total_gold)).alias("recall"),
    )
