"""Quality of a ranking: threshold curve, best threshold and area under the curve, exact with ties.

Rows are counted per distinct score first.  Counts of all higher scores come from two levels of prefix sums: scores are
dealt into ranges, and a running sum inside each range starts from the sum of the ranges above it, of which there is
one row each.  No task holds more than a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def threshold_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """threshold, positives, negatives, tp, fp: a row per distinct score.

    positives and negatives have just that score; tp and fp have it or a higher one, so they are what a rule
    `score >= threshold` gets right and wrong.  label is 0 or 1; rows without label or score count for nothing, NaN is
    no score.
    """
    valid = scored.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    counts = valid.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives")
    )
    # The range of a row is stored with it, so that it stays the same in both passes.
    ranges = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(counts.repartitionByRange(ranges, F.col("threshold").desc()).withColumn("range", F.spark_partition_id()))
    above = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    totals = dealt.groupBy("range").agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    offsets = totals.select("range", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in "pn"])
    inside = Window.partitionBy("range").orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumns({"tp": F.sum("positives").over(inside), "fp": F.sum("negatives").over(inside)}).join(F.broadcast(offsets), "range")
    return summed.select("threshold", "positives", "negatives", (F.col("tp") + F.col("p_above")).alias("tp"), (F.col("fp") + F.col("n_above")).alias("fp"))


def ranking_report(curve: DataFrame) -> DataFrame:
    """One row: positives, negatives, auc, threshold of the best F1 (the highest of several), its f1, tp and fp.

    auc is the share of pairs of a positive and a negative row that are in order, ties counting half; null without
    rows of both kinds.  F1 is 2 tp / (tp + fp + positives); without positives there is no best threshold.
    """
    held = stored(curve)
    all_positives = held.agg(F.coalesce(F.sum("positives"), F.lit(0)).alias("p")).scalar()
    wide = "decimal(38,0)"
    # Twice the pairs in order: each negative row has the positives above its score, and half of those at it.
    twice = F.sum(F.col("negatives").cast(wide) * (2 * F.col("tp") - F.col("positives")).cast("decimal(19,0)"))
    f1 = 2.0 * F.col("tp") / (F.col("tp") + F.col("fp") + all_positives)
    best = F.max(F.when(all_positives > 0, F.struct(f1.alias("f1"), "threshold", "tp", "fp")))
    totals = held.agg(
        F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"), F.coalesce(F.sum("negatives"), F.lit(0)).alias("negatives"),
        twice.alias("twice"), best.alias("best"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    auc = F.when(pairs > 0, F.col("twice").cast("double") / (2 * pairs))
    return totals.select("positives", "negatives", auc.alias("auc"), "best.threshold", "best.f1", "best.tp", "best.fp")


def wrong_rows(scored: DataFrame, actual: str, predicted: str, keys: list[str]) -> DataFrame:
    """The rows that were predicted wrongly, with 'actual X predicted'; a missing side is written as null."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    wrong = scored.where(~F.col(actual).eqNullSafe(F.col(predicted)))
    return wrong.select(*keys, F.concat(text(actual), F.lit(" X "), text(predicted)).alias("wrong"))


def predicted_by(score: Column, threshold: Column) -> Column:
    """TRUE from the threshold on, as text."""
    return F.when(score >= threshold, "TRUE").otherwise("FALSE")
