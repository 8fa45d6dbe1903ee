"""Classifier metrics as ordered aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Bands of scores within which counts are summed apart; their totals are what is ordered globally.
BANDS = 1024


def curve(scored: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """(prob, p, n, tp, fp, positives, negatives) at every distinct threshold: its own rows, and those from it on.

    Rows are added up by score, then summed within bands of scores, and the
    bands' totals (at most ``BANDS`` rows, so broadcast) are added to that.
    """
    by = scored.groupBy(F.col(prob).alias("prob")).agg(F.sum(F.col(label).cast("long")).alias("p"), F.sum(1 - F.col(label).cast("long")).alias("n"))
    by = by.withColumn("_band", F.greatest(F.lit(0), F.least(F.lit(BANDS - 1), F.floor(F.col("prob") * BANDS))))
    above = Window.orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bands = by.groupBy("_band").agg(F.sum("p").alias("_p"), F.sum("n").alias("_n")).select(
        "_band", F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_tp"), F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_fp"),
        F.sum("_p").over(every).alias("positives"), F.sum("_n").over(every).alias("negatives"),
    )
    down = Window.partitionBy("_band").orderBy(F.desc("prob")).rowsBetween(Window.unboundedPreceding, 0)
    within = by.select("_band", "prob", "p", "n", F.sum("p").over(down).alias("tp"), F.sum("n").over(down).alias("fp"))
    joined = within.join(F.broadcast(bands), "_band")
    return joined.select("prob", "p", "n", (F.col("tp") + F.col("_tp")).alias("tp"), (F.col("fp") + F.col("_fp")).alias("fp"), "positives", "negatives")


def pr_auc(curve: DataFrame) -> DataFrame:
    """Area under precision over recall by trapezoids, from (recall 0, precision 1). The point before a
    threshold is that of the rows above it, so no row needs its neighbour."""
    tp, fp = F.col("tp") - F.col("p"), F.col("fp") - F.col("n")
    before = tp / F.col("positives"), F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0)
    here = F.col("tp") / F.col("positives"), F.col("tp") / (F.col("tp") + F.col("fp"))
    return curve.agg(F.round(F.sum((here[0] - before[0]) * (here[1] + before[1]) / 2), 9).alias("pr_auc"))


def threshold_for(curve: DataFrame, recall: float) -> DataFrame:
    """The greatest threshold whose recall is at least ``recall``."""
    return curve.where(F.col("tp") >= F.lit(recall) * F.col("positives")).agg(F.max("prob").alias("threshold"))


def confusion(scored: DataFrame, at: float, label: str = "label", prob: str = "prob") -> DataFrame:
    """Counts and rates with a row positive from the threshold on; a rate without a base is 0."""
    hit, pos = F.col(prob) >= at, F.col(label) == 1
    c = scored.agg(F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"), F.count_if(~hit & pos).alias("fn"), F.count_if(~hit & ~pos).alias("tn"))
    return c.select("tp", "fp", "fn", "tn", _rate("tp", "fn").alias("recall"), _rate("tp", "fp").alias("precision"), _rate("fp", "tn").alias("false_positive_rate"))


def _rate(a: str, b: str) -> Column:
    total = F.col(a) + F.col(b)
    return F.round(F.when(total > 0, F.col(a) / total).otherwise(0.0), 9)
