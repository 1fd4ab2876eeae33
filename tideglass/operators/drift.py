"""Drift between two samples by group: two-sample Kolmogorov-Smirnov and Kullback-Leibler over shared histograms.

Values become counts by group, sample and bin first, so that what is ordered or compared is bounded by the number of bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

c = F.col


def histograms(rows: DataFrame, key: str, value: str, second: str, bin_width: float) -> DataFrame:
    """key, bin, a, b: how many values of the first sample and of the second (`second` is true) fall into each bin."""
    good = c(value).isNotNull() & ~F.isnan(value) & c(key).isNotNull() & c(second).isNotNull()
    bins = F.floor(c(value) / bin_width)
    return rows.where(good).groupBy(key, bins.alias("bin")).agg(F.count_if(~c(second)).alias("a"), F.count_if(c(second)).alias("b"))


def drift(hist: DataFrame, key: str) -> DataFrame:
    """key, n_a, n_b, ks (greatest distance of the cumulative shares), kl (of the second from the first, counts plus one)."""
    run = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key)
    rows = hist.select(key, "a", "b", *(F.sum(x).over(run).alias(f"c{x}") for x in "ab"), *(F.sum(x).over(whole).alias(f"n{x}") for x in "ab"), F.count(F.lit(1)).over(whole).alias("k"))
    p, q = (c("b") + 1) / (c("nb") + c("k")), (c("a") + 1) / (c("na") + c("k"))
    both = (c("na") > 0) & (c("nb") > 0)
    gap = F.max(F.when(both, F.abs(c("ca") / c("na") - c("cb") / c("nb"))))
    return rows.groupBy(key).agg(F.max("na").alias("n_a"), F.max("nb").alias("n_b"), gap.alias("ks"), F.sum(F.when(both, p * F.log(p / q))).alias("kl"))
