"""Regression trees of one feature each, for all features and groups at once.

A tree that sees one feature only is decided by how often each value occurs and what the target sums to there. So
rows collapse to one per (group, feature, value), and a level of all trees is one ordered pass: running totals give
both sides of every possible cut, the best one of each node is kept, and values move to their child. Cuts are exact,
not limited to bins, and the number of passes is the depth, whatever the number of features and groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.functions.columns import MISSING_NUMBER
from valuekit.operators.frames import join_on, long_numeric
from valuekit.operators.ranks import cut_points, pinned, running_totals
from valuekit.session import settle


def value_cells(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """(keys, feature, value, n, s, q): rows, sum and square sum of the target; missing numbers are a value of their own."""
    kept = df.where(F.col(target).isNotNull()).withColumn("_target", F.col(target).cast("double"))
    values = long_numeric(kept, [*keys, "_target"], features).withColumn("value", F.coalesce("value", F.lit(MISSING_NUMBER)))
    y = F.col("_target")
    return values.groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q"))


def _gain() -> Column:
    """What the cut above a value takes off the squared error of its node."""
    n, s = F.col("n_below") + F.col("n"), F.col("s_below") + F.col("s")
    rest, sum_rest = F.col("n_all") - n, F.col("s_all") - s
    return F.try_divide(s * s, n) + F.try_divide(sum_rest * sum_rest, rest) - F.col("s_all") * F.col("s_all") / F.col("n_all")


def grown(cells: DataFrame, keys: Sequence[str], depth: int) -> DataFrame:
    """`cells` with `node`, the leaf of each value after `depth` levels of best cuts; equal gains go to the smaller value."""
    groups = [*keys, "feature", "node"]
    cuts = cut_points(cells, "value")
    out = cells.withColumn("node", F.lit(0))
    for _ in range(depth):
        sums = running_totals(out, groups, "value", {"n": F.sum("n"), "s": F.sum("s")}, totals=True, cuts=cuts)
        gains = sums.select(*groups, "value", _gain().alias("gain")).where("gain > 0")
        best = gains.groupBy(*groups).agg(F.max(F.struct("gain", (-F.col("value")).alias("minus"))).alias("best"))
        cut = pinned(best.select(*groups, (-F.col("best.minus")).alias("cut")))
        above = F.coalesce((F.col("value") > F.col("cut")).cast("int"), F.lit(0))
        out = join_on(out, cut, groups, "left").withColumn("node", F.col("node") * 2 + above).drop("cut")
    return out


def feature_tree_correlation(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], depth: int = 3) -> DataFrame:
    """(keys, feature, correlation): correlation of each tree's prediction with the target; null where either is constant."""
    cells = settle(value_cells(df, features, target, keys))
    leaves = grown(cells, keys, depth).groupBy(*keys, "feature", "node").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    explained = F.sum(F.col("s") * F.col("s") / F.col("n")) - F.sum("s") * F.sum("s") / F.sum("n")
    whole = F.sum("q") - F.sum("s") * F.sum("s") / F.sum("n")
    # The predictions are the means of their leaves, so the correlation is the root of the explained share.
    return leaves.groupBy(*keys, "feature").agg(F.when((explained > 0) & (whole > 0), F.sqrt(explained / whole)).alias("correlation"))
