"""Descriptive statistics of samples and variables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.operators.frames import join_on, long_numeric, long_text
from valuekit.operators.ranks import quantiles, running_totals

# Fixed value: a category with more values than this is reported as suspicious.
BIG_CATEGORY = 1000


def sample_stats(df: DataFrame, label: str, sample: str = "sample") -> DataFrame:
    """Rows, events and event rate per sample."""
    y = F.col(label)
    return df.groupBy(sample).agg(F.count(F.lit(1)).alias("n_obs"), F.sum(y).cast("bigint").alias("n_events"), F.avg(y).alias("eventrate"))


def target_stats(df: DataFrame, target: str, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Count, mean, both standard deviations, minimum, quartiles and maximum of the target.

    A group without any target is listed with 0 observations.
    """
    y = F.col(target)
    moments = df.groupBy(*keys).agg(
        F.count(y).alias("n_obs"),
        F.avg(y).alias("mean"),
        F.stddev_pop(y).alias("std_pop"),
        F.stddev_samp(y).alias("std_samp"),
        F.min(y).alias("min"),
        F.max(y).alias("max"),
    )
    quarters = quantiles(df, keys, target, [0.25, 0.5, 0.75], name="q")
    return join_on(moments, quarters, [*keys], "left").select(
        *keys, "n_obs", "mean", "std_pop", "std_samp", "min", *[F.col("q")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))], "max"
    )


def variable_profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Filled count and share, distinct values (null is one), and moments per variable.

    Values are counted once per (feature, value); every statistic follows from those counts. A
    variable without any value is listed with 0 filled rows.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    shape = ["feature", "n_filled", "share_filled", "n_unique", "mean", "std", "min", "p25", "p50", "p75", "max"]

    def filled(counts: DataFrame, *more) -> DataFrame:
        got = counts.groupBy("feature").agg(F.sum("n").alias("n_filled"), F.count(F.lit(1)).alias("n_levels"), *more)
        missing = (F.col("n_filled") < total).cast("bigint")
        return got.withColumn("share_filled", F.try_divide(F.col("n_filled").cast("double"), total)).withColumn(
            "n_unique", F.col("n_levels") + missing
        )

    def all_listed(stats: DataFrame, features: Sequence[str]) -> DataFrame:
        """Every feature, also those without a value; the names are the caller's own list."""
        names = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
        full = names.join(stats, "feature", "left").withColumn("n_filled", F.coalesce("n_filled", F.lit(0).cast("bigint")))
        share = F.coalesce("share_filled", F.try_divide(F.lit(0.0), total))
        return full.withColumns({"share_filled": share, "n_unique": F.coalesce("n_unique", (F.lit(0) < total).cast("bigint"))})

    out = None
    if numeric:
        values = long_numeric(df, [], numeric).where(F.col("value").isNotNull())
        rows = running_totals(values, ["feature"], "value", {"n": F.count(F.lit(1))}, totals=True)
        picks = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
        neighbours = []
        for name, p in picks.items():
            for side in ("floor", "ceil"):
                rank = f"{side}({p}D * (n_all - 1))"
                neighbours.append(
                    F.expr(f"max(CASE WHEN {rank} >= n_below AND {rank} < n_below + n THEN value END)").alias(f"_{name}_{side}")
                )
        # Second moments around the group mean, so that large values keep their digits.
        mean = values.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
        stats = filled(rows, F.min("value").alias("min"), F.max("value").alias("max"), *neighbours).join(mean, "feature")
        for name, p in picks.items():
            spot = F.lit(p) * (F.col("n_filled") - 1)
            low, high = F.col(f"_{name}_floor"), F.col(f"_{name}_ceil")
            stats = stats.withColumn(name, low + (high - low) * (spot - F.floor(spot)))
        out = all_listed(stats.select(*shape), numeric)
    if categorical:
        texts = long_text(df, [], categorical).where(F.col("value").isNotNull())
        counts = texts.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        stats = filled(counts)
        blank = {c: F.lit(None).cast("double") for c in shape if c not in stats.columns}
        stats = all_listed(stats.withColumns(blank).select(*shape), categorical)
        out = stats if out is None else out.unionByName(stats)
    return out


def variable_types(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row: the target, how many categorical and numeric variables have any value, and the rows with a target."""
    def with_values(columns: Sequence[str]) -> Column:
        return reduce(lambda total, c: total + F.when(F.count(c) > 0, 1).otherwise(0), columns, F.lit(0)).cast("int")

    return df.agg(F.count(target).alias("n_labelled"), with_values(categorical).alias("n_categorical"), with_values(numeric).alias("n_numeric")).select(
        F.lit(target).alias("target"), "n_categorical", "n_numeric", "n_labelled"
    )


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value): distinct non-null values of each category column."""
    return long_text(df, [], columns).where(F.col("value").isNotNull()).distinct()


def big_categories(values: DataFrame, limit: int = BIG_CATEGORY) -> DataFrame:
    counts = values.groupBy("feature").agg(F.count(F.lit(1)).alias("n_values"))
    return counts.withColumn("suspicious", F.col("n_values") > limit)
