"""Metrics and tables for continuous targets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuekit.functions.columns import correlation, status_two_sided, student_quantile
from valuekit.operators.binary import score_bins
from valuekit.operators.frames import join_on
from valuekit.operators.ranks import average_ranks, known_cuts, pinned, quantiles, running_totals
from valuekit.session import settle, settle_counted

# Metrics where larger is better, and the relative change against train at which the
# report turns yellow and red.
LARGER_IS_BETTER = ("r2", "pearson", "spearman")
DELTA_BAND = {"test": (0.2, 0.3), "OOT": (0.15, 0.25)}


def _sse(y: Column, p: Column) -> Column:
    return F.sum((y - p) * (y - p))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def mse(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def rmsle(y: Column, p: Column) -> Column:
    """Both sides are clipped just above -1, where the logarithm ends."""
    floor = F.lit(-1 + 1e-6)
    gap = F.log1p(F.greatest(p, floor)) - F.log1p(F.greatest(y, floor))
    return F.sqrt(F.avg(gap * gap))


def r2(y: Column, p: Column) -> Column:
    return 1 - F.try_divide(_sse(y, p), F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0)))


def mape_shifted(y: Column, p: Column) -> Column:
    """|y - p| / |1 + y|, rows with a zero denominator skipped."""
    return F.avg(F.try_divide(F.abs(y - p), F.abs(1 + y)))


def mape_signed(y: Column, p: Column) -> Column:
    """|y - p| / y in percent, rows with y = 0 skipped, the denominator keeps its sign."""
    return 100 * F.avg(F.try_divide(F.abs(y - p), y))


def mape_plain(y: Column, p: Column) -> Column:
    return F.avg(F.abs(F.try_divide(y - p, y)))


EVAL_METRICS: dict[str, Callable[[Column, Column], Column]] = {"mae": mae, "mse": mse, "rmse": rmse, "rmsle": rmsle, "r2": r2}


def select_metric(name: str) -> Callable[[Column, Column], Column]:
    """Aggregate builder by name; an unknown name is an error."""
    try:
        return EVAL_METRICS[name]
    except KeyError:
        raise ValueError(f"unknown metric {name!r}, expected one of {sorted(EVAL_METRICS)}") from None


def spearman(df: DataFrame, keys: Sequence[str], target: str, prediction: str, cuts: Sequence | None = None) -> DataFrame:
    """Rank correlation per group. `cuts` may be empty where the rows are known to fit one range.

    Rows collapse to (target, prediction) pairs first, which are written once, since all passes read them; each side's
    ranks are joined on its value.
    A value shared by very many pairs is a skewed join key, which adaptive execution splits: the
    rank side has one row per value.
    """
    pairs = settle(df.groupBy(*keys, target, prediction).agg(F.count(F.lit(1)).alias("_n")))
    by_target = average_ranks(pairs, keys, target, "_rank_y", F.col("_n"), cuts)
    by_prediction = average_ranks(pairs, keys, prediction, "_rank_p", F.col("_n"), cuts)
    ranked = join_on(join_on(pairs, by_target, [*keys, target]), by_prediction, [*keys, prediction])
    n, ry, rp = F.col("_n").cast("double"), F.col("_rank_y"), F.col("_rank_p")
    moments = ranked.groupBy(*keys).agg(
        F.sum(n).alias("w"),
        F.sum(n * ry).alias("y"),
        F.sum(n * rp).alias("p"),
        F.sum(n * ry * rp).alias("yp"),
        F.sum(n * ry * ry).alias("yy"),
        F.sum(n * rp * rp).alias("pp"),
    )
    cov = F.expr("yp / w - (y / w) * (p / w)")
    spread = F.expr("sqrt((yy / w - (y / w) * (y / w)) * (pp / w - (p / w) * (p / w)))")
    return moments.select(*keys, F.try_divide(cov, F.nullif(spread, F.lit(0.0))).alias("spearman"))


def regression_metrics(df: DataFrame, keys: Sequence[str], target: str, prediction: str, mape: Callable[[Column, Column], Column] = mape_shifted) -> DataFrame:
    """(keys, n_rows, mae, mape, rmse, r2, pearson, spearman)."""
    y, p = F.col(target), F.col(prediction)
    df = settle(df.select(*dict.fromkeys([*keys, target, prediction])))
    table = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        mae(y, p).alias("mae"),
        mape(y, p).alias("mape"),
        rmse(y, p).alias("rmse"),
        r2(y, p).alias("r2"),
        correlation(y, p).alias("pearson"),
    )
    return join_on(table, spearman(df, keys, target, prediction), [*keys], "left")


def regression_delta(metrics: DataFrame, samples: Sequence[str], sample: str = "sample", base: str = "train") -> DataFrame:
    """One row per metric: value by sample, relative change against train, status."""
    names = [m for m in ("mae", "mape", "rmse", "r2", "pearson", "spearman") if m in metrics.columns]
    long = metrics.unpivot([sample], names, "metric", "value")
    wide = long.groupBy("metric").agg(*[F.max(F.when(F.col(sample) == s, F.col("value"))).alias(s) for s in samples])
    good_high = F.col("metric").isin(*LARGER_IS_BETTER)
    for s in samples:
        if s == base:
            continue
        delta = f"delta_{base}_vs_{s}"
        wide = wide.withColumn(delta, F.try_divide(F.col(s) - F.col(base), F.col(base)))
        if s in DELTA_BAND:
            low, high = DELTA_BAND[s]
            mark = F.when(good_high, status_two_sided(F.col(delta), -low, -high, "reverse")).otherwise(
                status_two_sided(F.col(delta), low, high)
            )
            wide = wide.withColumn(f"status_{s}", mark)
    return wide


def regression_bins(df: DataFrame, keys: Sequence[str], target: str, prediction: str, n_edges: int = 20) -> DataFrame:
    """Detailed table per prediction bin, numbered from 1, with a `Total` row per group.

    The three columns it needs are written and counted once; all ordered statistics read those files.
    """
    rows, n = settle_counted(df.select(*dict.fromkeys([*keys, target, prediction])))
    cuts = known_cuts(n)
    binned = score_bins(rows, keys, prediction, n_edges, cuts=cuts)
    per_bin = _bin_table(binned, [*keys, "bin"], target, prediction, cuts)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("bin")).cast("string")
    total = _bin_table(rows, keys, target, prediction, cuts).withColumn("bin", F.lit("Total"))
    return per_bin.withColumn("bin", number).unionByName(total)


def _bin_table(df: DataFrame, keys: Sequence[str], target: str, prediction: str, cuts: Sequence | None) -> DataFrame:
    y, p = F.col(target), F.col(prediction)
    spread = [F.min(p).alias("pred_min"), F.avg(p).alias("pred_mean"), F.max(p).alias("pred_max"), F.min(y).alias("real_min"), F.avg(y).alias("real_mean"), F.max(y).alias("real_max")]
    quarters = quantiles(df, keys, target, [0.25, 0.5, 0.75], name="q", cuts=cuts).select(
        *keys, *[F.col("q")[i].alias(n) for i, n in enumerate(("real_p25", "real_p50", "real_p75"))]
    )
    errors = [F.count(F.lit(1)).alias("n_rows"), mae(y, p).alias("mae"), mape_shifted(y, p).alias("mape"), rmse(y, p).alias("rmse"), r2(y, p).alias("r2"), correlation(y, p).alias("pearson")]
    scores = join_on(df.groupBy(*keys).agg(*spread, *errors), spearman(df, keys, target, prediction, cuts), [*keys], "left")
    for name in ("mape", "r2", "pearson", "spearman"):
        scores = scores.withColumn(name, 100 * F.col(name))
    return join_on(scores, quarters, [*keys], "left")


def mean_interval(df: DataFrame, keys: Sequence[str], value: str, alpha: float = 0.05) -> DataFrame:
    """Student interval of the mean; the quantile uses n degrees of freedom."""
    got = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))
    half = student_quantile(1 - alpha / 2, F.col("n")) * F.sqrt(F.col("var")) / F.sqrt("n")
    return got.select(*keys, "n", "mean", (F.col("mean") - half).alias("lower"), (F.col("mean") + half).alias("upper"))


def _errors(df: DataFrame, keys: Sequence[str], target: str, prediction: str) -> DataFrame:
    """Rows with the model's absolute error and that of the mean of the target in the group."""
    centre = df.groupBy(*keys).agg(F.avg(target).alias("_mean"))
    with_mean = join_on(df, pinned(centre), [*keys]) if keys else df.withColumn("_mean", centre.scalar())
    y = F.col(target)
    return with_mean.select(*keys, F.abs(y - F.col(prediction)).alias("model"), F.abs(y - F.col("_mean")).alias("baseline"))


def rec_curve(df: DataFrame, keys: Sequence[str], target: str, prediction: str) -> DataFrame:
    """Share of rows with an error up to each distinct error, for model and mean baseline."""
    long = _errors(df, keys, target, prediction).unpivot([*keys], ["model", "baseline"], "curve", "error")
    rows = running_totals(long, [*keys, "curve"], "error", {"n": F.count(F.lit(1))}, totals=True)
    share = (F.col("n_below") + F.col("n")) / F.col("n_all")
    return rows.select(*keys, "curve", "error", share.alias("share"))


def rec_area(df: DataFrame, keys: Sequence[str], target: str, prediction: str) -> DataFrame:
    """Area over the REC curve for model and baseline, and their ratio.

    The trapezoid sum over sorted errors e_1..e_n with heights i/n telescopes to
    max - mean + (max - min) / 2n below the curve, so no sort is needed.
    """
    def over(name: str) -> Column:
        e = F.col(name)
        return F.avg(e) - (F.max(e) - F.min(e)) / (2 * F.count(e))

    got = _errors(df, keys, target, prediction).groupBy(*keys).agg(over("model").alias("aoc_model"), over("baseline").alias("aoc_baseline"))
    return got.withColumn("aoc_ratio", F.try_divide("aoc_model", "aoc_baseline"))


def scatter_sample(df: DataFrame, keys: Sequence[str], target: str, prediction: str, fraction: Column) -> DataFrame:
    """Points for a scatter: a tenth of the rows but at least 10,000, chosen by hash.

    `fraction` is a hash in [0, 1) of the row key. The share is a scalar subquery, so the size
    rule needs no driver round trip.
    """
    share = df.agg(F.greatest(F.lit(0.1), F.try_divide(F.lit(10_000.0), F.count(F.lit(1)))).alias("share"))
    return df.where(fraction < share.scalar()).select(*keys, target, prediction)
