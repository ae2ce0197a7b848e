"""Metrics and tables for binary responses, per group (sample, model, feature ...)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuekit.functions.columns import MISSING_NUMBER, status_boundary, status_two_sided
from valuekit.operators.frames import join_on, long_numeric
from valuekit.operators.ranks import bin_of, pinned, quantiles, running_totals, unique_edges

# Allowed relative Gini change against train (yellow from, red from), by sample kind; others count as test.
GINI_BAND = {"valid": (-0.15, -0.25), "test": (-0.15, -0.25), "test2": (-0.15, -0.25), "OOT": (-0.2, -0.3), "OOT_psi": (-0.2, -0.3)}
# Fixed value: stands for a zero train Gini in the relative change.
ZERO_GINI = 0.00001


def _label_sums(label: str, weight: str | None = None) -> dict[str, Column]:
    y, n = F.col(label), F.lit(1) if weight is None else F.col(weight)
    return {"pos": F.sum((y == 1).cast("bigint") * n), "neg": F.sum((y == 0).cast("bigint") * n)}


def _auc_from(rows: DataFrame, keys: Sequence[str]) -> list[Column]:
    pairs = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2)
    return [
        F.sum(F.col("pos") + F.col("neg")).alias("n_rows"),
        F.sum("pos").alias("n_events"),
        F.try_divide(F.sum(pairs), F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))).alias("auc"),
    ]


def auc(df: DataFrame, keys: Sequence[str], score: str, label: str, cuts: Sequence | None = None, weight: str | None = None) -> DataFrame:
    """(keys, n_rows, n_events, auc): exact rank-sum AUC, ties count half, null for one class.

    `weight` names a column with the number of equal rows a row stands for.
    """
    rows = running_totals(df, keys, score, _label_sums(label, weight), cuts=cuts)
    return rows.groupBy(*keys).agg(*_auc_from(rows, keys))


def gini(df: DataFrame, keys: Sequence[str], score: str, label: str, weight: str | None = None) -> DataFrame:
    return auc(df, keys, score, label, weight=weight).select(*keys, "n_rows", "n_events", (2 * F.col("auc") - 1).alias("gini"))


def binary_metrics(df: DataFrame, keys: Sequence[str], score: str, label: str, eps: float = 1e-15) -> DataFrame:
    """Gini, average precision and log-loss (each times 100) from one ordered pass."""
    rows = running_totals(df, keys, score, _label_sums(label), totals=True)
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    loss = -(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p))
    hits = F.col("pos_all") - F.col("pos_below")
    flagged = hits + F.col("neg_all") - F.col("neg_below")
    step = F.try_divide(F.col("pos").cast("double"), F.col("pos_all")) * F.try_divide(hits.cast("double"), flagged)
    got = rows.groupBy(*keys).agg(*_auc_from(rows, keys), F.sum(step).alias("ap"), F.sum(loss).alias("loss"))
    return got.select(
        *keys,
        "n_rows",
        "n_events",
        (100 * (2 * F.col("auc") - 1)).alias("gini"),
        (100 * F.col("ap")).alias("pr_auc"),
        (100 * F.col("loss") / F.col("n_rows")).alias("log_loss"),
    )


def wide_by_sample(metrics: DataFrame, keys: Sequence[str], values: Sequence[str], samples: Sequence[str], sample: str = "sample") -> DataFrame:
    """Long metrics to one row per key with `<metric>_<sample>` columns."""
    return metrics.groupBy(*keys).agg(*[
        F.max(F.when(F.col(sample) == s, F.col(v))).alias(f"{v}_{s}") for v in values for s in samples
    ])


def roc_curve(df: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """One row per distinct score: rates of events and non-events at or above it."""
    rows = running_totals(df, keys, score, _label_sums(label), totals=True)
    return rows.select(
        *keys,
        F.col(score).alias("threshold"),
        F.try_divide((F.col("pos_all") - F.col("pos_below")).cast("double"), F.col("pos_all")).alias("tpr"),
        F.try_divide((F.col("neg_all") - F.col("neg_below")).cast("double"), F.col("neg_all")).alias("fpr"),
    )


def precision_recall_curve(df: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """One row per distinct score: precision and recall at or above it, and the base rate."""
    rows = running_totals(df, keys, score, _label_sums(label), totals=True)
    hits = (F.col("pos_all") - F.col("pos_below")).cast("double")
    flagged = F.col("pos_all") + F.col("neg_all") - F.col("pos_below") - F.col("neg_below")
    return rows.select(
        *keys,
        F.col(score).alias("threshold"),
        F.try_divide(hits, flagged).alias("precision"),
        F.try_divide(hits, F.col("pos_all")).alias("recall"),
        F.try_divide(F.col("pos_all").cast("double"), F.col("pos_all") + F.col("neg_all")).alias("base_rate"),
    )


def score_bins(df: DataFrame, keys: Sequence[str], score: str, n_edges: int = 20, unbinned: int | None = -1, cuts: Sequence | None = None, weight: str | None = None) -> DataFrame:
    """Add `bin`: right-closed quantile bins of the score per group.

    `n_edges` edges give `n_edges - 1` bins; the smallest score lies outside and gets `unbinned`. `weight` names a
    column with the number of equal rows a row stands for.
    """
    counts = None if weight is None else {"edges": F.sum(weight)}
    edges = quantiles(df, keys, score, [i / (n_edges - 1) for i in range(n_edges)], name="edges", counts=counts, cuts=cuts)
    edges = edges.select(*keys, unique_edges(F.col("edges")).alias("_edges"))
    number = bin_of(f"`{score}`", "_edges", n_edges)
    with_edges = join_on(df, pinned(edges), [*keys], "left") if keys else df.withColumn("_edges", edges.select("_edges").scalar())
    return with_edges.withColumn("bin", F.coalesce(number, F.lit(unbinned)) if unbinned is not None else number).drop("_edges")


def binary_bins(df: DataFrame, keys: Sequence[str], score: str, label: str, n_edges: int = 20) -> DataFrame:
    """Detailed table per score bin, numbered from 1, with a `Total` row per group.

    A bin's threshold is its smallest score and bins follow the score order, so the rates at a
    threshold are the cumulative counts from the top bin down.
    """
    y, p = F.col(label).cast("double"), F.col(score)
    binned = score_bins(df, keys, score, n_edges)
    table = binned.groupBy(*keys, "bin").agg(
        F.min(p).alias("prob_min"),
        F.avg(p).alias("prob_mean"),
        F.max(p).alias("prob_max"),
        F.avg(y).alias("eventrate"),
        F.count(y).alias("n_obs"),
        F.sum(y).cast("bigint").alias("n_event"),
    )
    group = Window.partitionBy(*keys)
    top_down = group.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    nonevent = F.col("n_obs") - F.col("n_event")
    cum_event, cum_nonevent = F.sum("n_event").over(top_down), F.sum(nonevent).over(top_down)
    rows = table.select(
        *keys,
        F.row_number().over(group.orderBy("bin")).cast("string").alias("bin"),
        "prob_min",
        "prob_mean",
        "prob_max",
        "eventrate",
        "n_obs",
        "n_event",
        nonevent.alias("n_nonevent"),
        cum_event.alias("cum_event"),
        cum_nonevent.alias("cum_nonevent"),
        (100 * F.try_divide(cum_nonevent.cast("double"), F.sum(nonevent).over(group))).alias("one_minus_specificity"),
        (100 * F.try_divide(cum_event.cast("double"), F.sum("n_event").over(group))).alias("sensitivity"),
    )
    total = rows.groupBy(*keys).agg(
        F.lit("Total").alias("bin"),
        F.try_divide(F.sum("n_event").cast("double"), F.sum("n_obs")).alias("eventrate"),
        F.sum("n_obs").alias("n_obs"),
        F.sum("n_event").alias("n_event"),
        F.sum("n_nonevent").alias("n_nonevent"),
    )
    return rows.unionByName(total, allowMissingColumns=True)


def auc_interval(df: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """Gini, AUC (percent) and its error band 1.96 * sqrt(auc * (100 - auc) / n)."""
    got = auc(df, keys, score, label).withColumn("auc", 100 * F.col("auc"))
    error = 1.96 * F.sqrt(F.col("auc") * (100 - F.col("auc")) / F.col("n_rows"))
    return got.select(
        *keys,
        (2 * F.col("auc") - 100).alias("gini"),
        "auc",
        error.alias("auc_std_err"),
        (F.col("auc") - error).alias("auc_lcl"),
        (F.col("auc") + error).alias("auc_ucl"),
    )


def bin_means(df: DataFrame, keys: Sequence[str], score: str, target: str, n_edges: int = 20) -> DataFrame:
    """Curve data: mean prediction and target per bin, with target quartiles."""
    binned = score_bins(df, keys, score, n_edges)
    means = binned.groupBy(*keys, "bin").agg(F.avg(score).alias("pred_mean"), F.avg(target).alias("target_mean"), F.count(F.lit(1)).alias("n_obs"))
    quarter = quantiles(binned, [*keys, "bin"], target, [0.25, 0.5, 0.75], name="q").select(
        *keys, "bin", *[F.col("q")[i].alias(n) for i, n in enumerate(("target_p25", "target_p50", "target_p75"))]
    )
    return join_on(means, quarter, [*keys, "bin"], "left")


def confusion(df: DataFrame, actual: str, predicted: str, log: bool = False) -> DataFrame:
    """Confusion matrix in long form over all level pairs that occur, optionally log counts."""
    counts = df.groupBy(F.col(actual).alias("x"), F.col(predicted).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("value", F.log("n") if log else F.col("n").cast("double")).drop("n")


def feature_gini(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, feature, gini): 200 * |AUC - 0.5| per numeric feature, missing as -9999."""
    values = long_numeric(df, [*keys, label], features).withColumn("value", F.coalesce("value", F.lit(MISSING_NUMBER)))
    got = auc(values, [*keys, "feature"], "value", label)
    return got.select(*keys, "feature", (200 * F.abs(F.col("auc") - 0.5)).alias("gini"))


def gini_selection(scores: DataFrame, threshold: float, categorical: Sequence[str] = ()) -> DataFrame:
    """Mark features above the threshold; categorical ones have no Gini and are always kept."""
    marked = scores.select("feature", "gini", F.coalesce((F.col("gini") > threshold).cast("int"), F.lit(0)).alias("selected"))
    if categorical:
        # One row with an array: the names come from the schema, not from data.
        names = scores.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in categorical])).alias("feature"))
        marked = marked.unionByName(names.select("feature", F.lit(None).cast("double").alias("gini"), F.lit(1).alias("selected")))
    return marked.orderBy(F.desc_nulls_last("gini"), "feature")


def gini_with_flags(scores: DataFrame, model_features: Sequence[str], handbook: DataFrame | None = None) -> DataFrame:
    """Add the model flag and, when given, the variable description."""
    out = scores.withColumn("model_flag", F.col("feature").isin(*model_features).cast("int"))
    if handbook is None:
        return out
    described = handbook.select(F.col("variable").alias("feature"), "description")
    return out.join(pinned(described), "feature", "left")


def gini_stability(df: DataFrame, features: Sequence[str], score: str, label: str, samples: Sequence[str], sample: str = "sample", base: str = "train") -> DataFrame:
    """Gini per feature and for the model by sample, change against train, and a status.

    The model row is judged by the two-sided band, features by the red boundary alone.
    """
    frame = df.where(F.col(sample).isin(*samples)).withColumn("model", F.col(score))
    wide = wide_by_sample(feature_gini(frame, [*features, "model"], label, [sample]), ["feature"], ["gini"], samples, sample)
    reference = F.when(F.col(f"gini_{base}") == 0, ZERO_GINI).otherwise(F.col(f"gini_{base}"))
    for s in samples:
        if s == base:
            continue
        delta = f"delta_{base}_vs_{s}"
        yellow, red = GINI_BAND.get(s, GINI_BAND["test"])
        change = (F.col(f"gini_{s}") - F.col(f"gini_{base}")) / reference
        mark = F.when(F.col("feature") == "model", status_two_sided(F.col(delta), yellow, red, "reverse")).otherwise(
            status_boundary(F.col(delta), red)
        )
        wide = wide.withColumn(delta, change).withColumn(f"status_{s}", mark)
    return wide
