"""Feature importance: permutation, one-feature trees, feature-count curve, selection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.functions.columns import hash_fraction, status_boundary
from valuekit.operators.binary import auc
from valuekit.operators.feature_trees import feature_tree_correlation
from valuekit.operators.frames import join_on
from valuekit.operators.ranks import running_totals
from valuekit.operators.regression import select_metric
from valuekit.operators.training import Fitted, Formula, WoeLogistic, multi_model_scores, points, side_by_side
from valuekit.session import settle

# Fixed value: a feature is relevant above this share of the best one.
RELEVANT_SHARE = 0.2


def _with_donors(df: DataFrame, key: Sequence[str], features: Sequence[str], keep: Sequence[str], sample: str, share: float, seed: int) -> DataFrame:
    """Rows with the features of another row of their sample as `_d_<feature>`.

    Within each sample, rows get their rank in hash order; the donor is the row half a turn further, for all features
    alike. One self-join on (sample, rank) serves all features. The key must identify a row.
    """
    if share < 1:
        df = df.where(hash_fraction(*[F.col(k) for k in key], seed=seed + 1) < share)
    rows = settle(df.select(*dict.fromkeys([sample, *keep, *features]), hash_fraction(*[F.col(k) for k in key], seed=seed).alias("_h")))
    ranks = running_totals(rows, [sample], "_h", {"n": F.count(F.lit(1))}, totals=True)
    # Both sides of the next join read it.
    ranked = settle(join_on(rows, ranks.select(sample, "_h", F.col("n_below").alias("_rank"), "n_all"), [sample, "_h"]))
    turned = F.pmod(F.col("_rank") + F.floor(F.col("n_all") / 2), F.col("n_all"))
    donors = ranked.select(sample, turned.alias("_rank"), *[F.col(f).alias(f"_d_{f}") for f in features])
    return join_on(ranked, donors, [sample, "_rank"])


def permuted_rows(df: DataFrame, key: Sequence[str], features: Sequence[str], keep: Sequence[str], *, sample: str = "sample", share: float = 1.0, seed: int = 0) -> DataFrame:
    """Rows as they are (`permuted` = '') and once per feature with that feature shuffled.

    For models that must see whole rows; `permuted_scores` keeps all variants on one row. A `share` below 1 works on
    a hash sample of the rows, if the caller asks for it.
    """
    both = _with_donors(df, key, features, keep, sample, share, seed)
    variants = [("", None), *[(f, f) for f in features]]
    structs = F.array(*[
        F.struct(F.lit(n).alias("permuted"), *[F.col(f"_d_{f}" if f == moved else f).alias(f) for f in features]) for n, moved in variants
    ])
    rest = [c for c in dict.fromkeys([sample, *keep]) if c not in features]
    return both.select(*rest, F.explode(structs).alias("_v")).select(*rest, "_v.*")


def permuted_scores(df: DataFrame, key: Sequence[str], fitted: Fitted | Formula | WoeLogistic, label: str, *, sample: str = "sample", share: float = 1.0, seed: int = 0) -> tuple[DataFrame, dict[str, str]]:
    """(sample, label, one score per variant) and the column's name by shuffled feature ('' for none).

    All variants of a row are scored on that row, so features are neither copied nor shuffled once more.
    """
    rows = _with_donors(df, key, fitted.features, [label], sample, share, seed)
    names = {"": "_s", **{f: f"_s_{i}" for i, f in enumerate(fitted.features)}}
    rows = fitted.score(rows, "_s")
    for f in fitted.features:
        swapped = rows.withColumns({"_own": F.col(f), f: F.col(f"_d_{f}")})
        rows = fitted.score(swapped, names[f]).withColumn(f, F.col("_own")).drop("_own")
    return settle(rows.select(sample, label, *names.values())), names


def permutation_importance(df: DataFrame, fitted: Fitted | Formula | WoeLogistic, label: str, key: Sequence[str], *, sample: str = "sample", metric: str = "gini", share: float = 1.0, relative: bool = False, seed: int = 0) -> DataFrame:
    """(sample, feature, importance): how much the metric worsens when a feature is shuffled.

    Gini and r2 are maximised (drop times 100), error metrics minimised (increase). `relative`
    divides by the unshuffled value.
    """
    scored, names = permuted_scores(df, key, fitted, label, sample=sample, share=share, seed=seed)
    if metric == "gini":
        # Only (variant, score) cells; they are counted before they are shuffled.
        cells = F.array(*[F.struct(F.lit(n).alias("permuted"), F.col(c).alias("score")) for n, c in names.items()])
        long = scored.select(sample, label, F.explode(cells).alias("_c")).select(sample, label, "_c.permuted", "_c.score")
        got = auc(long, [sample, "permuted"], "score", label).select(sample, "permuted", (2 * F.col("auc") - 1).alias("value"))
    else:
        wide = scored.groupBy(sample).agg(*[select_metric(metric)(F.col(label), F.col(c)).alias(c) for c in names.values()])
        cells = F.array(*[F.struct(F.lit(n).alias("permuted"), F.col(c).alias("value")) for n, c in names.items()])
        got = wide.select(sample, F.explode(cells).alias("_c")).select(sample, "_c.permuted", "_c.value")
    base = got.where(F.col("permuted") == "").select(sample, F.col("value").alias("base"))
    worse = F.col("base") - F.col("value") if metric in ("gini", "r2") else F.col("value") - F.col("base")
    size = F.try_divide(worse, F.col("base")) if relative else 100 * worse if metric in ("gini", "r2") else worse
    return join_on(got.where(F.col("permuted") != ""), base, [sample]).select(sample, F.col("permuted").alias("feature"), size.alias("importance"))


def factor_relevancy(importance: DataFrame, sample: str = "sample", limit: float = RELEVANT_SHARE) -> DataFrame:
    """Percent of features whose importance exceeds `limit` of the best one, per sample."""
    best = importance.groupBy(sample).agg(F.max("importance").alias("best"))
    strong = F.try_divide(F.col("importance"), F.col("best")) > limit
    return join_on(importance, best, [sample]).groupBy(sample).agg(
        (100 * F.count_if(strong) / F.count("importance")).alias("factors_relevancy")
    )


def ranked(scores: DataFrame, value: str = "importance", name: str = "feature") -> DataFrame:
    return scores.orderBy(F.desc_nulls_last(value), name)


def select_features(scores: DataFrame, *, threshold: float | None = None, top_k: int | None = None, value: str = "importance", name: str = "feature") -> DataFrame:
    """Features above a threshold, or the k best."""
    if (threshold is None) == (top_k is None):
        raise ValueError("give either threshold or top_k")
    if threshold is not None:
        return ranked(scores.where(F.col(value) > threshold), value, name)
    return ranked(scores, value, name).limit(top_k)


def final_features(scores: DataFrame, threshold: float, forced: Sequence[str], limit: int = 20, top_k: int = 19) -> list[str]:
    """Features above the threshold, the best 19 when there are over 20, plus the forced ones."""
    names = [r["feature"] for r in select_features(scores, threshold=threshold).select("feature").collect()]
    return list(dict.fromkeys([*(names if len(names) <= limit else names[:top_k]), *forced]))


def tree_correlation(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str] = ("sample",), fit_on: str | None = None) -> DataFrame:
    """(sample, feature, correlation): 100 * corr(depth-3 tree on one feature, target).

    Every sample has its own trees, as the stability report needs, a sample without a name too; `fit_on` names the
    only sample to use.
    """
    rows = df if fit_on is None else df.where(F.col(keys[0]) == fit_on)
    found = feature_tree_correlation(rows, features, target, keys)
    return found.select(*keys, "feature", (100 * F.col("correlation")).alias("correlation"))


def correlation_delta(correlations: DataFrame, samples: Sequence[str], sample: str = "sample", base: str = "train") -> DataFrame:
    """Correlation per feature by sample with the relative change against train."""
    wide = correlations.groupBy("feature").agg(*[F.max(F.when(F.col(sample) == s, F.col("correlation"))).alias(s) for s in samples])
    return wide.withColumns({f"delta_{base}_vs_{s}": F.try_divide(F.col(s) - F.col(base), F.col(base)) for s in samples if s != base})


def feature_curve(df: DataFrame, fit: Callable[..., Fitted], ranking: Sequence[str], label: str, *, sample: str = "sample") -> DataFrame:
    """Gini of models refitted on the best 1..k features, with the report's lights.

    The columns are written once; the fits run side by side from those files, and one pass over them,
    equal rows as one, has all scores.
    red: a smaller set beats the full one by 0.05; yellow: at most 60 % of the features lose less
    than 0.01.
    """
    rows = settle(df.where(F.col(sample).isin("train", "valid")).select(*dict.fromkeys([sample, label, *ranking])))
    sizes = range(1, len(ranking) + 1)
    fits = side_by_side([partial(fit, rows, list(ranking[:k]), label, sample=sample) for k in sizes])
    scored = multi_model_scores(points(rows, [sample, label, *ranking]), {str(k): m for k, m in zip(sizes, fits)}, [sample, label, "_n"])
    long = settle(scored.withColumn("feature_num", F.col("model").cast("int")).drop("model"))
    got = auc(long, ["feature_num", sample], "score", label, weight="_n")
    value = 2 * F.col("auc") - 1
    wide = got.groupBy("feature_num").agg(*[F.max(F.when(F.col(sample) == s, value)).alias(f"gini_{s}") for s in ("train", "valid")])
    full = wide.where(F.col("feature_num") == len(ranking)).select("gini_valid").scalar()
    table = wide.withColumn("feature", F.element_at(F.lit(list(ranking)), F.col("feature_num"))).withColumn(
        "features_share", F.col("feature_num") / len(ranking)
    ).withColumn("delta_full", full - F.col("gini_valid"))
    yellow = F.when((F.col("delta_full") < 0.01) & (F.col("features_share") <= 0.6), "yellow")
    return table.withColumn("status", F.coalesce(status_boundary(F.col("delta_full"), -0.05), yellow))
