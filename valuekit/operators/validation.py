"""The validation suite: all checks of a model type over one settled prediction frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.functions.columns import MISSING_CATEGORY
from valuekit.operators import binary, importance, profile, regression, stability
from valuekit.operators.training import Fitted, Formula
from valuekit.roles import SAMPLES, Roles
from valuekit.session import settle

# Edges of the report's bin tables by model type.
BIN_EDGES = {"binary": 20, "regression": 21, "other": 20}


def validation_suite(df: DataFrame, roles: Roles, model_type: str, *, score: str = "score", fitted: Fitted | Formula | None = None, refit: Callable[..., Fitted] | None = None, unlog: Callable[[Column], Column] | None = None, tables: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Table name to DataFrame. `df` already carries the score.

    The frame is settled first, because every check reads it and the score should be computed
    once. `fitted` adds the checks that have to score again (permutation importance); its features need not be among
    those of `roles`, which are the reported ones. Samples of any name are compared, those without a name as "NA".
    `refit` adds the curve of models on the best 1..k features of a binary model, `unlog` takes target and score of a
    regression back from their log scale first. `other` models have the checks of binary ones, as far as they need no
    classes of their own. `tables` names those that are wanted, where it is not all; only they, and what they build on,
    are computed.
    """
    if model_type not in BIN_EDGES:
        raise ValueError(f"model_type must be one of {sorted(BIN_EDGES)}, not {model_type!r}")
    sample, label = roles.sample, roles.target
    named = df.withColumn(sample, F.coalesce(sample, F.lit(MISSING_CATEGORY)))
    if unlog is not None:
        named = named.withColumns({c: unlog(F.col(c)) for c in (label, score)})
    two_classes = model_type in ("binary", "other")
    scored_again = fitted.features if fitted is not None else ()
    rows = settle(named.select(*dict.fromkeys([*roles.id, sample, label, score, *roles.features, *scored_again])))
    # Names of samples are configuration; the known ones come first, in the report's order.
    present = {r[0] for r in rows.select(sample).distinct().collect()}
    samples = [*(s for s in SAMPLES if s in present), *sorted(present.difference(SAMPLES))]
    against = [*stability.comparison_samples(samples), *(s for s in samples if s not in SAMPLES)]
    numeric = [*roles.numeric]

    made: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name not in made:
            made[name] = build[name]()
        return made[name]

    in_train = rows.where(F.col(sample) == "train")
    parts = ("all", "events", "nevents") if two_classes else ("all",)
    build: dict[str, Callable[[], DataFrame]] = {
        "variable_profile": lambda: profile.variable_profile(in_train, numeric, roles.categorical),
        "variable_types": lambda: profile.variable_types(rows, label, numeric, roles.categorical),
        "psi_detailed": lambda: settle(stability.detailed_psi(
            rows, [*numeric, score], roles.categorical, sample=sample, label=label if two_classes else None, against=against
        )),
        "psi_short": lambda: stability.short_psi(table("psi_detailed"), against, parts),
    }
    if two_classes:
        build |= {
            "data_statistics": lambda: profile.sample_stats(rows, label, sample),
            "metrics": lambda: binary.binary_metrics(rows, [sample], score, label),
            "bins": lambda: binary.binary_bins(rows, [sample], score, label, BIN_EDGES[model_type]),
            "auc_interval": lambda: binary.auc_interval(rows, [sample], score, label),
            "gini_features": lambda: settle(binary.gini_with_flags(binary.feature_gini(in_train, numeric, label), numeric)),
            "gini_stability": lambda: binary.gini_stability(rows, numeric, score, label, samples, sample),
        }
        if refit is not None and model_type == "binary":

            def curve() -> DataFrame:
                ranking = [r["feature"] for r in importance.ranked(table("gini_features"), "gini").select("feature").collect()]
                return importance.feature_curve(rows, refit, ranking, label, sample=sample)

            build["feature_curve"] = curve
        metric = "gini"
    else:
        build |= {
            "data_statistics": lambda: profile.target_stats(rows, label, [sample]),
            "metrics": lambda: regression.regression_metrics(rows, [sample], label, score, regression.mape_plain),
            "metric_delta": lambda: regression.regression_delta(table("metrics"), samples, sample),
            "bins": lambda: regression.regression_bins(rows, [sample], label, score, BIN_EDGES[model_type]),
            "rec_curve": lambda: regression.rec_curve(in_train, [sample], label, score),
            "rec_area": lambda: regression.rec_area(in_train, [sample], label, score),
            "tree_correlation": lambda: settle(importance.tree_correlation(rows, numeric, label, (sample,))),
            "tree_correlation_delta": lambda: importance.correlation_delta(table("tree_correlation"), samples, sample),
        }
        metric = "mae"
    if fitted is not None:
        build |= {
            "permutation_importance": lambda: settle(importance.permutation_importance(rows, fitted, label, roles.id, sample=sample, metric=metric)),
            "factor_relevancy": lambda: importance.factor_relevancy(table("permutation_importance"), sample),
        }
    if tables is not None and (unknown := set(tables) - set(build)):
        raise ValueError(f"unknown tables {sorted(unknown)}, expected some of {sorted(build)}")
    return {name: table(name) for name in build if tables is None or name in tables}


def suite_values(tables: dict[str, DataFrame], names: Sequence[str] | None = None) -> DataFrame:
    """(check, key, measure, value): every number of every table of the suite, in long form.

    The key is the row's other columns. Unlike a count of rows, this evaluates each measure. Each table is written
    first: one plan of all of them takes more memory of the driver than the tables do.
    """
    out = None
    for name in names or sorted(tables):
        table = settle(tables[name])
        measures = [f.name for f in table.schema if isinstance(f.dataType, T.NumericType)]
        others = [f.name for f in table.schema if f.name not in measures]
        key = F.concat_ws("|", F.lit(""), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")) for c in others])
        numbers = table.select(F.lit(name).alias("check"), key.alias("key"), *[F.col(f"`{m}`").cast("double").alias(m) for m in measures])
        part = numbers.unpivot(["check", "key"], measures, "measure", "value")
        out = part if out is None else out.unionByName(part)
    return out
