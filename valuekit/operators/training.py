"""Response and value models on `pyspark.ml`, their evaluation and selection."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.functions.columns import filled, known
from valuekit.operators.binary import auc
from valuekit.operators.frames import long_numeric
from valuekit.operators.prefixes import prefix_auc, tree_predictions
from valuekit.operators.ranks import broadcast_within, quantiles, unique_edges
from valuekit.operators.regression import select_metric
from valuekit.session import settle

VECTOR = "_features"
#: Fits that run side by side in a search.
WORKERS = 4
# Largest accepted train-valid gap of Gini points, absolute and relative (percent).
GINI_GAP, GINI_GAP_PERCENT = 5.0, 10.0


def nominal_values(df: DataFrame, feature: str) -> int | None:
    """How many codes a column marked as categorical has (see `clean.mark_categories`); null for a number."""
    found = df.schema[feature].metadata.get("ml_attr", {})
    return found.get("num_vals") if found.get("type") == "nominal" else None


def vector_inputs(df: DataFrame, features: Sequence[str], columns: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """Feature to what enters its vector: missing numbers are -9999, and a code outside 0..n-1 is one more category, n.

    The mark of a categorical column goes with it, so that trees split its codes by sets and not by order. `columns`
    replaces the values of single features.
    """
    out = {}
    for f in features:
        value, n = (columns or {}).get(f, F.col(f)), nominal_values(df, f)
        if n is None:
            out[f] = filled(value)
        else:
            code = F.when((value >= 0) & (value < n), value).otherwise(n).cast("double")
            out[f] = code.alias(f, metadata={"ml_attr": {"type": "nominal", "num_vals": n + 1}})
    return out


def with_vector(df: DataFrame, features: Sequence[str], name: str = VECTOR) -> DataFrame:
    """Add the feature vector."""
    prepared = {f"_v_{f}": c for f, c in vector_inputs(df, features).items()}
    assembler = VectorAssembler(inputCols=list(prepared), outputCol=name)
    return assembler.transform(df.withColumns(prepared)).drop(*prepared)


def bins_for(df: DataFrame, features: Sequence[str], params: Mapping[str, Any]) -> dict[str, Any]:
    """Fit parameters with as many bins as the largest categorical feature needs."""
    most = max([n + 1 for f in features if (n := nominal_values(df, f)) is not None], default=0)
    return {**params, "maxBins": max(most, params.get("maxBins", 32))}


@dataclass
class Fitted:
    """A fitted model with its feature list. `score` adds P(y = 1), or the predicted value."""

    model: Any
    features: tuple[str, ...]
    kind: str

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        return self.score_vector(with_vector(df, self.features), VECTOR, name).drop(VECTOR)

    def score_vector(self, df: DataFrame, vector: str, name: str) -> DataFrame:
        if self.kind == "regression":
            return self.model.transform(df, {self.model.featuresCol: vector, self.model.predictionCol: name})
        raw = f"_p_{name}"
        params = {
            self.model.featuresCol: vector,
            self.model.probabilityCol: raw,
            self.model.rawPredictionCol: "",
            self.model.predictionCol: "",
        }
        return self.model.transform(df, params).withColumn(name, vector_to_array(raw)[1]).drop(raw)


@dataclass
class Formula:
    """A fixed expression behind the interface of `Fitted`: baselines, rules, and models that another engine can check.

    `expression` maps the filled features to the score. An ensemble also names its `trees`, expressions whose weighted
    sum is the margin.
    """

    features: tuple[str, ...]
    expression: Callable[[Mapping[str, Column]], Column]
    trees: Sequence[Callable[[Mapping[str, Column]], Column]] = ()
    weights: Sequence[float] = ()

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        return df.withColumn(name, self.expression({f: filled(F.col(f)) for f in self.features}))

    def score_vector(self, df: DataFrame, vector: str, name: str) -> DataFrame:
        values = vector_to_array(vector)
        return df.withColumn(name, self.expression({f: F.get(values, F.lit(i)) for i, f in enumerate(self.features)}))


def _labelled(df: DataFrame, features: Sequence[str], label: str, sample: str) -> DataFrame:
    rows = df.where(F.col(sample).isin("train", "valid") & F.col(label).isNotNull())
    keep = rows.select(*features, F.col(label).cast("double").alias("_y"), (F.col(sample) == "valid").alias("_is_valid"))
    return with_vector(keep, features).select(VECTOR, "_y", "_is_valid")


def points(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Equal rows as one, with their number `_n`: where features have few values, many rows are few points to score."""
    return df.groupBy(*dict.fromkeys(columns)).agg(F.count(F.lit(1)).alias("_n"))


def _fit_on(estimator: Any, data: DataFrame) -> Any:
    """Fit with the rows held: boosting reads the validation rows once per iteration."""
    held = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(held)
    finally:
        held.unpersist()


def fit_gbt(df: DataFrame, features: Sequence[str], label: str, *, sample: str = "sample", early_stop: bool = True, seed: int = 1, **params) -> Fitted:
    """Boosted-tree classifier; with `early_stop` it keeps the trees up to the best AUC on the valid rows."""
    data = _labelled(df, features, label, sample)
    booster = GBTClassifier(featuresCol=VECTOR, labelCol="_y", seed=seed, **bins_for(df, features, params))
    fitted = Fitted(_fit_on(booster, data.where(~F.col("_is_valid"))), tuple(features), "binary")
    if not early_stop:
        return fitted
    # The trees are grown from the rows, as their split points are drawn from them; only what is scored is collapsed.
    valid = points(df.where((F.col(sample) == "valid") & F.col(label).isNotNull()), [label, *features])
    found = valid.select(*features, F.col(label).cast("double").alias("_y"), F.lit(True).alias("_is_valid"), "_n")
    return stopped(fitted, with_vector(found, features), "_n")


def stopped(fitted: Fitted, valid: DataFrame, weight: str | None = None) -> Fitted:
    """The ensemble cut after the prefix with the best AUC on `valid` (vector and `_y`), the shortest of equal ones.

    Without both classes in `valid` all trees stay.
    """
    rows = tree_predictions(fitted.model, valid, VECTOR, ["_is_valid", "_y", *([] if weight is None else [weight])])
    path = prefix_auc(rows, fitted.model.treeWeights, "_is_valid", "_y", weight=weight)
    best = path.where("auc IS NOT NULL").agg(F.max(F.struct("auc", (-F.col("n_trees")).alias("n"))).alias("best")).first().best
    return fitted if best is None else truncated(fitted, -best.n)


def truncated(fitted: Fitted, n_trees: int) -> Fitted:
    """The first trees of a boosted classifier as a model of its own."""
    model = fitted.model
    if n_trees >= len(model.trees):
        return fitted
    context = SparkContext._active_spark_context
    kind = context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = context._gateway.new_array(kind, n_trees), context._gateway.new_array(context._jvm.double, n_trees)
    for i in range(n_trees):
        trees[i], weights[i] = model.trees[i]._java_obj, float(model.treeWeights[i])
    java = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, trees, weights, model.numFeatures, model.numClasses)
    return Fitted(model._copyValues(GBTClassificationModel(java)), fitted.features, fitted.kind)


def fit_forest(df: DataFrame, features: Sequence[str], label: str, *, sample: str = "sample", seed: int = 1, **params) -> Fitted:
    data = _labelled(df, features, label, sample).where(~F.col("_is_valid"))
    forest = RandomForestClassifier(featuresCol=VECTOR, labelCol="_y", seed=seed, **bins_for(df, features, params))
    return Fitted(_fit_on(forest, data), tuple(features), "binary")


def fit_gbt_regression(df: DataFrame, features: Sequence[str], label: str, *, loss: str = "squared", sample: str = "sample", seed: int = 1, **params) -> Fitted:
    """Boosted-tree regression with squared or absolute loss."""
    booster = GBTRegressor(featuresCol=VECTOR, labelCol="_y", lossType=loss, seed=seed, **bins_for(df, features, params))
    booster.setValidationIndicatorCol("_is_valid").setParams(validationTol=0.0)
    return Fitted(_fit_on(booster, _labelled(df, features, label, sample)), tuple(features), "regression")


def tree_path_gini(fitted: Fitted | Formula, df: DataFrame, label: str, *, sample: str = "sample") -> DataFrame:
    """(n_trees, gini_train, gini_valid, absolute_diff, relative_diff) for every prefix of trees."""
    rows = df.where(F.col(sample).isin("train", "valid"))
    if isinstance(fitted, Formula):
        filled_in = {f: filled(F.col(f)) for f in fitted.features}
        said, weights = rows.select(sample, label, F.array(*[t(filled_in) for t in fitted.trees]).alias("trees")), fitted.weights
    else:
        said, weights = tree_predictions(fitted.model, with_vector(rows, fitted.features), VECTOR, [sample, label]), fitted.model.treeWeights
    got = prefix_auc(said, weights, sample, label)
    value = 100 * (2 * F.col("auc") - 1)
    wide = got.groupBy("n_trees").agg(*[F.max(F.when(F.col(sample) == s, value)).alias(f"gini_{s}") for s in ("train", "valid")])
    gap = F.col("gini_train") - F.col("gini_valid")
    return wide.withColumn("absolute_diff", gap).withColumn("relative_diff", F.try_divide(100 * gap, F.col("gini_train")))


def accepted_trees(path: DataFrame, max_gap: float = GINI_GAP, max_percent: float = GINI_GAP_PERCENT) -> DataFrame:
    """The largest tree count whose train-valid gap stays within both limits (null: none does)."""
    fine = (F.col("absolute_diff") <= max_gap) & (F.col("relative_diff") <= max_percent)
    return path.agg(F.max(F.when(fine, F.col("n_trees"))).alias("n_trees"), F.count_if(fine).alias("n_passing"), F.count(F.lit(1)).alias("n_built"))


def regression_path(fitted: Fitted | Formula, df: DataFrame, label: str, *, sample: str = "sample", metric: str = "mae") -> DataFrame:
    """(n_trees, train, valid, relative_diff): error of every prefix of trees of a regressor."""
    rows = df.where(F.col(sample).isin("train", "valid"))
    if isinstance(fitted, Formula):
        filled_in = {f: filled(F.col(f)) for f in fitted.features}
        rows, weights = rows.select(sample, label, *[t(filled_in).alias(f"_t{i}") for i, t in enumerate(fitted.trees)]), fitted.weights
    else:
        rows, weights = with_vector(rows, fitted.features).select(sample, label, VECTOR), fitted.model.treeWeights
        for i, tree in enumerate(fitted.model.trees):
            rows = tree.transform(rows, {tree.featuresCol: VECTOR, tree.predictionCol: f"_t{i}"})
    values, total = [], F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + F.col(f"_t{i}") * w
        values.append(total)
    # One aggregate column a prefix: rows are read once and never copied.
    names = [f"{i + 1}" for i in range(len(values))]
    per_sample = rows.groupBy(sample).agg(*[select_metric(metric)(F.col(label), v).alias(n) for n, v in zip(names, values, strict=True)])
    errors = per_sample.unpivot([sample], names, "_at", "error").select(sample, F.col("_at").cast("int").alias("n_trees"), "error")
    wide = errors.groupBy("n_trees").agg(*[F.max(F.when(F.col(sample) == s, F.col("error"))).alias(s) for s in ("train", "valid")])
    return wide.withColumn("relative_diff", F.try_divide(100 * F.abs(F.col("train") - F.col("valid")), F.col("train")))


@dataclass
class WoeLogistic:
    """Logistic model on weight-of-evidence bins; edges and weights are literals after the fit."""

    model: Any
    bins: Mapping[str, tuple[Sequence[float], Mapping[int, float], float]]

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.bins)

    def transformed(self, df: DataFrame) -> DataFrame:
        """Replace every feature by the weight of its bin, as compiled CASE expressions."""
        def weight(name: str) -> Column:
            edges, weights, missing = self.bins[name]
            value = known(F.col(name))
            out = F.lit(weights.get(len(edges), 0.0))
            for i in range(len(edges) - 1, -1, -1):
                out = F.when(value <= edges[i], F.lit(weights.get(i, 0.0))).otherwise(out)
            return F.when(value.isNull(), F.lit(missing)).otherwise(out)

        return df.withColumns({f: weight(f) for f in self.bins})

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        woe = self.transformed(df.withColumns({f"_raw_{f}": F.col(f) for f in self.bins}))
        scored = Fitted(self.model, self.features, "binary").score(woe, name)
        return scored.drop(*self.bins).withColumnsRenamed({f"_raw_{f}": f for f in self.bins}).select(*df.columns, name)


def fit_woe_logistic(df: DataFrame, features: Sequence[str], label: str, *, n_bins: int = 10, sample: str = "sample", **params) -> WoeLogistic:
    """Quantile bins, smoothed log odds ratio per bin, logistic regression on top."""
    train = df.where(F.col(sample) == "train")
    values = long_numeric(train, [label], features)
    cut = quantiles(values, ["feature"], "value", [i / n_bins for i in range(1, n_bins)], name="edges")
    edges = cut.select("feature", unique_edges(F.col("edges")).alias("edges"))
    joined = values.join(broadcast_within(edges, rows=len(features)), "feature", "left")
    number = F.size(F.filter("edges", lambda e: e < F.col("value")))
    y = F.col(label)
    # At most n_bins + 1 rows per feature come back: they become literals of the scoring plan.
    table = joined.groupBy("feature", "edges", F.when(F.col("value").isNotNull(), number).alias("bin")).agg(
        F.sum(y).cast("double").alias("pos"), F.sum(1 - y).cast("double").alias("neg")
    ).collect()
    bins = {}
    for f in features:
        rows = [r for r in table if r["feature"] == f]
        pos, neg = sum(r["pos"] for r in rows), sum(r["neg"] for r in rows)
        weights = {r["bin"]: math.log(((r["pos"] + 0.5) / (pos + 0.5)) / ((r["neg"] + 0.5) / (neg + 0.5))) for r in rows}
        bins[f] = (list(rows[0]["edges"] or []) if rows else [], {b: w for b, w in weights.items() if b is not None}, weights.get(None, 0.0))
    unfitted = WoeLogistic(None, bins)
    # Rows of the same bins are one weighted point, whatever the number of rows.
    points = unfitted.transformed(train).where(F.col(label).isNotNull()).groupBy(*features, F.col(label).cast("double").alias("_y")).agg(F.count(F.lit(1)).cast("double").alias("_w"))
    data = settle(with_vector(points, features).select(VECTOR, "_y", "_w"))
    return WoeLogistic(LogisticRegression(featuresCol=VECTOR, labelCol="_y", weightCol="_w", **params).fit(data), bins)


def side_by_side(tasks: Sequence[Callable[[], Any]], workers: int = WORKERS) -> list:
    """Results of driver-side tasks in their order; their Spark jobs share the cluster."""
    session = SparkSession.getActiveSession()
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        return list(pool.map(lambda task: inheritable_thread_target(session)(task)(), tasks))


def random_search(fit: Callable[..., Fitted], df: DataFrame, features: Sequence[str], label: str, bounds: Mapping[str, tuple[float, float]], *, integers: Sequence[str] = ("maxDepth", "maxIter", "maxBins", "numTrees"), n_iter: int = 5, seed: int = 1, sample: str = "sample", rungs: int = 0, workers: int = WORKERS) -> tuple[list[dict], Fitted]:
    """Seeded search within bounds by valid Gini: the trials with their Gini, and the model of the best one.

    The columns that trials need are written once, and every trial reads those files; trials run side by side and score
    equal valid rows once. With
    `rungs` the ensembles start at a 2^rungs-th of their trees, and after each rung the better half goes on with twice
    as many; a trial that stopped reports the Gini of its last rung and `share`, the part of its trees it got.
    """
    rng = random.Random(seed)
    trials = [{k: (round if k in integers else float)(rng.uniform(*b)) for k, b in bounds.items()} for _ in range(n_iter)]
    rows = settle(df.where(F.col(sample).isin("train", "valid")).select(*dict.fromkeys([sample, label, *features])))
    valid = settle(points(rows.where(F.col(sample) == "valid"), [label, *features]))
    done: dict[int, tuple[float, Fitted, float]] = {}

    def attempt(i: int, share: float) -> tuple[float, Fitted, float]:
        params = {k: max(1, round(v * share)) if k in ("maxIter", "numTrees") else v for k, v in trials[i].items()}
        fitted = fit(rows, features, label, sample=sample, **params)
        found = auc(fitted.score(valid), [], "score", label, weight="_n").first()["auc"]
        return (-1.0 if found is None else 2 * found - 1), fitted, share

    running = list(range(n_iter))
    for rung in range(rungs, -1, -1):
        share = 0.5**rung
        results = side_by_side([partial(attempt, i, share) for i in running], workers)
        done.update(zip(running, results))
        # Equal trials keep their order, so a rerun takes the same ones.
        running = sorted(running, key=lambda i: -done[i][0])[: max(1, -(-len(running) // 2))] if rung else running
    best = max(running, key=lambda i: done[i][0])
    return [t | {"gini_valid": done[i][0]} | ({"share": done[i][2]} if rungs else {}) for i, t in enumerate(trials)], done[best][1]


def score_columns(df: DataFrame, models: Mapping[str, Fitted | Formula | WoeLogistic]) -> tuple[DataFrame, dict[str, str]]:
    """`df` with a column of scores for each model, and the column's name by model.

    Models that read the same features share one vector, and all of them one row: the plan has one scan.
    """
    rows, vectors, names = df, {}, {}
    for i, (name, fitted) in enumerate(models.items()):
        names[name] = f"_score_{i}"
        if isinstance(fitted, WoeLogistic):
            rows = fitted.score(rows, names[name])
            continue
        if fitted.features not in vectors:
            vectors[fitted.features] = f"_vector_{len(vectors)}"
            rows = with_vector(rows, fitted.features, vectors[fitted.features])
        rows = fitted.score_vector(rows, vectors[fitted.features], names[name])
    return rows.drop(*vectors.values()), names


def multi_model_scores(df: DataFrame, models: Mapping[str, Fitted | Formula | WoeLogistic], keep: Sequence[str]) -> DataFrame:
    """(keep, model, score): every model's score as a row of one long frame."""
    rows, names = score_columns(df, models)
    cells = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("score")) for m, c in names.items()])
    return rows.select(*keep, F.explode(cells).alias("_m")).select(*keep, "_m.model", "_m.score")
