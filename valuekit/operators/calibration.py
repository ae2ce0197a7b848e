"""Calibration of binary scores and the tables that judge it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuekit.functions.columns import expit, logit, odds
from valuekit.operators.binary import score_bins
from valuekit.operators.frames import join_on
from valuekit.operators.isotonic import fit_isotonic
from valuekit.operators.ranks import known_cuts
from valuekit.operators.training import VECTOR, with_vector
from valuekit.session import settle_counted

# Calibration methods by name, and the clip of the log-loss.
METHODS = ("isotonic", "logistic", "logistic-odds", "logistic-ln-odds", "linear", "linear-odds", "linear-ln-odds", "dtree")
LOSS_EPS = 1e-5


def _scale(method: str) -> str:
    return "ln-odds" if method.endswith("ln-odds") else "odds" if method.endswith("odds") else "plain"


def _forward(p: Column, scale: str) -> Column:
    return {"plain": lambda: p, "odds": lambda: odds(p), "ln-odds": lambda: logit(p)}[scale]()


def _back(v: Column, scale: str) -> Column:
    return {"plain": lambda: v, "odds": lambda: F.try_divide(v, v + 1), "ln-odds": lambda: expit(v)}[scale]()


def linear_coefficients(df: DataFrame, keys: Sequence[str], score: str, label: str, *, scale: str = "plain", weighted: bool = False) -> DataFrame:
    """(keys, slope, intercept) of the line through the bin means; null for a group without two different points."""
    return linear_lines(df, keys, score, label, [(scale, weighted)]).select(*keys, "slope", "intercept")


def linear_lines(df: DataFrame, keys: Sequence[str], score: str, label: str, variants: Sequence[tuple[str, bool]]) -> DataFrame:
    """(keys, scale, weighted, slope, intercept): lines through the bin means (20 edges, 19 bins), binned once for all variants.

    Least squares in closed form over the bin rows; a weighted line uses the bins' event shares. Bins
    whose odds do not exist (rate 0 or 1) are left out.
    """
    rows, n = settle_counted(df.select(*dict.fromkeys([*keys, score, label])))
    binned = score_bins(rows, keys, score, 20, unbinned=None, cuts=known_cuts(n))
    means = binned.groupBy(*keys, "bin").agg(F.avg(score).alias("x"), F.avg(label).alias("y"), F.sum(label).alias("events"))
    # Rows outside the bins stay as a point without weight, so that their group does.
    events = F.when(F.col("bin").isNotNull(), F.col("events"))
    points = means.withColumn("share", F.try_divide(events, F.sum(events).over(Window.partitionBy(*keys))))
    sums = []
    for scale, weighted in variants:
        x, y = _forward(F.col("x"), scale), _forward(F.col("y"), scale)
        w = F.when(F.col("bin").isNotNull() & x.isNotNull() & y.isNotNull(), F.col("share") if weighted else F.lit(1.0))
        parts = {"w": w, "wx": w * x, "wy": w * y, "wxx": w * x * x, "wxy": w * x * y}
        sums.append(F.struct(F.lit(scale).alias("scale"), F.lit(weighted).alias("weighted"), *[F.sum(c).alias(n) for n, c in parts.items()]))
    lines = points.groupBy(*keys).agg(F.array(*sums).alias("lines")).select(*keys, F.explode("lines").alias("_l")).select(*keys, "_l.*")
    slope = F.expr("try_divide(wxy - try_divide(wx * wy, w), wxx - try_divide(wx * wx, w))")
    return lines.withColumn("slope", slope).select(*keys, "scale", "weighted", "slope", F.expr("try_divide(wy - slope * wx, w)").alias("intercept"))


@dataclass
class Line:
    slope: float
    intercept: float
    scale: str

    def apply(self, df: DataFrame, score: str, name: str = "y_calib") -> DataFrame:
        return df.withColumn(name, _back(self.slope * _forward(F.col(score), self.scale) + self.intercept, self.scale))

    def equation(self) -> str:
        x = {"plain": "x", "odds": "(x/(1-x))", "ln-odds": "ln(x/(1-x))"}[self.scale]
        y = {"plain": "y", "odds": "y_odds", "ln-odds": "y_ln_odds"}[self.scale]
        return f"{y} = {self.slope}*{x} + {self.intercept}"


@dataclass
class Logistic:
    slope: float
    intercept: float
    scale: str

    def apply(self, df: DataFrame, score: str, name: str = "y_calib") -> DataFrame:
        return df.withColumn(name, expit(self.slope * _forward(F.col(score), self.scale) + self.intercept))

    def equation(self) -> str:
        x = {"plain": "x", "odds": "(x/(1-x))", "ln-odds": "ln(x/(1-x))"}[self.scale]
        return f"1/(1+exp(-({self.slope}*{x} + {self.intercept})))"


@dataclass
class TreeLogistic:
    """Tree on the features, one logistic line of the score per leaf."""

    tree: Any
    features: tuple[str, ...]
    lines: Mapping[int, tuple[float, float]]

    def apply(self, df: DataFrame, score: str, name: str = "y_calib") -> DataFrame:
        leaves = _with_leaf(df, self.tree, self.features)
        slopes = F.lit(None).cast("double")
        shifts = slopes
        for leaf, (slope, shift) in self.lines.items():
            slopes = F.when(F.col("_leaf") == leaf, slope).otherwise(slopes)
            shifts = F.when(F.col("_leaf") == leaf, shift).otherwise(shifts)
        return leaves.withColumn(name, expit(slopes * F.col(score) + shifts)).drop("_leaf")

    def equation(self) -> None:
        return None


def _with_leaf(df: DataFrame, tree: Any, features: Sequence[str]) -> DataFrame:
    params = {tree.featuresCol: VECTOR, tree.leafCol: "_leaf", tree.predictionCol: "_c", tree.rawPredictionCol: "", tree.probabilityCol: ""}
    return tree.transform(with_vector(df, features), params).drop(VECTOR, "_c")


def _logistic_fit(points: DataFrame, rows: int, intercept: bool = True):
    # A unit L2 penalty on the summed loss is 1/n on Spark's mean loss.
    return LogisticRegression(featuresCol="_v", labelCol="_y", weightCol="_w", regParam=1.0 / max(rows, 1), standardization=False, fitIntercept=intercept).fit(points)


def fit_calibration(df: DataFrame, score: str, label: str, method: str, *, weighted: bool = False, features: Sequence[str] = (), depth: int = 3):
    """Fit one of `METHODS` on a score; `dtree` also needs the model's features.

    Equal scores are collapsed to weighted points before any iterative fit.
    """
    if method not in METHODS:
        raise ValueError(f"unknown calibration method {method!r}, expected one of {METHODS}")
    if method.startswith("linear"):
        row = linear_coefficients(df, [], score, label, scale=_scale(method), weighted=weighted).first()
        return Line(row["slope"], row["intercept"], _scale(method))
    if method == "dtree":
        return _fit_tree(df, score, label, features, depth)

    y = F.col(label).cast("double")
    if method == "isotonic":
        return fit_isotonic(df, score, label)
    points = df.groupBy(_forward(F.col(score), _scale(method)).alias("_x"), y.alias("_y")).agg(F.count(F.lit(1)).cast("double").alias("_w"))
    points = points.where(F.col("_x").isNotNull())
    vectors = VectorAssembler(inputCols=["_x"], outputCol="_v").transform(points)
    model = _logistic_fit(vectors, points.agg(F.sum("_w")).first()[0])
    return Logistic(float(model.coefficients[0]), float(model.intercept), _scale(method))


def _fit_tree(df: DataFrame, score: str, label: str, features: Sequence[str], depth: int) -> TreeLogistic:
    """Leaves and all leaf-wise lines. The lines are one logistic fit with a slope and a shift per
    leaf, so the number of passes does not grow with the leaves."""
    data = with_vector(df, features).withColumn("_y", F.col(label).cast("double"))
    tree = DecisionTreeClassifier(featuresCol=VECTOR, labelCol="_y", maxDepth=depth, leafCol="_leaf", seed=17).fit(data.select(VECTOR, "_y"))
    placed = _with_leaf(df.withColumn("_y", F.col(label).cast("double")), tree, features)
    points = placed.groupBy("_leaf", F.col(score).alias("_x"), "_y").agg(F.count(F.lit(1)).cast("double").alias("_w"))
    per_leaf = points.groupBy("_leaf").agg(F.sum("_w").alias("n")).orderBy("_leaf").collect()
    leaves = [r["_leaf"] for r in per_leaf]
    inputs = {}
    for i, leaf in enumerate(leaves):
        here = F.col("_leaf") == leaf
        inputs[f"_slope_{i}"] = F.when(here, F.col("_x")).otherwise(0.0)
        inputs[f"_shift_{i}"] = here.cast("double")
    vectors = VectorAssembler(inputCols=list(inputs), outputCol="_v").transform(points.withColumns(inputs)).select("_v", "_y", "_w")
    weights = _logistic_fit(vectors, int(sum(r["n"] for r in per_leaf)), intercept=False).coefficients
    lines = {int(leaf): (float(weights[2 * i]), float(weights[2 * i + 1])) for i, leaf in enumerate(leaves)}
    return TreeLogistic(tree, tuple(features), lines)


def calibration_stats(df: DataFrame, keys: Sequence[str] = (), score: str = "y_pred", calibrated: str = "y_calib", label: str = "y_true") -> DataFrame:
    """Bin table of the raw score (21 edges) with a `Total` row of error measures per group.

    The calibration error is the absolute gap of bin means weighted by bin rows; Brier score and
    log-loss cover all rows, also the smallest score that lies outside the bins.
    """
    # Equal rows are one weighted point; written once, since all passes read them.
    points, n = settle_counted(df.groupBy(*keys, score, calibrated, label).agg(F.count(F.lit(1)).alias("_n")))
    y = F.col(label).cast("double")
    binned = score_bins(points, keys, score, 21, unbinned=None, cuts=known_cuts(n), weight="_n")

    def mean(value: Column) -> Column:
        return F.try_divide(F.sum(value * F.col("_n")), F.sum(F.when(value.isNotNull(), F.col("_n"))))

    means = [mean(F.col(score)).alias("mean_proba"), mean(F.col(calibrated)).alias("calibration_proba"), mean(y).alias("event_rate")]
    bins = binned.where(F.col("bin").isNotNull()).groupBy(*keys, "bin").agg(*means, F.sum("_n").alias("n_obs"))

    def ece(name: str) -> Column:
        return F.try_divide(F.sum(F.abs(F.col("event_rate") - F.col(name)) * F.col("n_obs")), F.sum("n_obs"))

    def loss(name: str) -> Column:
        p = F.least(F.greatest(F.col(name), F.lit(LOSS_EPS)), F.lit(1 - LOSS_EPS))
        return mean(-(y * F.log(p) + (1 - y) * F.log(1 - p)))

    errors = bins.groupBy(*keys).agg(ece("mean_proba").alias("mae"), ece("calibration_proba").alias("mae_calibrated"), F.sum("n_obs").alias("n_obs"))
    rest = points.groupBy(*keys).agg(
        *means,
        *[mean(F.pow(y - F.col(c), F.lit(2.0))).alias(n) for c, n in ((score, "brier"), (calibrated, "brier_calibrated"))],
        loss(score).alias("logloss"),
        loss(calibrated).alias("logloss_calibrated"),
    )
    # Without keys both sides are one row and meet through a constant column.
    link = [*keys] or ["_all"]
    one = (lambda d: d) if keys else (lambda d: d.withColumn("_all", F.lit(0).cast("int")))
    # A group whose scores are all equal has no bins, but errors all the same.
    total = join_on(one(rest), one(errors), link, "left").withColumns({"n_obs": F.coalesce("n_obs", F.lit(0)), "bin": F.lit("Total")}).drop("_all")
    return bins.withColumn("bin", F.col("bin").cast("string")).unionByName(total, allowMissingColumns=True)


def calibration_comparison(stats: DataFrame, samples: Sequence[str], method: str = "method", sample: str = "sample") -> DataFrame:
    """One row per method: error measures before, after and their difference, by sample."""
    total = stats.where(F.col("bin") == "Total")
    columns = []
    for measure in ("mae", "brier", "logloss"):
        for s in samples:
            raw = F.max(F.when(F.col(sample) == s, F.col(measure)))
            new = F.max(F.when(F.col(sample) == s, F.col(f"{measure}_calibrated")))
            columns += [raw.alias(f"{measure}_{s}"), new.alias(f"{measure}_calibrated_{s}"), (new - raw).alias(f"delta_{measure}_{s}")]
    return total.groupBy(method).agg(*columns)


