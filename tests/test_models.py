import math

import pytest
from pyspark.sql import functions as F

from valuekit.functions.columns import hash_fraction
from valuekit.operators import calibration, gates, importance, ranks, training


@pytest.fixture(scope="module")
def lines(spark):
    """A label that follows x strongly, z weakly and n not at all."""
    base = spark.range(1200).select(
        "id",
        hash_fraction(F.col("id"), seed=1).alias("x"),
        hash_fraction(F.col("id"), seed=2).alias("z"),
        hash_fraction(F.col("id"), seed=3).alias("n"),
        F.element_at(F.lit(["train", "train", "train", "valid", "test"]), (F.col("id") % 5 + 1).cast("int")).alias("sample"),
    )
    noise = hash_fraction(F.col("id"), seed=4)
    return base.withColumn("y", (noise < 0.1 + 0.7 * F.col("x") + 0.1 * F.col("z")).cast("int")).persist()


@pytest.fixture(scope="module")
def model(lines):
    return training.fit_gbt(lines, ["x", "z", "n"], "y", maxIter=4, maxDepth=2)


def test_nan_is_missing_in_ordered_operators(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "v double")
    for cuts in ([], [2.0]):
        assert ranks.quantiles(df, [], "v", [0.0, 1.0], cuts=cuts).first()["quantiles"] == [1.0, 3.0]


def test_permutation_moves_one_feature_and_keeps_its_values(lines):
    rows = importance.permuted_rows(lines, ["id"], ["x", "z"], ["y", "id"], share=1.0).persist()
    assert rows.count() == 3 * 1200
    real = lines.select("id", F.col("x").alias("x0"), F.col("z").alias("z0"))
    moved = rows.where("permuted = 'x'").join(real, "id")
    assert moved.where("z != z0").count() == 0 and moved.where("x = x0").count() == 0
    assert sorted(moved.select("sample", "x").collect()) == sorted(lines.select("sample", "x").collect())
    assert rows.where("permuted = ''").join(real, "id").where("x != x0 OR z != z0").count() == 0


def test_importance_ranks_the_driver_first(lines, model):
    got = importance.permutation_importance(lines.where("sample = 'test'"), model, "y", ["id"], share=1.0)
    names = [r["feature"] for r in importance.select_features(got, top_k=1).collect()]
    assert names == ["x"]
    assert importance.final_features(got, 1.0, ["T", "x"])[-1] == "T"
    with pytest.raises(ValueError):
        importance.select_features(got)


def test_tree_prefixes_end_at_the_full_model(lines, model):
    path = {r["n_trees"]: r for r in training.tree_path_gini(model, lines, "y").collect()}
    last = path[max(path)]
    full = {r["sample"]: 100 * (2 * r["auc"] - 1) for r in training.auc(model.score(lines), ["sample"], "score", "y").collect()}
    assert last["gini_train"] == pytest.approx(full["train"]) and last["gini_valid"] == pytest.approx(full["valid"])


def test_accepted_trees_takes_the_largest_passing_count(spark):
    rows = [(1, 1.0, 1.0), (2, 9.0, 1.0), (3, 2.0, 3.0), (4, 8.0, 20.0)]
    path = spark.createDataFrame(rows, "n_trees int, absolute_diff double, relative_diff double")
    assert tuple(training.accepted_trees(path).first()) == (3, 2, 4)


def test_woe_model_and_search(lines):
    woe = training.fit_woe_logistic(lines, ["x", "z"], "y", n_bins=5)
    scored = woe.score(lines)
    assert scored.columns == [*lines.columns, "score"] and scored.where("score <= 0 OR score >= 1").count() == 0
    weights = woe.bins["x"][1]
    assert weights[4] > weights[0]
    trials, best = training.random_search(training.fit_gbt, lines, ["x", "z"], "y", {"maxIter": (1, 2), "maxDepth": (1, 2)}, n_iter=2)
    assert len(trials) == 2 and best.model.getMaxIter() == max(trials, key=lambda t: t["gini_valid"])["maxIter"]


@pytest.mark.parametrize("method", calibration.METHODS)
def test_calibration_is_monotone_and_closer(lines, method):
    rows = lines.withColumn("p", 0.05 + 0.5 * F.col("x"))
    fitted = calibration.fit_calibration(rows.where("sample = 'train'"), "p", "y", method, features=["x", "z"], depth=1)
    done = fitted.apply(rows, "p").select("x", "y", "p", "y_calib")
    assert done.where("y_calib IS NULL").count() == 0
    raw, new = done.agg(F.avg(F.pow(F.col("y") - F.col("p"), F.lit(2))), F.avg(F.pow(F.col("y") - F.col("y_calib"), F.lit(2)))).first()
    assert new < raw
    if method != "dtree":
        ordered = [r["y_calib"] for r in done.orderBy("p").collect()]
        assert all(b >= a - 1e-12 for a, b in zip(ordered, ordered[1:]))


def test_equations_and_unknown_method(lines):
    assert calibration.Logistic(2.0, -1.0, "ln-odds").equation() == "1/(1+exp(-(2.0*ln(x/(1-x)) + -1.0)))"
    assert calibration.Line(1.0, 0.0, "odds").equation() == "y_odds = 1.0*(x/(1-x)) + 0.0"
    with pytest.raises(ValueError):
        calibration.fit_calibration(lines, "x", "y", "spline")


def test_linear_calibration_recovers_a_line(spark):
    df = spark.createDataFrame([(i / 400, float(0.2 + 0.5 * i / 400)) for i in range(400)], "p double, y double")
    row = calibration.linear_coefficients(df, [], "p", "y").first()
    assert math.isclose(row["slope"], 0.5, rel_tol=1e-9) and math.isclose(row["intercept"], 0.2, rel_tol=1e-9)


def test_gate_flags(spark):
    rows = [("cc2", "cc", 0, 0.6, 0.6, 0.6), ("pl", "cc", 0, 0.6, 0.6, 0.4), ("pl", "mb", 0, 0.2, 0.2, 0.2), ("ok", "mb", 0, 0.6, 0.6, 0.58)]
    df = spark.createDataFrame([(f"{b}_{s}", b, s, *r) for b, s, *r in rows], "model string, bp string, sp string, t_min int, gini_train double, gini_valid double, gini_test double")
    got = {r["model"]: (r["forbidden_start"], r["weak_gini"], r["unstable_gini"]) for r in gates.problem_models(df).collect()}
    assert got == {"cc2_cc": (True, False, False), "pl_cc": (False, False, True), "pl_mb": (False, True, False)}
