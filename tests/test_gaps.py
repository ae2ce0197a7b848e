"""Nothing vanishes: empty columns and groups, null keys and strata, unknown samples."""

import os

import pytest
from pyspark.sql import functions as F

from valuekit.operators import binary, importance, profile, ranks, regression, split, stability, validation
from valuekit.roles import Roles


def gappy(spark):
    rows = [(i, "train" if i % 2 else "OOT", float(i), None if i % 2 else float(i), None, "a" if i % 3 else None, i % 5 == 0) for i in range(60)]
    rows += [(100 + i, None, float(i), 1.0, None, "b", None) for i in range(6)]
    return spark.createDataFrame(rows, "id long, sample string, full double, late double, empty double, c string, flag boolean").withColumn("y", F.col("flag").cast("int"))


def test_running_totals_null_keys(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), (None, 1.0), (None, 3.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    n = {"n": F.count(F.lit(1))}
    one, ranged = (sorted(map(str, ranks.running_totals(df, ["g"], "v", n, totals=True, cuts=c).collect())) for c in ([], [2.5]))
    assert one == ranged and len(one) == 6


def test_every_variable_is_profiled(spark):
    got = {r["feature"]: r for r in profile.variable_profile(gappy(spark).withColumn("none", F.lit(None).cast("string")), ["full", "empty"], ["c", "none"]).collect()}
    assert {f: (r["n_filled"], r["n_unique"]) for f, r in got.items()} == {"full": (66, 60), "empty": (0, 1), "c": (46, 3), "none": (0, 1)}
    assert got["empty"]["share_filled"] == 0.0 and got["empty"]["mean"] is None


def test_groups_without_a_target_stay(spark):
    df = gappy(spark)
    stats = {r["sample"]: r["n_obs"] for r in profile.target_stats(df, "y").collect()}
    assert stats == {"train": 30, "OOT": 30, None: 0}
    assert {r["sample"] for r in binary.score_bins(df, ["sample"], "full").collect()} == {"train", "OOT", None}
    table = regression.regression_bins(df.where("sample IS NULL OR sample = 'OOT'").withColumn("y", F.col("full")), ["sample"], "y", "late", 5)
    assert {r["sample"] for r in table.collect()} == {"OOT", None}


def test_psi_of_an_empty_feature_is_unknown(spark):
    got = {r["feature"]: tuple(r)[1:] for r in stability.psi_selection(stability.numeric_psi(gappy(spark), ["full", "late", "empty"]), 0.5).collect()}
    assert got["late"] == (None, 0) and got["empty"] == (None, 0) and got["full"][1] == 1


def test_unlabelled_rows_are_split_too(spark):
    parts = split.split_rows(gappy(spark), ["id"], {"train": 0.5, "test": 0.5}, strata=["y"], sample="part")
    assert parts.count() == 66
    assert {r["part"]: r["count"] for r in parts.where("y IS NULL").groupBy("part").count().collect()} == {"train": 3, "test": 3}


def test_validation_knows_its_samples_among_many(spark):
    rows = [(i, ("train", "test", "OOT", *[f"x{k}" for k in range(40)])[i % 43], i % 3 == 0, float(i % 7), float(i)) for i in range(860)]
    df = spark.createDataFrame(rows, "id long, sample string, flag boolean, a double, score double").withColumn("y", F.col("flag").cast("int"))
    tables = validation.validation_suite(df.withColumn("score", F.col("score") / 860), Roles(id=("id",), target="y", numeric=("a",)), "binary")
    assert {"gini_train", "gini_test", "gini_OOT"} & set(tables["gini_stability"].columns) or tables["gini_stability"].count() > 0
    assert {r["sample"] for r in tables["metrics"].collect()} >= {"train", "test", "OOT"}


def test_tree_paths_against_each_prefix(spark):
    from valuekit.operators import training

    rows = [(i, "train" if i % 3 else "valid", float(i % 11), float(i % 7), int((i * 7919) % 13 < 5 + i % 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, sample string, a double, b double, y int")
    fitted = training.fit_gbt(df, ["a", "b"], "y", early_stop=False, maxIter=3, maxDepth=2)
    path = {r["n_trees"]: r["gini_train"] for r in training.tree_path_gini(fitted, df, "y").collect()}
    last = 100 * binary.gini(fitted.score(df).where("sample = 'train'"), ["sample"], "score", "y").first()["gini"]
    assert sorted(path) == [1, 2, 3] and abs(path[3] - last) < 1e-9
    value = training.fit_gbt_regression(df.withColumn("z", F.col("a") * 2 + F.col("b")), ["a", "b"], "z", maxIter=3, maxDepth=2)
    scored = value.score(df.withColumn("z", F.col("a") * 2 + F.col("b"))).where("sample = 'valid'")
    error = scored.agg(F.avg(F.abs(F.col("z") - F.col("score")))).first()[0]
    got = {r["n_trees"]: r["valid"] for r in training.regression_path(value, df.withColumn("z", F.col("a") * 2 + F.col("b")), "z").collect()}
    assert abs(got[max(got)] - error) < 1e-9


def test_null_samples_stay_in_regression_reports(spark):
    rows = [(i, s, float(i * 7 % 11), float(i * 5 % 13)) for i, s in enumerate(["train", None] * 20)]
    df = spark.createDataFrame(rows, "id long, sample string, y double, p double")
    named = df.withColumn("sample", F.coalesce("sample", F.lit("none")))

    def same(report):
        got = [sorted(tuple("none" if v is None and k == "sample" else v for k, v in r.asDict().items()) for r in report(d).collect()) for d in (df, named)]
        assert got[0] == got[1] and {"train", "none"} <= {v for r in got[0] for v in r if isinstance(v, str)}

    same(lambda d: regression.rec_curve(d, ["sample"], "y", "p"))
    same(lambda d: regression.rec_area(d, ["sample"], "y", "p"))
    same(lambda d: regression.regression_metrics(d, ["sample"], "y", "p"))


def test_null_values_have_no_spearman_rank(spark):
    rows = [(None, 1.0, 1.0), (None, 2.0, 3.0), (None, 3.0, 2.0)]
    df = spark.createDataFrame([*rows, (None, None, 4.0)], "sample string, y double, p double")
    assert abs(regression.spearman(df, ["sample"], "y", "p").first()["spearman"] - 0.5) < 1e-9


def test_null_sample_stays_in_permutation_importance(spark):
    from valuekit.operators import training

    rows = [(i, "train" if i % 2 else None, float(i % 11), float(i % 7), float(i % 11) + i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, sample string, a double, b double, y double")
    fitted = training.fit_gbt_regression(df.withColumn("sample", F.when(F.col("id") % 3 > 0, "train").otherwise("valid")), ["a", "b"], "y", maxIter=2, maxDepth=2)
    got = importance.permutation_importance(df, fitted, "y", ["id"], metric="mae").collect()
    assert {(r["sample"], r["feature"]) for r in got} == {(s, f) for s in ("train", None) for f in ("a", "b")}
    assert all(r["importance"] is not None for r in got)


@pytest.mark.parametrize(("kind", "day"), [("view", "2024-01-31"), ("return", "2024-01-05"), ("view", "2023-12-31")])
def test_event_outside_the_layout_is_an_error(spark, sf, tmp_path, kind, day):
    from valuekit.plans import fixtures

    for name in ("orders", "lineitem", "customer"):
        os.symlink(f"{sf}/{name}.parquet", tmp_path / f"{name}.parquet")
    events = spark.read.parquet(f"{sf}/events.parquet")
    kinds = {f.name: f.dataType for f in events.schema}
    odd = events.limit(1).withColumns({"event_type": F.lit(kind), "ts": F.lit(f"{day} 10:00:00").cast(kinds["ts"])})
    events.unionByName(odd).write.parquet(str(tmp_path / "events.parquet"))
    with pytest.raises(Exception, match="outside the layout"):
        fixtures.targets_wide(spark, str(tmp_path)).collect()


def test_model_queries_use_every_numeric_feature(spark, sf):
    from valuekit.plans import fixtures, model_queries

    assert {r["feature"] for r in model_queries.feature_curve(spark, sf).collect()} == set(fixtures.NUMERIC)
    keys = [r["key"] for r in model_queries.validation_suite(spark, sf).where("check = 'binary_gini_features'").select("key").distinct().collect()]
    assert all(any(f in k.split("|") for k in keys) for f in fixtures.NUMERIC)


def test_ordered_split_of_large_and_missing_values(spark):
    keys = [None, None, *[5_000_000_000 + 7 * i for i in range(6)], *[9_000_000_000] * 2]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k long")
    got = {r["id"]: r["sample"] for r in split.split_ordered(df, "k", {"train": 0.4, "valid": 0.4, "test": 0.2}).collect()}
    # The two rows without a value stand first among the ten, but no cut holds them.
    assert [got[i] for i in range(10)] == ["test"] * 2 + ["train"] * 2 + ["valid"] * 4 + ["test"] * 2
    cuts = [split.value_cuts(df.withColumn("_hash", F.col("k")), [], {"train": 0.4, "valid": 0.8}, n).first() for n in (2, 100)]
    assert cuts[0] == cuts[1]


def test_suite_builds_wanted_tables_only(spark, monkeypatch):
    df = spark.createDataFrame([(i, "train" if i % 2 else "test", i % 3 % 2, float(i % 5), i / 40) for i in range(40)], "id long, sample string, y int, a double, score double")
    roles = Roles(id=("id",), target="y", numeric=("a",))
    whole = validation.validation_suite(df, roles, "binary")["metrics"].collect()

    def unasked(*args, **kwargs):
        raise AssertionError("not asked for")

    monkeypatch.setattr(validation.stability, "detailed_psi", unasked)
    one = validation.validation_suite(df, roles, "binary", tables=["metrics"])
    assert list(one) == ["metrics"] and sorted(one["metrics"].collect()) == sorted(whole)
    with pytest.raises(ValueError, match="unknown"):
        validation.validation_suite(df, roles, "binary", tables=["metric_delta"])


def test_suite_query_holds_every_table(spark, sf):
    """The curve of errors, the checks that score again and the curve of refitted models among them."""
    from valuekit.plans import fixtures, model_queries

    rows = model_queries.validation_suite(spark, sf).collect()
    common = {"variable_profile", "variable_types", "psi_detailed", "psi_short", "data_statistics", "metrics", "bins", "permutation_importance", "factor_relevancy"}
    wanted = {f"binary_{t}" for t in common | {"auc_interval", "gini_features", "gini_stability", "feature_curve"}}
    wanted |= {f"regression_{t}" for t in common | {"metric_delta", "rec_curve", "rec_area", "tree_correlation", "tree_correlation_delta"}}
    assert {r["check"] for r in rows} == wanted
    orders = fixtures.regression_sample(spark, sf).where("sample = 'train'")
    curve = regression.rec_curve(orders, ["sample"], "y", "y_pred").collect()
    got = {m: sorted(r["value"] for r in rows if r["check"] == "regression_rec_curve" and r["measure"] == m) for m in ("error", "share")}
    assert {m: len(v) for m, v in got.items()} == {m: len(curve) for m in got} and len(curve) > 100
    assert all(abs(a - b) < 1e-3 for m in got for a, b in zip(got[m], sorted(r[m] for r in curve)))
    moved = {r["key"].split("|")[-1] for r in rows if r["check"] == "binary_permutation_importance"}
    assert moved == {"l_quantity", "l_discount", "l_tax", "p_size", "T"}


def test_model_of_the_suite_may_have_other_features(spark):
    from valuekit.operators.training import Formula

    df = spark.createDataFrame([(i, "train" if i % 2 else "test", i % 3 % 2, float(i % 5), i % 3 / 4, i / 40) for i in range(40)], "id long, sample string, y int, a double, b double, score double")
    fitted = Formula(("a", "b"), lambda x: x["a"] / 10 + x["b"])
    tables = validation.validation_suite(df, Roles(id=("id",), target="y", numeric=("a",)), "binary", fitted=fitted, tables=["permutation_importance", "gini_features"])
    assert {r["feature"] for r in tables["permutation_importance"].collect()} == {"a", "b"}
    assert [r["feature"] for r in tables["gini_features"].collect()] == ["a"]
