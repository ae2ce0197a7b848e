"""Isotonic regression, trees of one feature, prefixes, categories and batch runs against plain versions."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuekit.operators import binary, calibration, clean, encode, feature_trees, importance, prefixes, regression, scoring, training
from valuekit.operators.isotonic import fit_isotonic, pool_adjacent
from valuekit.plans import batch, formulas


def plain_isotonic(points):
    """Score to value by the min-max formula."""
    xs = sorted({x for x, _ in points})
    s = [sum(y for x, y in points if x == v) for v in xs]
    w = [sum(1 for x, _ in points if x == v) for v in xs]
    mean = lambda a, b: sum(s[a : b + 1]) / sum(w[a : b + 1])
    return {x: max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i, x in enumerate(xs)}


@pytest.mark.parametrize("shape", ["noise", "falling", "rising", "constant", "ties"])
def test_isotonic_is_min_max_for_any_ranges(spark, shape):
    picks = random.Random(shape)
    made = {
        "noise": lambda i: (i / 60, int(picks.random() < 0.2 + 0.6 * i / 60)),
        "falling": lambda i: (i / 60, int(picks.random() < 0.9 - 0.8 * i / 60)),
        "rising": lambda i: (i / 60, i),
        "constant": lambda i: (0.5, i % 2),
        "ties": lambda i: ((i % 7) / 7, int(picks.random() < 0.5)),
    }[shape]
    points = [(float(x), float(y)) for x, y in map(made, range(60))]
    df = spark.createDataFrame([*points, (None, 1.0), (0.3, None), (float("nan"), 1.0)], "p double, y double")
    expected = plain_isotonic(points)
    for size in (1000, 9):
        fitted = fit_isotonic(df, "p", "y", rows_per_range=size)
        got = {r.p: r.v for r in fitted.apply(spark.createDataFrame([(x,) for x in expected], "p double"), "p", "v").collect()}
        assert got == pytest.approx(expected, abs=1e-12)
        blocks = fitted.blocks.orderBy("low").collect()
        assert all(a.high < b.low and a.value <= b.value + 1e-12 for a, b in zip(blocks, blocks[1:]))
        assert sum(b.n for b in blocks) == len(points)


def test_isotonic_between_blocks_by_either_way(spark):
    picks = random.Random(4)
    df = spark.createDataFrame([(i / 80, float(picks.random() < i / 80)) for i in range(80)], "p double, y double")
    asked = spark.createDataFrame([(picks.uniform(-0.5, 1.5), i) for i in range(300)] + [(None, -1), (float("nan"), -2), (0.25, -3), (0.25, -3)], "p double, i int")
    shipped = fit_isotonic(df, "p", "y")
    by_ranges = fit_isotonic(df, "p", "y", shipped_ends=4)
    key = lambda rows: sorted((r.i, r.v) for r in rows if r.v is not None)
    a, b = shipped.apply(asked, "p", "v"), by_ranges.apply(asked, "p", "v")
    assert a.columns == b.columns == ["p", "i", "v"] and a.count() == b.count() == 304
    assert [k for k, _ in key(a.collect())] == [k for k, _ in key(b.collect())]
    assert [v for _, v in key(a.collect())] == pytest.approx([v for _, v in key(b.collect())], abs=1e-12)
    empty = fit_isotonic(df.limit(0), "p", "y")
    assert empty.blocks.count() == 0 and empty.apply(asked, "p", "v").where("v IS NOT NULL").count() == 0


def test_pool_adjacent_pools_equal_means():
    x = np.arange(4.0)
    assert pool_adjacent(x, x, np.array([1.0, 1.0, 0.0, 3.0]), np.ones(4)) == [(0.0, 2.0, 2.0, 3.0), (3.0, 3.0, 3.0, 1.0)]


def plain_tree(rows, depth):
    """Leaf means of the exact tree of one feature as value to prediction."""
    def grow(part, level):
        n, s = len(part), sum(y for _, y in part)
        best = None
        for cut in sorted({v for v, _ in part})[:-1]:
            left = [y for v, y in part if v <= cut]
            gain = sum(left) ** 2 / len(left) + (s - sum(left)) ** 2 / (n - len(left)) - s * s / n
            if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                best = (gain, cut)
        if best is None or level == 0:
            return {v: s / n for v, _ in part}
        return grow([r for r in part if r[0] <= best[1]], level - 1) | grow([r for r in part if r[0] > best[1]], level - 1)

    return grow(rows, depth)


def test_trees_of_one_feature(spark, monkeypatch):
    picks = random.Random(9)
    rows = []
    for i in range(400):
        a, b = picks.choice([None, 1.0, 2.0, 3.0, 4.0, 5.0, float("nan")]), float(picks.randrange(30))
        rows.append((picks.choice(["train", "OOT", None]), a, b, 7.0, None if i % 50 == 0 else float(picks.random() < 0.1 + (0.6 if 8 < b < 17 else 0.0) + (0.2 if a == 3.0 else 0.0))))
    df = spark.createDataFrame(rows, "sample string, a double, b double, c double, y double")

    def expected():
        out = {}
        for sample in ("train", "OOT", None):
            for i, f in enumerate("abc", 1):
                part = [(-9999.0 if r[i] is None or r[i] != r[i] else r[i], r[4]) for r in rows if r[0] == sample and r[4] is not None]
                said = plain_tree(part, 3)
                p, y = [said[v] for v, _ in part], [t for _, t in part]
                out[sample, f] = 100 * np.corrcoef(p, y)[0, 1] if max(p) > min(p) else None
        return out

    for limit in (5_000_000, 20):
        monkeypatch.setattr(feature_trees, "cut_points", lambda cells, value, limit=limit: [] if limit > 1000 else [2.5, 9.0, 15.0])
        got = {(r.sample, r.feature): r.correlation for r in importance.tree_correlation(df, ["a", "b", "c"], "y").collect()}
        assert got.keys() == expected().keys()
        for k, v in expected().items():
            assert got[k] == (pytest.approx(v, abs=1e-9) if v is not None else None)
    only = importance.tree_correlation(df, ["b"], "y", fit_on="train").collect()
    assert [r.sample for r in only] == ["train"]


def test_prefix_auc_is_the_rank_sum(spark):
    picks = random.Random(3)
    rows = [(picks.choice(["train", "valid", None, "one"]), picks.randrange(2), [picks.choice([-1.0, 0.5, 0.25]), picks.uniform(-1, 1), picks.choice([-0.125, 2.0])]) for _ in range(500)]
    rows = [(s, 1 if s == "one" else y, t) for s, y, t in rows] + [("train", None, [9.0, 9.0, 9.0])]
    weights = [1.0, 0.5, 0.1]
    df = spark.createDataFrame(rows, "sample string, y int, trees array<double>").repartition(3)
    for bins in (1024, 4, 1):
        for r in prefixes.prefix_auc(df, weights, "sample", "y", bins).collect():
            part = [(np.cumsum(np.array(t) * weights)[r.n_trees - 1], y) for s, y, t in rows if s == r.sample and y is not None]
            pos, neg = [m for m, y in part if y], [m for m, y in part if not y]
            assert (r.n_rows, r.n_events) == (len(part), len(pos))
            expected = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg)) if pos and neg else None
            assert r.auc == (pytest.approx(expected, abs=1e-12) if expected is not None else None)


def test_prefixes_make_no_row_each(spark, capsys):
    df = spark.createDataFrame([("train", 1, [0.5, 0.25])], "sample string, y int, trees array<double>")
    prefixes.mixed_scores(df.selectExpr("0 AS slot", "y", "trees"), [1.0, 1.0], np.zeros((1, 2, 8), bool)).explain()
    plan = capsys.readouterr().out
    assert "Generate" not in plan and "Expand" not in plan


@pytest.fixture(scope="module")
def coded(spark):
    picks = random.Random(8)
    rows = [(i, float(picks.choice([0, 1, 2, 3, 4, 5, 6, 7])), picks.random(), "valid" if i % 4 == 0 else "train") for i in range(800)]
    df = spark.createDataFrame(rows, "id int, code double, noise double, sample string")
    return df.withColumn("y", F.col("code").isin(1.0, 4.0, 6.0).cast("int")).persist()


def test_marked_codes_are_split_by_sets(coded, tmp_path):
    marked = clean.mark_categories(coded, {"code": 8})
    marked.write.parquet(str(tmp_path / "marked"))
    stored = coded.sparkSession.read.parquet(str(tmp_path / "marked"))
    assert training.nominal_values(stored, "code") == 8 and training.nominal_values(stored, "noise") is None
    params = {"maxIter": 1, "maxDepth": 1, "early_stop": False}
    by_sets = training.fit_gbt(stored, ["code", "noise"], "y", **params)
    gini = {r.sample: r.auc for r in training.auc(by_sets.score(stored), ["sample"], "score", "y").collect()}
    assert gini == {"train": 1.0, "valid": 1.0}
    by_order = training.fit_gbt(coded, ["code", "noise"], "y", **params)
    assert training.auc(by_order.score(coded), [], "score", "y").first().auc < 0.9
    unseen = stored.limit(3).withColumn("code", F.lit(99.0).alias("code", metadata=stored.schema["code"].metadata))
    assert by_sets.score(unseen).where("score IS NOT NULL").count() == 3


def test_low_cardinality_counts_exactly(spark):
    df = spark.createDataFrame([(str(i // 2), str(i // 3), None) for i in range(60)], "half string, third string, none string")
    assert clean.low_cardinality(df, ["half", "third", "none"]) == ["third", "none"]


def test_boosting_keeps_the_prefix_with_the_best_valid_auc(spark):
    picks = random.Random(2)
    rows = [(picks.random(), picks.random(), "valid" if i % 3 == 0 else "train") for i in range(600)]
    df = spark.createDataFrame([(a, b, s, int(picks.random() < 0.2 + 0.5 * a)) for a, b, s in rows], "a double, b double, sample string, y int")
    params = {"maxIter": 6, "maxDepth": 4, "stepSize": 0.8}
    whole, kept = training.fit_gbt(df, ["a", "b"], "y", early_stop=False, **params), training.fit_gbt(df, ["a", "b"], "y", **params)
    path = {r.n_trees: r.gini_valid for r in training.tree_path_gini(whole, df, "y").collect()}
    n = len(kept.model.trees)
    assert path[n] == max(path.values()) and all(path[k] < path[n] for k in range(1, n))
    valid = df.where("sample = 'valid'")
    assert 100 * (2 * training.auc(kept.score(valid), [], "score", "y").first().auc - 1) == pytest.approx(path[n])
    without = training.fit_gbt(df.where("sample = 'train'"), ["a", "b"], "y", **params)
    assert len(without.model.trees) == 6


def test_permutation_scores_stay_on_the_row(spark):
    df = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z"), F.when(F.col("id") % 3 > 0, "test").alias("sample"))
    df = df.withColumn("y", (F.col("x") > 3).cast("int"))
    model = training.Formula(("x", "z"), lambda v: v["x"] * 2 + v["z"] * 0.125)
    scored, names = importance.permuted_scores(df, ["id"], model, "y")
    assert scored.count() == 300 and len(names) == 3
    got = importance.permutation_importance(df, model, "y", ["id"])
    assert {r.sample for r in got.collect()} == {"test", None}
    assert importance.factor_relevancy(got).count() == 2
    plain = importance.permuted_rows(df, ["id"], ["x", "z"], ["y"])
    for name, column in names.items():
        a = sorted((str(r.sample), r[1]) for r in scored.select("sample", column).collect())
        b = sorted((str(r.sample), r.score) for r in model.score(plain.where(F.col("permuted") == name)).collect())
        assert a == b


def test_all_pairs_in_one_scan_and_partitions(spark, tmp_path, capsys):
    spark.range(40).select("id", (F.col("id") % 5 * 10.0).alias("qty_amt"), F.lit(1.0).alias("total_amt"), F.lit(0.5).alias("disc_avg")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    models = {(f"b{i}", f"s{j}"): formulas.response(i * 5 + j) for i in range(5) for j in range(5)}
    table, failed = scoring.uplift_all(df, "id", models, {("b0", "s0"): scoring.Window(2, 3)}, treatment="cc")
    table.explain()
    assert capsys.readouterr().out.count("FileScan") == 1 and failed == {}
    models[("b1", "s1")] = training.Formula(("no_such",), lambda v: v["no_such"])
    path = str(tmp_path / "scores")
    got = {(r["bp"], r["sp"]): r for r in batch.score_all_pairs(df, models, {("b0", "s0"): scoring.Window(2, 3)}, path, key="id", treatment="cc")}
    assert got[("b1", "s1")]["status"] == "failed" and sum(r["status"] == "scored" for r in got.values()) == 24
    stored = spark.read.parquet(path)
    assert stored.count() == 24 * 40 and stored.where("bp = 'b0' AND sp = 's0'").selectExpr("size(filter(uplift, u -> NOT isnan(u))) AS n").first().n == 2
    other = stored.where("bp <> 'b1' OR sp <> 's1'").selectExpr("sum(hash(id, bp, sp, uplift)) AS h").first().h
    batch.score_all_pairs(df, {("b1", "s1"): formulas.response()}, {}, path, key="id", treatment="cc")
    again = spark.read.parquet(path)
    assert again.count() == 25 * 40 and again.where("bp <> 'b1' OR sp <> 's1'").selectExpr("sum(hash(id, bp, sp, uplift)) AS h").first().h == other


def test_many_models_in_one_scan(spark, tmp_path, capsys):
    spark.range(20).select("id", F.col("id").cast("double").alias("qty"), F.lit(2.0).alias("n_lines")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    long = training.multi_model_scores(df, {f"m{i}": formulas.VALUE if i % 2 else formulas.SMALL_VALUE for i in range(25)}, ["id"])
    long.explain()
    assert capsys.readouterr().out.count("FileScan") == 1
    assert long.count() == 500 and long.where("model = 'm1' AND id = 2").first().score == 1200.5 * 2 + 310.25 * 2


def test_encoding_resumes_from_its_ledger(spark, tmp_path):
    rows = spark.createDataFrame([(None if i % 10 == 0 else i, "ab"[i % 2], i) for i in range(100)], "k int, c string, v int")
    codes = encode.fit_dictionary(rows, ["c"])
    folder = str(tmp_path / "run")
    run = {"key": "k", "categorical": ["c"], "batches": 5}
    first = batch.encode_in_batches(rows, codes, folder, stop_after=2, **run)
    assert first.count() == 2
    # A batch that was written but not entered is done again.
    from valuekit.operators.split import hash_batches

    lost = hash_batches(rows, ["k"], 5).where("batch = 2").limit(3).withColumn("c", F.lit(0).cast("bigint"))
    lost.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{folder}/data")
    assert batch.encoded_rows(spark, folder).where("batch = 2").count() == 0
    assert batch.encode_in_batches(rows, codes, folder, **run).count() == 5
    done = batch.encoded_rows(spark, folder)
    assert sorted(r.v for r in done.collect()) == list(range(100)) and done.where("k IS NULL").count() == 10
    before = {f: open(f, "rb").read() for f in map(str, (tmp_path / "run").rglob("*.parquet"))}
    assert batch.encode_in_batches(rows, codes, folder, **run).agg(F.sum("n_rows")).first()[0] == 100
    assert {f: open(f, "rb").read() for f in map(str, (tmp_path / "run").rglob("*.parquet"))} == before


def test_pending_rows_knows_null_keys(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    assert encode.pending_rows(rows, rows, "k").count() == 0
    assert encode.pending_rows(rows, rows.where("k = 1"), "k").count() == 2


def test_hundred_features_one_dictionary(spark, capsys):
    names = [f"c{i}" for i in range(100)]
    df = spark.range(30).select("id", *[F.when(F.col("id") % (i + 2) > 0, F.concat(F.lit("v"), (F.col("id") % (i % 9 + 2)).cast("string"))).alias(n) for i, n in enumerate(names)])
    fitted = encode.fit_dictionary(df.where("id < 20"), names)
    out = encode.encode(df, fitted, names)
    out.explain()
    assert capsys.readouterr().out.count("Join") == 0
    codes = {(r.feature, r.value): r.code for r in fitted.collect()}
    known = defaultdict(lambda: 0, codes)
    for raw, got in zip(df.orderBy("id").collect(), out.orderBy("id").collect()):
        for n in names:
            value = raw[n] if raw[n] is not None else "NA"
            assert got[n] == (codes[n, value] if (n, value) in codes else known[n, "NA"])
    joined = encode.encode(df, fitted, names[:3], held_rows=0)
    assert sorted(map(tuple, joined.select("id", *names[:3]).collect())) == sorted(map(tuple, out.select("id", *names[:3]).collect()))


def test_groups_without_a_name_or_a_line(spark):
    df = spark.createDataFrame([("a", i / 50, i % 2) for i in range(50)] + [(None, i / 50, i % 3 % 2) for i in range(50)] + [("one", 0.5, i % 2) for i in range(9)], "sample string, y_pred double, y_true int")
    stats = calibration.calibration_stats(df.withColumn("y_calib", F.col("y_pred")), ["sample"])
    total = {r.sample: r for r in stats.where("bin = 'Total'").collect()}
    assert set(total) == {"a", None, "one"} and total["one"].n_obs == 0 and total["one"].mae is None and total["one"].brier == pytest.approx(0.25)
    lines = {r.sample: r for r in calibration.linear_coefficients(df, ["sample"], "y_pred", "y_true").collect()}
    assert set(lines) == {"a", None, "one"} and lines["one"].slope is None and lines["a"].slope is not None


def test_actions_before_the_query(spark, monkeypatch):
    """Ordered tables of several statistics: the input is written and counted, the bin edges fetched, nothing else runs ahead."""
    df = spark.createDataFrame([(s, float(i % 50), float(i % 37)) for i in range(400) for s in ("x", "y")], "sample string, y double, p double")
    runs = []
    for name in ("toArrow", "count", "collect", "first", "isEmpty"):
        original = getattr(type(df), name)
        monkeypatch.setattr(type(df), name, lambda self, *a, _f=original, _n=name: runs.append(_n) or _f(self, *a))
    regression.regression_bins(df, ["sample"], "y", "p")
    assert runs == ["count", "toArrow"]
    runs.clear()
    calibration.linear_lines(df, ["sample"], "p", "y", [("plain", False), ("odds", True)])
    assert runs == ["count", "toArrow"]


def test_search_reads_the_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x % 17)

    raw = spark.range(400).repartition(2).select("id", counted("id").alias("a"), (F.col("id") % 5).cast("double").alias("b"), F.when(F.col("id") % 3 == 0, "valid").otherwise("train").alias("sample"))
    df = raw.withColumn("y", (F.col("id") % 17 + F.col("id") % 7 > 11).cast("int"))
    bounds = {"maxIter": (1, 4), "maxDepth": (1, 3)}
    trials, best = training.random_search(training.fit_gbt, df, ["a", "b"], "y", bounds, n_iter=4, seed=3)
    assert seen.value == 400 and len(trials) == 4
    scores = []
    for t in trials:
        model = training.fit_gbt(df, ["a", "b"], "y", maxIter=t["maxIter"], maxDepth=t["maxDepth"])
        scores.append(2 * training.auc(model.score(df.where("sample = 'valid'")), [], "score", "y").first().auc - 1)
    assert [t["gini_valid"] for t in trials] == pytest.approx(scores)
    assert 2 * training.auc(best.score(df.where("sample = 'valid'")), [], "score", "y").first().auc - 1 == pytest.approx(max(scores))
    halved, _ = training.random_search(training.fit_gbt, df, ["a", "b"], "y", bounds, n_iter=4, seed=3, rungs=1)
    assert sorted(t["share"] for t in halved) == [0.5, 0.5, 1.0, 1.0]


def test_feature_curve_reads_the_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x % 17)

    raw = spark.range(300).repartition(2).select(counted("id").alias("a"), (F.col("id") % 5).cast("double").alias("b"), F.when(F.col("id") % 3 == 0, "valid").otherwise("train").alias("sample"), (F.col("id") % 17 > 8).cast("int").alias("y"))
    fit = lambda df, f, y, sample: training.Formula(tuple(f), lambda x: sum(x.values(), F.lit(0.0)))
    got = {r.feature_num: r for r in importance.feature_curve(raw, fit, ["a", "b"], "y").collect()}
    assert seen.value == 300 and got[1].gini_valid == 1.0 and got[2].feature == "b"


def test_points_score_as_their_rows(spark):
    rows = spark.range(600).select((F.col("id") % 17).cast("double").alias("a"), F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("double")).alias("b"), (F.col("id") % 3 == 0).alias("v"), F.col("id"))
    rows = rows.withColumn("y", F.when(F.col("id") % 11 > 0, (F.col("a") * 2 + F.col("id") % 7 > 17).cast("int"))).drop("id")
    rows = rows.union(rows.where("a > 8")).union(rows.where("a > 12"))
    points = training.points(rows, rows.columns)
    assert points.count() < rows.count() / 2
    scored = [df.withColumn("score", F.coalesce(F.col("a") - F.col("b"), F.lit(3.0))) for df in (rows, points)]
    table = lambda df, weight: sorted(tuple(r) for r in binary.gini(df, ["v"], "score", "y", weight).collect())
    assert table(scored[1], "_n") == [pytest.approx(r) for r in table(scored[0], None)]
    trees = F.array(F.col("a") / 20, F.coalesce("b", F.lit(0.0)) / 9)
    found = [
        sorted(tuple(r) for r in prefixes.prefix_auc(df.select("v", "y", trees.alias("trees"), *kept), [1.0, -0.5], "v", "y", n_bins=4, weight=weight).collect())
        for df, kept, weight in ((rows, [], None), (points, ["_n"], "_n"))
    ]
    assert found[1] == [pytest.approx(r) for r in found[0]]


@pytest.mark.parametrize("bins", [1, 7, 1 << 16])
def test_hash_cuts_are_ranks(spark, bins):
    from valuekit.operators import split

    picks = random.Random(bins)
    rows = [(picks.choice(["a", "b", None]), picks.choice([0.25, picks.random()])) for _ in range(200)] + [("tiny", 0.5)]
    df = spark.createDataFrame(rows, "s string, _hash double")
    bounds = {"x": 0.6, "y": 30, "z": 500, "none": 0.0}
    got = {r.s: r for r in split.hash_cuts(df, ["s"], bounds, bins).collect()}
    for s in ("a", "b", None, "tiny"):
        values = sorted(h for k, h in rows if k == s)
        for name, bound in bounds.items():
            size = min(len(values), int(bound * len(values)) if isinstance(bound, float) else bound)
            assert got[s][f"_cut_{name}"] == (values[size - 1] if size else None)
    parts = split.split_rows(df.withColumnRenamed("_hash", "h").withColumn("k", F.monotonically_increasing_id()), ["k"], {"p": 0.5, "q": 0.5}, strata=["s"])
    assert {(r.s, r.sample): r["count"] for r in parts.groupBy("s", "sample").count().collect()}["tiny", "q"] == 1 and parts.count() == 201


def test_mean_uplifts_are_the_means_of_the_arrays(spark):
    rows = [(i, i % 7 + 0.5, None if i % 5 == 0 else 0.01 * i, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, qty_amt double, disc_avg double, total_amt double")
    models = {(f"b{i}", f"s{j}"): training.Formula(("qty_amt", "disc_avg", "T", "cc"), lambda x, i=i, j=j: 0.1 * x["qty_amt"] + x["cc"] * (i + 0.013 * j * x["T"] + 0.0001 * x["disc_avg"])) for i in range(3) for j in range(3)}
    windows = {("b0", "s0"): scoring.Window(2, 3)}
    table, _ = scoring.uplift_all(df, "id", models, windows, treatment="cc")
    long = table.select("bp", "sp", F.posexplode("uplift").alias("T", "u")).where("NOT isnan(u)").groupBy("bp", "sp", "T").agg(F.count("u").alias("n"), F.round(F.avg("u"), 9).alias("uplift"))
    means, failed = scoring.mean_uplifts(df, models | {("b9", "s9"): training.Formula(("none",), lambda x: x["none"])}, windows, treatment="cc")
    got = means.select("bp", "sp", "T", "n", F.round("uplift", 9).alias("uplift"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in long.collect()} and set(failed) == {("b9", "s9")}


def test_woe_logistic_and_calibration_read_rows_once(spark, monkeypatch):
    df = spark.range(4000).select(
        F.when(F.col("id") % 5 < 3, "train").otherwise("valid").alias("sample"),
        (F.col("id") % 13).cast("double").alias("a"),
        (F.pmod(F.xxhash64("id"), F.lit(17)) < F.col("id") % 13).cast("int").alias("y"),
    )
    seen, fit = [], training.LogisticRegression.fit
    monkeypatch.setattr(training.LogisticRegression, "fit", lambda self, data: (seen.append(data.count()), fit(self, data))[1])
    training.fit_woe_logistic(df, ["a"], "y")
    # At most one point for each weight and label, not one for each row.
    assert seen[0] <= 22

    udf = F.udf

    calls = spark.sparkContext.accumulator(0)
    counted = udf(lambda v: (calls.add(1), v)[1], "double").asNondeterministic()
    frame = df.select("sample", F.col("y").cast("double").alias("y_true"), (F.col("a") / 20).alias("y_pred"), counted(F.col("a") / 30).alias("y_calib"))
    calibration.calibration_stats(frame, ["sample"]).collect()
    assert calls.value == 4000
    calls = spark.sparkContext.accumulator(0)
    counted = udf(lambda v: (calls.add(1), v)[1], "double").asNondeterministic()
    regression.regression_metrics(df.select("sample", F.col("a"), counted(F.col("a") / 30).alias("p")), ["sample"], "a", "p").collect()
    assert calls.value == 4000
