import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from valuekit.functions import columns as fn
from valuekit.operators import binary, clean, encode, mart, regression, scoring, split, stability, targets
from valuekit.operators.training import fit_gbt
from valuekit.roles import AbsentColumns, align_columns, drop_matching, promote_new, require_columns


def test_month_list_snaps_to_month_end():
    assert fn.month_list(date(2001, 2, 28), 2) == [date(2001, 2, 28), date(2001, 1, 31)]
    assert fn.month_list(date(2001, 2, 28), 2, snap=False) == [date(2001, 2, 28), date(2001, 1, 28)]
    assert fn.month_list(date(2001, 1, 31), 3)[-1] == date(2000, 11, 30)


def test_period_map():
    assert fn.months_of(range(9)) == {0: 0, 1: 1, 2: 1, 3: 2, 4: 2, 5: 2, 6: 3, 7: 3, 8: 3}
    assert fn.months_of([35])[35] == 12


def test_hash_fraction_is_stable_and_seeded(spark):
    df = spark.range(1000)
    a = df.select(fn.hash_fraction(F.col("id"), seed=1).alias("h"))
    assert a.collect() == df.repartition(7).sort("id").select(fn.hash_fraction(F.col("id"), seed=1).alias("h")).collect()
    low, high, mean = a.agg(F.min("h"), F.max("h"), F.avg("h")).first()
    assert 0 <= low < high < 1 and abs(mean - 0.5) < 0.05


def test_student_quantile(spark):
    got = spark.range(1).select(fn.student_quantile(0.975, F.lit(30)), fn.student_quantile(0.975, F.lit(1000))).first()
    assert got[0] == pytest.approx(2.042272, abs=1e-6) and got[1] == pytest.approx(1.962339, abs=1e-6)
    table = {1: 12.706205, 2: 4.302653, 3: 3.182446, 5: 2.570582, 10: 2.228139, 29: 2.045230, 120: 1.979930}
    few = spark.createDataFrame([(n,) for n in (0, *table)], "n long").select("n", fn.student_quantile(0.975, F.col("n")).alias("t"))
    found = {r["n"]: r["t"] for r in few.collect()}
    assert found.pop(0) is None and found == pytest.approx(table, abs=1e-6)
    edge = spark.range(1).select(fn.student_quantile(0.975, F.lit(200)), fn.student_quantile(0.975, F.lit(201))).first()
    assert edge[0] - edge[1] == pytest.approx(5.97e-5, abs=2e-7)


def test_log_target_inverts(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (8.5,)], "y double")
    back = df.select("y", fn.unlog_target(fn.log_target(F.col("y"), -3.0, 0.2), -3.0, 0.2).alias("b")).collect()
    assert all(math.isclose(r["y"], r["b"], abs_tol=1e-12) for r in back)


def test_roles(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, a_new int, sale_month int")
    assert drop_matching(["gld_t1", "mapp_t1", "x"], ["gld", "pp"], ["mapp"]) == ["gld_t1"]
    assert promote_new(df).first().asDict() == {"sale_month": 3, "a": 2}
    with pytest.raises(AbsentColumns):
        require_columns(df, ["zz"])
    assert align_columns(df, df.select("sale_month")).columns == ["sale_month"]


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, 1, None, 1.0, 2), (1, 1, None, float("nan"), 3), (1, None, None, 1.0, 4)], "a int, b int, c int, d double, e int")
    got = {r["column"]: (r["is_constant"], round(r["null_share"], 3)) for r in clean.column_levels(df, df.columns).collect()}
    assert got == {"a": (True, 0), "b": (False, 0.333), "c": (True, 1.0), "d": (False, 0.333), "e": (False, 0)}
    assert clean.drop_constant(df).columns == ["b", "d", "e"]
    assert clean.drop_sparse(df).columns == ["a", "b", "d", "e"]


def test_number_like_text_is_all_or_nothing(spark):
    df = spark.createDataFrame([("1", "1", None), ("2.5", "x", None)], "a string, b string, c string")
    assert dict(clean.cast_numbers(df, ["a", "b"]).dtypes) == {"a": "double", "b": "string", "c": "string"}


def test_compact_types(spark):
    df = spark.createDataFrame([(1.0, -300.0, 0.5, 70000), (200.0, 5.0, 1.0, 5)], "a double, b double, c double, d bigint")
    assert dict(clean.compact_types(df, df.columns).dtypes) == {"a": "smallint", "b": "smallint", "c": "float", "d": "bigint"}
    kinds = {r["column"]: r["type"] for r in clean.type_profile(df, df.columns).collect()}
    assert kinds == {"a": "uint8", "b": "int16", "c": "float32", "d": "uint32"}
    assert dict(clean.narrow_types(df).dtypes) == {"a": "float", "b": "float", "c": "float", "d": "int"}


def test_export_clean(spark):
    df = spark.createDataFrame([(1.0, 1.5, "null"), (None, 2.0, "x")], "a double, b double, t string")
    out = clean.export_clean(df, ["a", "b"], ["t"])
    assert [tuple(r) for r in out.collect()] == [(1, 1.5, None), (None, 2.0, "x")]
    assert dict(out.dtypes)["a"] == "bigint"


def test_outlier_trim_is_strict(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 102)], "y double")
    assert clean.trim_outliers(df, "y").agg(F.min("y"), F.max("y"), F.count("y")).first() == (3.0, 99.0, 97)


def test_psi_of_a_sample_with_itself_is_zero(spark):
    df = spark.createDataFrame([(s, float(v), str(v % 3)) for s in ("train", "OOT") for v in range(200)], "sample string, x double, c string")
    assert stability.numeric_psi(df, ["x"]).first()["psi"] == pytest.approx(0, abs=1e-12)
    assert stability.categorical_psi(df, ["c"]).first()["psi"] == pytest.approx(0, abs=1e-12)


def test_psi_new_category_uses_the_floor(spark):
    rows = [("train", "a"), ("train", "b"), ("OOT", "a"), ("OOT", "c")]
    df = spark.createDataFrame(rows, "sample string, c string")
    expected = 2 * (0.5 - 0.005) * math.log(0.5 / 0.005)
    assert stability.categorical_psi(df, ["c"]).first()["psi"] == pytest.approx(expected)


def test_gini_is_symmetric(spark):
    df = spark.createDataFrame([(i % 2, float(i * 37 % 11)) for i in range(50)], "y int, x double").withColumn("neg", -F.col("x"))
    got = {r["feature"]: r["gini"] for r in binary.feature_gini(df, ["x", "neg"], "y").collect()}
    assert got["x"] == pytest.approx(got["neg"])


def test_metric_selector():
    with pytest.raises(ValueError):
        regression.select_metric("maee")


def test_rec_area_against_trapezoid(spark):
    rows = [(1.0, 2.0), (4.0, 4.5), (9.0, 3.0), (2.0, 2.0), (7.0, 8.0)]
    errors = sorted(abs(y - p) for y, p in rows)
    heights = [(i + 1) / len(errors) for i in range(len(errors))]
    under = sum((errors[i] - errors[i - 1]) * (heights[i] + heights[i - 1]) / 2 for i in range(1, len(errors)))
    got = regression.rec_area(spark.createDataFrame(rows, "y double, p double"), [], "y", "p").first()
    assert got["aoc_model"] == pytest.approx(max(errors) - under)


def test_status_rules(spark):
    df = spark.createDataFrame([(0.1,), (0.25,), (0.35,)], "v double")
    assert [r[0] for r in df.select(fn.status_two_sided(F.col("v"), 0.2, 0.3)).collect()] == ["green", "yellow", "red"]
    assert [r[0] for r in df.select(fn.status_boundary(F.col("v"), 0.3, "reverse")).collect()] == [None, None, "red"]
    with pytest.raises(ValueError):
        fn.status_boundary(F.col("v"), 0.3, "up")


def test_period_collapse(spark):
    df = spark.createDataFrame([(1, 1, None, 1, 0, 0, 0), (2, 0, 0, 0, 1, 0, 0)], "id int, a_t0 int, a_t1 int, a_t2 int, a_t3 int, a_t4 int, a_t5 int")
    got = [tuple(r) for r in targets.collapse_periods(df, ["id"]).orderBy("id").collect()]
    assert got == [(1, 1, None, 0), (2, 0, 0, 1)]
    long = targets.long_targets([df], ["id"])
    assert {(r["id"], r["Product"], r["T"], r["TRG"]) for r in long.collect()} == {(1, "a", 0, 1), (1, "a", 2, 0), (2, "a", 0, 0), (2, "a", 1, 0), (2, "a", 2, 1)}


def test_pair_list_order(spark):
    df = spark.createDataFrame([("pl", "2", "1", "0"), ("cc", "1", "1", "1"), ("dc", "0", "1", "1")], "BP string, priority string, aa string, bb string")
    got = [(r["bp"], r["sp"], r["place"], r["done_percent"]) for r in targets.pair_list(df).orderBy("place").collect()]
    assert got == [("cc", "aa", 1, 33.33), ("cc", "bb", 2, 66.67), ("pl", "aa", 3, 100.0)]


def test_encoder(spark):
    train = spark.createDataFrame([("b", "x"), ("a", None), ("a", "x")], "c string, d string")
    codes = encode.fit_dictionary(train, ["c", "d"])
    assert {(r["feature"], r["value"], r["code"]) for r in codes.collect()} == {("c", "a", 0), ("c", "b", 1), ("d", "NA", 0), ("d", "x", 1)}
    fresh = spark.createDataFrame([("b", "x"), (None, None), ("zz", "zz")], "c string, d string")
    expected = [(1, 1), (0, 0), (0, 0)]
    assert [tuple(r) for r in encode.encode(fresh, codes, ["c", "d"]).collect()] == expected


def test_encoder_joins(spark):
    train = spark.createDataFrame([("b",), ("a",), ("NA",)], "c string")
    codes = encode.fit_dictionary(train, ["c"])
    fresh = spark.createDataFrame([(1, "b"), (2, None), (3, "zz"), (4, "a")], "id int, c string")
    assert sorted(map(tuple, encode.encode(fresh, codes, ["c"]).collect())) == [(1, 2), (2, 0), (3, 0), (4, 1)]


def test_dictionary_extension_and_tokens(spark):
    df = spark.createDataFrame([("b", "q"), ("a", "r")], "c string, d string")
    codes = encode.add_features(encode.fit_dictionary(df, ["c"]), df, ["c", "d"])
    assert codes.count() == 4
    assert {tuple(r) for r in encode.tokens(df, "c", ["b"]).collect()} == {("b", 0), ("a", -1)}


def test_splits_are_partitions_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 5 == 0).cast("int").alias("y"), (F.col("id") % 90).alias("grp"))
    shares = {"train": 0.6, "valid": 0.2, "test": 0.2}
    once = split.split_target(df, ["id"], "y", shares, mode="stratified", seed=3)
    counts = {(r["sample"], r["y"]): r["count"] for r in once.groupBy("sample", "y").count().collect()}
    assert counts == {("train", 0): 480, ("valid", 0): 160, ("test", 0): 160, ("train", 1): 120, ("valid", 1): 40, ("test", 1): 40}
    again = split.split_target(df.repartition(5), ["id"], "y", shares, mode="stratified", seed=3)
    assert sorted(once.collect()) == sorted(again.collect())
    grouped = split.split_target(df, ["id"], "y", shares, mode="group", group="grp")
    assert grouped.count() == 1000 and grouped.groupBy("grp").agg(F.count_distinct("sample").alias("n")).agg(F.max("n")).first()[0] == 1
    with pytest.raises(ValueError):
        split.split_target(df, ["id"], "y", shares, mode="other")


def test_cap_and_psi_half(spark):
    df = spark.range(500).select("id", F.lit("OOT").alias("sample"))
    assert split.cap_rows(df, ["id"], 120).count() == 120
    assert split.cap_rows(df, ["id"], 9999).count() == 500
    halves = {r["sample"]: r["count"] for r in split.psi_sample(df).groupBy("sample").count().collect()}
    assert sum(halves.values()) == 500 and 200 < halves["OOT"] < 300
    with pytest.raises(ValueError):
        split.psi_sample(df, "train")


def test_slice_resume_equals_one_shot(spark):
    df = spark.range(100).withColumnRenamed("id", "epk_id")
    done = df.where("epk_id < 40")
    assert encode.pending_rows(df, done, "epk_id").count() == 60
    assert encode.pending_rows(df, done, "epk_id").unionByName(done).distinct().count() == 100


def test_freshness(spark):
    df = spark.createDataFrame([(date(2001, 7, 31),), (date(2001, 6, 30),)], "month date")
    assert mart.freshness(df, date(2001, 8, 5)).first()["is_fresh"] is True
    assert mart.freshness(df, date(2001, 9, 5)).first()["is_fresh"] is False
    assert mart.first_period("dc1", "dc") == 1 and mart.first_period("pl", "pl") == 1 and mart.first_period("pl", "cc") == 0


def test_uplift_window(spark):
    rows = [(i, i % 2, i % 5, float(i % 7), int(i % 3 == 0), "valid" if i % 4 == 0 else "train") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, cc int, T int, x double, y int, sample string")
    fitted = fit_gbt(df, ["x", "T", "cc"], "y", maxIter=2, maxDepth=2)
    other = scoring.uplift_curve(df, fitted, "cc", "pl", scoring.Window(2, 4), treatment="cc")
    values = other.first()["cc_pl"]
    assert len(values) == 13 and [i for i, v in enumerate(values) if not math.isnan(v)] == [2, 3, 4]
    assert scoring.Window(0, 2).periods("cc", "cc") == [1, 2]
    assert scoring.Window(0, 2).periods("kp", "pl") == [1, 2]
    assert scoring.uplift_long(other, "id", "cc_pl").count() == 3 * 400
    # The curve equals scoring both arms by hand.
    for t in (2, 4):
        arms = [fitted.score(df.withColumns({"T": F.lit(t), "cc": F.lit(a)})).select("id", F.round("score", 5).alias(f"p{a}")) for a in (0, 1)]
        by_hand = {r["id"]: r["u"] for r in arms[0].join(arms[1], "id").select("id", (F.col("p1") - F.col("p0")).alias("u")).collect()}
        assert all(math.isclose(r["cc_pl"][t], by_hand[r["id"]], abs_tol=1e-12) for r in other.select("id", "cc_pl").collect())


def test_score_pairs_reports_and_skips(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    written = {}

    def scorer(frame, base, sold):
        if sold == "bad":
            raise RuntimeError("no model")
        return frame.withColumn(f"{base}_{sold}", F.lit(1.0))

    def write(table, name):
        written[name] = table.count()

    got = scoring.score_pairs(df, "k", [("a", "b"), ("a", "bad"), ("c", "d")], scorer, write, exists=lambda n: n == "uplifts_c_d_2021", date="2021")
    assert [r["status"] for r in got] == ["scored", "failed", "skipped"] and written == {"uplifts_a_b_2021": 3}


def test_segments_see_only_their_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 5), (3, None)], "id int, qty int")
    got = scoring.by_segment(df, F.col("qty") > 0, lambda d: d.withColumn("m", F.lit("B")), lambda d: d.withColumn("m", F.lit("A")))
    assert {(r["id"], r["m"]) for r in got.collect()} == {(1, "A"), (2, "B"), (3, "A")}
