import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuekit.operators import binary, ranks


@pytest.fixture(scope="module")
def values(spark):
    """Three groups, one with two thirds of the rows, with a hot value and ties."""
    rng = random.Random(3)
    rows = [("big", 1.0 if rng.random() < 0.4 else round(rng.gauss(0, 5), 1), rng.randint(0, 1)) for _ in range(1200)]
    rows += [("mid", rng.random(), rng.randint(0, 1)) for _ in range(500)] + [("one", 3.0, 1), ("mid", None, 1)]
    return spark.createDataFrame(rows, "g string, v double, y int").persist(), rows


CUTS = [-5.0, 0.5, 1.0, 4.0]


@pytest.mark.parametrize("cuts", [[], CUTS, None])
def test_running_totals_against_brute_force(values, cuts):
    df, rows = values
    got = ranks.running_totals(df, ["g"], "v", {"n": F.count(F.lit(1)), "s": F.sum("y")}, totals=True, cuts=cuts).collect()
    for r in got:
        group = [(v, y) for g, v, y in rows if g == r["g"] and v is not None]
        assert r["n"] == sum(v == r["v"] for v, _ in group)
        assert r["n_below"] == sum(v < r["v"] for v, _ in group)
        assert r["s_below"] == sum(y for v, y in group if v < r["v"])
        assert r["n_all"] == len(group)
    assert len(got) == len({(g, v) for g, v, _ in rows if v is not None})


@pytest.mark.parametrize("cuts", [[], CUTS])
def test_linear_quantiles_equal_numpy(values, cuts):
    df, rows = values
    probs = [i / 19 for i in range(20)]
    for r in ranks.quantiles(df, ["g"], "v", probs, cuts=cuts).collect():
        expected = np.percentile([v for g, v, _ in rows if g == r["g"] and v is not None], [100 * p for p in probs])
        assert np.allclose(r["quantiles"], expected, atol=1e-12)


def test_small_quantiles(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10, 11, 12)], "v double")
    assert ranks.quantiles(df, [], "v", [0.3]).first()["quantiles"] == pytest.approx([2.8])
    assert ranks.quantiles(df, [], "v", [0.3], kind="lower").first()["quantiles"] == [2.0]


def test_cut_points_number_and_text(spark):
    df = spark.range(10_000).select((F.col("id") % 997).alias("v"), F.concat(F.lit("key-"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("t"))
    cuts = ranks.cut_points(df, "v", rows_per_range=1000)
    assert 5 <= len(cuts) <= 10 and cuts == sorted(cuts)
    texts = ranks.cut_points(df, "t", rows_per_range=1000)
    assert 5 <= len(texts) <= 40 and texts == sorted(texts)
    codes = ranks.running_totals(df.withColumn("g", F.lit(0)), ["g"], "t", {"n": F.count(F.lit(1))}, cuts=texts)
    assert codes.where(F.col("n_below") != F.substring("t", 5, 6).cast("int")).count() == 0


def test_dense_codes(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "b"), ("a", "x"), ("c", "z")], "f string, v string")
    got = {(r["f"], r["v"]): r["code"] for r in ranks.dense_codes(df, ["f"], "v").collect()}
    assert got == {("a", "b"): 0, ("a", "x"): 1, ("c", "z"): 0}


def test_bins(spark):
    df = spark.createDataFrame([(float(v), [1.0, 3.0, 5.0]) for v in (0, 1, 2, 3, 4, 5, 6)], "v double, e array<double>")

    def bins(**kw):
        return [r[0] for r in df.select(ranks.bin_of("v", "e", 3, **kw)).collect()]

    assert bins() == [None, None, 0, 0, 1, 1, None]
    assert bins(lowest=True) == [None, 0, 0, 0, 1, 1, None]
    assert bins(closed="left") == [None, 0, 0, 1, 1, 1, None]


@pytest.mark.parametrize("cuts", [[], CUTS])
def test_auc_with_ties_against_pairs(values, cuts):
    df, rows = values
    for r in binary.auc(df, ["g"], "v", "y", cuts=cuts).collect():
        pos = [v for g, v, y in rows if g == r["g"] and v is not None and y == 1]
        neg = [v for g, v, y in rows if g == r["g"] and v is not None and y == 0]
        if not pos or not neg:
            assert r["auc"] is None
            continue
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert math.isclose(r["auc"], wins / len(pos) / len(neg), rel_tol=1e-12)


def test_auc_small(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (0, 0.2), (1, 0.8)], "y int, p double")
    assert binary.auc(df, [], "p", "y").first()["auc"] == 3.5 / 4


def test_rank_cuts_give_exact_sizes(spark):
    df = spark.range(1000).select(F.lit(0).alias("g"), (F.col("id") * 7 % 1000).cast("double").alias("h"))
    row = ranks.rank_cuts(df, ["g"], "h", {"a": 0.25, "b": 10}).first()
    assert (row["a"], row["b"]) == (249.0, 9.0)


def test_pinned_falls_back_when_large(spark):
    assert ranks.pinned(spark.range(50), limit=10).count() == 50
    assert ranks.pinned(spark.range(5), limit=10).count() == 5


def test_a_frame_is_evaluated_once(spark):
    """Looking for cuts and ordering read what was collapsed, not the frame (a join or a score) again."""
    seen = spark.sparkContext.accumulator(0)

    def score(v):
        seen.add(1)
        return v % 7.0

    rows = spark.range(50).select((F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("double").alias("v"))
    scored = rows.withColumn("score", F.udf(score, "double").asNondeterministic()("v"))
    assert binary.gini(scored, [], "score", "y").first()["n_rows"] == 50
    assert seen.value == 50
