"""Registered queries: splitting and sampling, model fitting, importance, calibration, scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.functions.columns import hash_fraction
from valuekit.operators import binary, calibration, importance, scoring, split, training, validation
from valuekit.operators.isotonic import fit_isotonic
from valuekit.operators.regression import regression_metrics
from valuekit.plans import fixtures as fx
from valuekit.plans import formulas, model_twins
from valuekit.plans.fixtures import tidy, with_sql
from valuekit.roles import Roles
from valuekit.session import settle

SHARES = {"train": 0.6, "valid": 0.2, "test": 0.2}
KEY = list(fx.LINE_KEY)
MODEL_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "T"]
ORDER_FEATURES = ["total_amt", "qty_amt", "disc_avg", "T", "cc"]
VALUE_FEATURES = ["qty", "n_lines"]


def _labelled_lines(spark: SparkSession, sf: str) -> DataFrame:
    return fx.binary_sample(spark, sf).drop("sample")


def _signal(df: DataFrame) -> DataFrame:
    """A label that depends on the features: late return of bulky lines. The raw return flag of the
    test tables is noise, on which every fitted model would be flat."""
    noise = hash_fraction(*[F.col(k) for k in KEY], seed=11)
    return df.withColumn("y", (noise < 0.1 + 0.012 * F.col("l_quantity") - 2 * F.col("l_discount")).cast("int"))


def _order_signal(df: DataFrame) -> DataFrame:
    noise = hash_fraction(F.col("o_orderkey"), seed=12)
    return df.withColumn("y", (noise < 0.1 + 0.002 * F.col("qty_amt") + 0.15 * F.col("cc") - 0.01 * F.col("T") * F.col("cc")).cast("int"))


# -- sampling and splitting ----------------------------------------------------------------------


def split_strat(spark: SparkSession, sf: str) -> DataFrame:
    return split.split_rows(_labelled_lines(spark, sf), KEY, SHARES, strata=["y"], seed=5).groupBy("sample", "y").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").cast("bigint").alias("check_sum")
    )


def split_group(spark: SparkSession, sf: str) -> DataFrame:
    return split.split_groups(_labelled_lines(spark, sf), "l_orderkey", SHARES, seed=5).groupBy("sample").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("n_orders")
    )


def split_random(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.regression_sample(spark, sf).drop("sample")
    return split.split_rows(rows, ["o_orderkey"], SHARES, seed=7).groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("check_sum"))


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Part sizes given as row counts."""
    rows = fx.regression_sample(spark, sf).drop("sample")
    return split.split_target(rows, ["o_orderkey"], "y", {"train": 700, "valid": 300, "test": 0}, mode="random", seed=7).groupBy("sample").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("check_sum")
    )


def split_ordered(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.regression_sample(spark, sf).drop("sample")
    return split.split_ordered(rows, "o_orderkey", SHARES, nested=True).groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_key"))


def strat_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per stratum after reduction to 30,000 lines (where enough positives are left)."""
    kept = split.downsample(fx.binary_sample(spark, sf), KEY, "y", 30_000, seed=2)
    return kept.groupBy("sample", "T", "y").agg(F.count(F.lit(1)).alias("n"))


def psi_half(spark: SparkSession, sf: str) -> DataFrame:
    halves = split.psi_sample(fx.binary_sample(spark, sf), "OOT", KEY, seed=1)
    return halves.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("check_sum"))


def cap_sample(spark: SparkSession, sf: str) -> DataFrame:
    kept = split.cap_rows(fx.regression_sample(spark, sf), ["o_orderkey"], 5000, seed=4)
    return kept.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("check_sum"))


def hash_batches(spark: SparkSession, sf: str) -> DataFrame:
    batches = split.hash_batches(fx.mart(spark, sf), ["epk_id"], 7)
    return batches.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("epk_id").alias("n_clients"))


# -- models --------------------------------------------------------------------------------------


def _fit_line_model(df: DataFrame, features=MODEL_FEATURES, label: str = "y", sample: str = "sample", **params) -> training.Fitted:
    return training.fit_gbt(df, features, label, sample=sample, **({"maxIter": 8, "maxDepth": 3} | params))


def _short_line_model(df: DataFrame, features, label: str, sample: str) -> training.Fitted:
    """For the models on the best 1..k features."""
    return _fit_line_model(df, features, label, sample, maxIter=3)


def _model_rows(rows: DataFrame) -> DataFrame:
    """What the line models read, written once: every fit and score reads it again."""
    return settle(rows.select("sample", "y", *MODEL_FEATURES))


def _gini_table(scored: DataFrame, weight: str | None = None) -> DataFrame:
    return tidy(binary.gini(scored, ["sample"], "score", "y", weight))


def gbt_fit(spark: SparkSession, sf: str) -> DataFrame:
    rows = _model_rows(_signal(fx.binary_sample(spark, sf)))
    return _gini_table(_fit_line_model(rows).score(rows))


def rf_fit(spark: SparkSession, sf: str) -> DataFrame:
    rows = _model_rows(_signal(fx.gappy_sample(spark, sf)).na.fill({"y": 0}))
    return _gini_table(training.fit_forest(rows, MODEL_FEATURES, "y", numTrees=8, maxDepth=4).score(rows))


def gbt_regression(spark: SparkSession, sf: str) -> DataFrame:
    """Both losses; the target is the net line total, which the features explain."""
    rows = settle(fx.regression_sample(spark, sf).select("sample", F.col("y_pred").alias("y"), *VALUE_FEATURES))
    out = None
    for loss in ("squared", "absolute"):
        fitted = training.fit_gbt_regression(rows, VALUE_FEATURES, "y", loss=loss, maxIter=6, maxDepth=3)
        part = regression_metrics(fitted.score(rows), ["sample"], "y", "score").withColumn("loss", F.lit(loss))
        out = part if out is None else out.unionByName(part)
    return tidy(out, 4)


def gap_limited_trees(spark: SparkSession, sf: str) -> DataFrame:
    rows = _signal(fx.binary_sample(spark, sf))
    return tidy(training.tree_path_gini(formulas.LINE_TREES, rows, "y"))


def gap_limited_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = _signal(fx.binary_sample(spark, sf))
    return training.accepted_trees(training.tree_path_gini(formulas.LINE_TREES, rows, "y"))


def regression_path(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.regression_sample(spark, sf).withColumnRenamed("y", "total").withColumnRenamed("y_pred", "y")
    return tidy(training.regression_path(formulas.VALUE_TREES, rows, "y"), 4)


def woe_logistic(spark: SparkSession, sf: str) -> DataFrame:
    rows = _model_rows(_signal(fx.gappy_sample(spark, sf)).na.fill({"y": 0}))
    return _gini_table(training.fit_woe_logistic(rows, MODEL_FEATURES, "y").score(rows))


def random_search(spark: SparkSession, sf: str) -> DataFrame:
    rows = _model_rows(_signal(fx.binary_sample(spark, sf)))
    trials, best = training.random_search(_fit_line_model, rows, MODEL_FEATURES, "y", {"maxIter": (3, 6), "stepSize": (0.05, 0.3)}, n_iter=2)
    table = _gini_table(best.score(training.points(rows, rows.columns)), "_n")
    return table.withColumn("best_trial_gini", F.lit(round(max(t["gini_valid"] for t in trials), 6)))


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Several fitted models over one frame, one row per model and sample."""
    rows = _model_rows(_signal(fx.binary_sample(spark, sf)))
    models = {
        "boosted": _fit_line_model(rows, maxIter=4),
        "forest": training.fit_forest(rows, MODEL_FEATURES, "y", numTrees=6, maxDepth=4),
        "woe": training.fit_woe_logistic(rows, MODEL_FEATURES, "y"),
    }
    long = training.multi_model_scores(rows, models, ["sample", "y"])
    return tidy(binary.binary_metrics(long, ["model", "sample"], "score", "y"))


# -- importance ----------------------------------------------------------------------------------


def tree_correlation(spark: SparkSession, sf: str) -> DataFrame:
    rows = _signal(fx.binary_sample(spark, sf))
    return tidy(importance.tree_correlation(rows, fx.NUMERIC, "y"))


def tree_correlation_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Every sample against the training sample."""
    found = importance.tree_correlation(_signal(fx.binary_sample(spark, sf)), fx.NUMERIC, "y")
    return tidy(importance.correlation_delta(found, ["train", "valid", "test", "OOT"]))


def _line_importance(spark: SparkSession, sf: str) -> DataFrame:
    rows = _signal(fx.binary_sample(spark, sf)).drop("score")
    tested = rows.where(F.col("sample").isin("test", "OOT"))
    return importance.permutation_importance(tested, formulas.LINE, "y", KEY)


def permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_line_importance(spark, sf))


def regressor_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Relative increase of the mean absolute error."""
    rows = fx.regression_sample(spark, sf).withColumnRenamed("y", "total").withColumnRenamed("y_pred", "y")
    return tidy(importance.permutation_importance(rows, formulas.VALUE, "y", ["o_orderkey"], metric="mae", relative=True))


def factor_relevancy(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(importance.factor_relevancy(_line_importance(spark, sf)))


def top_features(spark: SparkSession, sf: str) -> DataFrame:
    """The two features with the highest Gini, a report of k rows."""
    rows = _signal(fx.binary_sample(spark, sf)).where(F.col("sample") == "train")
    scores = binary.feature_gini(rows, fx.NUMERIC, "y")
    return tidy(importance.select_features(scores, top_k=2, value="gini"))


def feature_curve(spark: SparkSession, sf: str) -> DataFrame:
    rows = _signal(fx.binary_sample(spark, sf))
    return tidy(importance.feature_curve(rows, _short_line_model, fx.NUMERIC, "y"))


# -- calibration ---------------------------------------------------------------------------------


def _calibrated(spark: SparkSession, sf: str, method: str) -> DataFrame:
    rows = _signal(fx.binary_sample(spark, sf))
    fitted = calibration.fit_calibration(rows.where(F.col("sample") == "train"), "score", "y", method, features=MODEL_FEATURES)
    done = fitted.apply(rows, "score")
    return done.select("sample", F.col("y").alias("y_true"), F.col("score").alias("y_pred"), "y_calib", F.lit(method).alias("method"))


def _calibration_table(spark: SparkSession, sf: str, methods: tuple[str, ...]) -> DataFrame:
    frame = None
    for method in methods:
        part = _calibrated(spark, sf, method)
        frame = part if frame is None else frame.unionByName(part)
    stats = calibration.calibration_stats(frame, ["method", "sample"])
    return tidy(calibration.calibration_comparison(stats, ["train", "valid", "test", "OOT"]))


def isotonic(spark: SparkSession, sf: str) -> DataFrame:
    return _calibration_table(spark, sf, ("isotonic",))


def isotonic_points(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted function at every score, from ranges of 64 scores merged in a tree and applied by ranges."""
    rows = _signal(fx.binary_sample(spark, sf))
    fitted = fit_isotonic(rows.where(F.col("sample") == "train"), "score", "y", rows_per_range=64, shipped_ends=16)
    return fitted.apply(rows.groupBy("score").agg(F.count(F.lit(1)).alias("n")), "score", "v").select("score", "n", F.round("v", 9).alias("v"))


def logistic(spark: SparkSession, sf: str) -> DataFrame:
    return _calibration_table(spark, sf, ("logistic", "logistic-odds", "logistic-ln-odds"))


def tree_calibration(spark: SparkSession, sf: str) -> DataFrame:
    return _calibration_table(spark, sf, ("dtree",))


# -- scoring -------------------------------------------------------------------------------------


def _order_model(rows: DataFrame) -> training.Fitted:
    return training.fit_gbt(rows, ORDER_FEATURES, "y", maxIter=6, maxDepth=4)


def uplift_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Mean uplift per period over all orders, from the 13-element arrays."""
    rows = fx.treatment_sample(spark, sf)
    scored = scoring.uplift_curve(rows, formulas.response(), "cc", "pl", scoring.Window(0, 9), treatment="cc")
    long = scoring.uplift_long(scored, "o_orderkey", "cc_pl")
    return tidy(long.groupBy("pair", "T").agg(F.count(F.lit(1)).alias("n"), F.avg("uplift").alias("uplift")))


def uplift_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """One array per order; T = 0 is NaN for a product's own pair."""
    rows = _order_signal(fx.treatment_sample(spark, sf))
    scored = scoring.uplift_curve(rows, _order_model(rows), "cc", "cc", scoring.Window(0, 5), treatment="cc")
    return scored.select("o_orderkey", "cc_cc")


def npv_score(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.regression_sample(spark, sf).withColumnRenamed("y", "total").withColumnRenamed("y_pred", "y")
    return scoring.npv_score(rows, formulas.VALUE, "npv_cc").select("o_orderkey", "npv_cc")


def segment_score(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with at most three lines and the others, each with their own value model."""
    rows = fx.regression_sample(spark, sf).withColumnRenamed("y", "total").withColumnRenamed("y_pred", "y")
    big = F.col("n_lines") > 3
    first, second = formulas.SMALL_VALUE, formulas.VALUE
    scored = scoring.by_segment(rows, big, lambda d: scoring.npv_score(d, second, "npv_dc"), lambda d: scoring.npv_score(d, first, "npv_dc"))
    return scored.select("o_orderkey", "npv_dc")


def pending_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of the matrix without a period window that is already long enough."""
    from valuekit.operators.targets import pair_list

    done = fx.pair_periods(spark, sf).where("T_max - T_min >= 8")
    return scoring.pending_pairs(pair_list(fx.pair_matrix(spark, sf)).select("bp", "sp"), done)


def external_model(spark: SparkSession, sf: str) -> DataFrame:
    """The extension point for models outside Spark: a vectorised function over Arrow batches."""
    rows = fx.binary_sample(spark, sf)
    scored = scoring.score_with(rows, lambda x: 1 / (1 + x["l_quantity"]) + x["l_discount"], ["l_quantity", "l_discount"], [*KEY, "sample", "y"])
    return tidy(scored.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"), F.max("score").alias("max_score")))


def validation_suite(spark: SparkSession, sf: str) -> DataFrame:
    """Every value of every table of both suites, in long form: binary with gaps, regression.

    Both score again with a fixed model, and the binary one is refitted for the curve of its best features. The points of
    the error curve come as errors and shares, which rise together.
    """
    lines = _signal(fx.gappy_sample(spark, sf)).na.fill({"y": 0})
    roles = Roles(id=fx.LINE_KEY, target="y", numeric=fx.NUMERIC, categorical=("p_brand",))
    tables = {f"binary_{k}": v for k, v in validation.validation_suite(lines, roles, "binary", fitted=formulas.LINE, refit=_short_line_model).items()}
    orders = fx.regression_sample(spark, sf)
    order_roles = Roles(id=("o_orderkey",), target="y", numeric=tuple(VALUE_FEATURES))
    tables |= {f"regression_{k}": v for k, v in validation.validation_suite(orders, order_roles, "regression", score="y_pred", fitted=formulas.VALUE).items()}
    return tidy(validation.suite_values(tables), 4)


QUERIES = {
    "split_strat": split_strat,
    "split_group": split_group,
    "split_random": split_random,
    "split_counts": split_counts,
    "split_ordered": split_ordered,
    "strat_sample": strat_sample,
    "psi_half": psi_half,
    "cap_sample": cap_sample,
    "hash_batches": hash_batches,
    "gbt_fit": gbt_fit,
    "rf_fit": rf_fit,
    "gbt_regression": gbt_regression,
    "gap_limited_trees": gap_limited_trees,
    "gap_limited_count": gap_limited_count,
    "regression_path": regression_path,
    "woe_logistic": woe_logistic,
    "random_search": random_search,
    "model_comparison": model_comparison,
    "tree_correlation": tree_correlation,
    "tree_correlation_delta": tree_correlation_delta,
    "permutation_importance": permutation_importance,
    "regressor_importance": regressor_importance,
    "factor_relevancy": factor_relevancy,
    "top_features": top_features,
    "feature_curve": feature_curve,
    "isotonic": isotonic,
    "isotonic_points": isotonic_points,
    "logistic": logistic,
    "tree_calibration": tree_calibration,
    "uplift_curve": uplift_curve,
    "uplift_arrays": uplift_arrays,
    "npv_score": npv_score,
    "segment_score": segment_score,
    "pending_pairs": pending_pairs,
    "external_model": external_model,
    "validation_suite": validation_suite,
}

# ---------------------------------------------------------------------------------------------
# SQL twins of the sampling operators: the same hash, exact sizes by row number.


def _hash_sql(*keys: str, seed: int) -> str:
    text = " || '|' || ".join([*keys, f"'{seed}'"])
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT / 4503599627370496::DOUBLE"


def _label_sql(rank: str, total: str) -> str:
    return f"CASE WHEN {rank} <= floor(0.6::DOUBLE * {total}) THEN 'train' WHEN {rank} <= floor(0.8::DOUBLE * {total}) THEN 'valid' ELSE 'test' END"


_LINE_HASH = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")

ORACLE = {
    "split_strat": f"""{with_sql('binary')}, r AS (SELECT y, l_linenumber, row_number() OVER (PARTITION BY y ORDER BY {_hash_sql(*_LINE_HASH, seed=5)}) AS i,
        count(*) OVER (PARTITION BY y) AS n FROM bin_sample)
        SELECT {_label_sql('i', 'n')} AS sample, y, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS check_sum FROM r GROUP BY r.y, 1""",
    "split_group": f"""{with_sql('binary')}, g AS (SELECT l_orderkey, row_number() OVER (ORDER BY {_hash_sql('l_orderkey', seed=5)}) AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT l_orderkey FROM bin_sample))
        SELECT {_label_sql('g.i', 'g.n')} AS sample, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders FROM bin_sample JOIN g USING (l_orderkey) GROUP BY 1""",
    "split_random": f"""{with_sql('regression')}, r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_hash_sql('o_orderkey', seed=7)}) AS i, count(*) OVER () AS n FROM reg_sample)
        SELECT {_label_sql('i', 'n')} AS sample, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS check_sum FROM r GROUP BY 1""",
    "split_counts": f"""{with_sql('regression')}, r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_hash_sql('o_orderkey', seed=7)}) AS i FROM reg_sample)
        SELECT CASE WHEN i <= 700 THEN 'train' WHEN i <= 1000 THEN 'valid' ELSE 'test' END AS sample, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS check_sum FROM r GROUP BY 1""",
    "split_ordered": f"""{with_sql('regression')}, r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i, count(*) OVER () AS n FROM reg_sample)
        SELECT CASE WHEN i <= floor(0.6::DOUBLE * n) THEN 'train' WHEN i <= floor(0.68::DOUBLE * n) THEN 'valid' ELSE 'test' END AS sample, count(*) AS n, max(o_orderkey) AS last_key FROM r GROUP BY 1""",
    "strat_sample": f"""{with_sql('binary')}, h AS (SELECT *, {_hash_sql(*_LINE_HASH, seed=2)} AS h, 30000::DOUBLE / (SELECT count(*) FROM bin_sample) AS ratio FROM bin_sample),
        k AS (SELECT count(*) FILTER (h < ratio AND y > 0) AS kept FROM h)
        SELECT sample, T, y, count(*) AS n FROM h, k WHERE NOT (kept * 0.6 >= 1000 AND kept * 0.2 >= 100) OR h < ratio GROUP BY ALL""",
    "psi_half": f"""{with_sql('binary')} SELECT CASE WHEN sample = 'OOT' AND {_hash_sql(*_LINE_HASH, seed=1)} >= 0.5 THEN 'OOT_psi' ELSE sample END AS sample,
        count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS check_sum FROM bin_sample GROUP BY 1""",
    "cap_sample": f"""{with_sql('regression')} SELECT sample, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS check_sum
        FROM (SELECT * FROM reg_sample ORDER BY {_hash_sql('o_orderkey', seed=4)} LIMIT 5000) GROUP BY 1""",
    "hash_batches": f"""{with_sql('mart')} SELECT CAST(floor({_hash_sql('epk_id', seed=0)} * 7) AS INT) AS batch, count(*) AS n, count(DISTINCT epk_id) AS n_clients FROM mart GROUP BY 1""",
    "pending_pairs": f"""{with_sql('matrix')}, done AS (SELECT lower(c_mktsegment) AS bp, event_type AS sp FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2
          HAVING 6 + count(*) % 7 - count(*) % 3 >= 8)
        SELECT BP AS bp, sp FROM (UNPIVOT matrix ON click, error, purchase, signup, "view" INTO NAME sp VALUE cell) m
        WHERE cell > 0 AND priority > 0 AND NOT EXISTS (SELECT 1 FROM done d WHERE d.bp = m.BP AND d.sp = m.sp)""",
    "external_model": f"""{with_sql('binary')} SELECT sample, count(*) AS n, round(avg(1 / (1 + l_quantity) + l_discount), 6) AS mean_score,
        round(max(1 / (1 + l_quantity) + l_discount), 6) AS max_score FROM bin_sample GROUP BY 1""",
}


def _signal_gini_sql() -> str:
    from valuekit.plans.metric_queries import _auc_sql, _long_sql

    return f"""{with_sql('binary')}, s AS (SELECT * REPLACE (CAST({_hash_sql(*_LINE_HASH, seed=11)} < 0.1::DOUBLE + 0.012::DOUBLE * l_quantity - 2 * l_discount AS INT) AS y) FROM bin_sample),
    l AS ({_long_sql("s", fx.NUMERIC, "y, sample")}), t AS (SELECT * FROM l WHERE sample = 'train'), a AS ({_auc_sql("t", "feature", "value")})
    SELECT feature, round(200 * abs(auc - 0.5), 6) AS gini FROM a ORDER BY gini DESC LIMIT 2"""


ORACLE["top_features"] = _signal_gini_sql()
ORACLE |= model_twins.ORACLE
