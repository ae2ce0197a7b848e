"""Registered queries: binning, stability, Gini, binary and regression metrics, calibration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuekit.functions.columns import hash_fraction, status_boundary, status_one_sided, status_two_sided
from valuekit.operators import binary, calibration, gates, ranks, regression, stability
from valuekit.plans import fixtures as fx
from valuekit.plans.fixtures import rounded_sql, tidy, with_sql

SAMPLE_NAMES = ("train", "valid", "test", "OOT")
AGAINST = ("test", "OOT")


def quantile_bins(spark: SparkSession, sf: str) -> DataFrame:
    rows = ranks_input(spark, sf)
    return tidy(binary.score_bins(rows, ["sample"], "l_extendedprice").groupBy("sample", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")
    ))


def ranks_input(spark: SparkSession, sf: str) -> DataFrame:
    return fx.binary_sample(spark, sf).select("sample", "l_extendedprice", "y", "score")


def lower_deciles(spark: SparkSession, sf: str) -> DataFrame:
    edges = ranks.quantiles(ranks_input(spark, sf), ["sample"], "l_extendedprice", [i / 10 for i in range(11)], kind="lower", name="edges")
    return tidy(edges.select("sample", "n_rows", F.posexplode("edges").alias("decile", "edge")))


def psi_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(stability.psi_selection(stability.numeric_psi(fx.gappy_sample(spark, sf), fx.NUMERIC), 0.002))


def psi_equal_width(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(stability.numeric_psi(fx.gappy_sample(spark, sf), fx.NUMERIC, bin_type="bins"))


def psi_categorical(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(stability.categorical_psi(fx.gappy_sample(spark, sf), ["p_brand", "l_returnflag"]))


def psi_categorical_documents(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(stability.categorical_psi(fx.document_parts(spark, sf), ["lang", "source"]))


def psi_array(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(stability.array_psi(fx.binary_sample(spark, sf), ["l_quantity", "l_extendedprice", "score"], actual="test", bin_type="quantiles"))


def _detailed(spark: SparkSession, sf: str) -> DataFrame:
    return stability.detailed_psi(fx.gappy_sample(spark, sf), [*fx.NUMERIC, "score"], ["p_brand"], label="y", against=AGAINST)


def psi_detailed(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_detailed(spark, sf))


def psi_short(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(stability.short_psi(_detailed(spark, sf), AGAINST))


def gini_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.gappy_sample(spark, sf).where(F.col("sample") == "train")
    return tidy(binary.gini_selection(binary.feature_gini(rows, fx.NUMERIC, "y"), 0.8, ["p_brand"]))


def gini_documents(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(binary.feature_gini(fx.document_sample(spark, sf), ["n_chars"], "toxic", ["quality"]))


def gini_flagged(spark: SparkSession, sf: str) -> DataFrame:
    """Gini with the model flag and a description; the handbook is built from the part types."""
    rows = fx.gappy_sample(spark, sf).where(F.col("sample") == "train")
    handbook = fx.table(spark, sf, "part").agg(F.concat(F.lit("parts of "), F.count_distinct("p_type").cast("string"), F.lit(" types")).alias("description")).select(
        F.explode(F.array(F.lit("p_size"), F.lit("p_retailprice"))).alias("variable"), "description"
    )
    return tidy(binary.gini_with_flags(binary.feature_gini(rows, fx.NUMERIC, "y"), ["l_quantity", "l_discount"], handbook))


def gini_stability(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(binary.gini_stability(fx.gappy_sample(spark, sf), fx.NUMERIC, "score", "y", SAMPLE_NAMES))


def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(binary.binary_metrics(fx.binary_sample(spark, sf), ["sample"], "score", "y"))


def binary_report(spark: SparkSession, sf: str) -> DataFrame:
    metrics = binary.binary_metrics(fx.model_predictions(spark, sf), ["model", "sample"], "score", "y")
    return tidy(binary.wide_by_sample(metrics, ["model"], ["gini", "pr_auc", "log_loss"], SAMPLE_NAMES))


def binary_bins(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(binary.binary_bins(fx.binary_sample(spark, sf), ["sample"], "score", "y"))


def auc_interval(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(binary.auc_interval(fx.binary_sample(spark, sf), ["sample"], "score", "y"))


def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(binary.roc_curve(fx.binary_sample(spark, sf), ["sample"], "score", "y"))


def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(binary.precision_recall_curve(fx.binary_sample(spark, sf), ["sample"], "score", "y"))


def bin_means(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(binary.bin_means(fx.regression_sample(spark, sf), ["sample"], "y_pred", "y"))


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.binary_sample(spark, sf).select("y", (F.col("score") > 0.5).cast("int").alias("flagged"))
    return tidy(binary.confusion(rows, "y", "flagged", log=True))


def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(regression.regression_metrics(fx.regression_sample(spark, sf), ["sample"], "y", "y_pred"))


def regression_eval_metrics(spark: SparkSession, sf: str) -> DataFrame:
    y, p = F.col("y"), F.col("y_pred")
    picked = {n: regression.select_metric(n)(y, p).alias(n) for n in ("mae", "mse", "rmse", "rmsle", "r2")}
    more = [regression.mape_signed(y, p).alias("mape_signed"), regression.mape_plain(y, p).alias("mape_plain")]
    return tidy(fx.regression_sample(spark, sf).groupBy("sample").agg(*picked.values(), *more), 1)


def regression_bins(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(regression.regression_bins(fx.regression_sample(spark, sf), ["sample"], "y", "y_pred"))


def regression_delta(spark: SparkSession, sf: str) -> DataFrame:
    metrics = regression.regression_metrics(fx.regression_sample(spark, sf), ["sample"], "y", "y_pred", regression.mape_plain)
    return tidy(regression.regression_delta(metrics, SAMPLE_NAMES))


def traffic_light(spark: SparkSession, sf: str) -> DataFrame:
    """The three kinds of status rules on each client's change in monthly spend."""
    rows = fx.mart(spark, sf).select("epk_id", "report_dt", "spend_amt", "disc_avg")
    before = F.lag("spend_amt").over(Window.partitionBy("epk_id").orderBy("report_dt"))
    change = rows.withColumn("delta", F.try_divide(F.col("spend_amt") - before, before))
    d = F.col("delta")
    return tidy(change.select(
        "epk_id",
        "report_dt",
        "delta",
        status_two_sided(d, 0.2, 0.3).alias("two_sided"),
        status_two_sided(d, -0.2, -0.3, "reverse").alias("two_sided_reverse"),
        status_one_sided(d, 0.2, 0.3).alias("one_sided"),
        status_one_sided(d, -0.2, -0.3, "reverse").alias("one_sided_reverse"),
        status_boundary(d, -0.25).alias("boundary"),
        status_boundary(d, 0.25, "reverse").alias("boundary_reverse"),
    ))


def rec_curve(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(regression.rec_curve(fx.regression_sample(spark, sf), ["sample"], "y", "y_pred"), 4)


def rec_area(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(regression.rec_area(fx.regression_sample(spark, sf), ["sample"], "y", "y_pred"), 4)


def scatter_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.regression_sample(spark, sf)
    return tidy(regression.scatter_sample(rows, ["o_orderkey"], "y", "y_pred", hash_fraction(F.col("o_orderkey"), seed=3)))


def scatter_limits(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.regression_sample(spark, sf).unpivot(["o_orderkey"], ["y", "y_pred"], "axis", "value")
    limits = ranks.quantiles(rows, ["axis"], "value", [0.01, 0.99], name="q")
    return tidy(limits.select("axis", "n_rows", F.col("q")[0].alias("p1"), F.col("q")[1].alias("p99")))


def calibration_stats(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(calibration.calibration_stats(fx.calibration_set(spark, sf), ["sample"]), 9)


def calibration_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Two fixed calibrators on all samples."""
    rows = fx.calibration_set(spark, sf)
    variants = F.array(
        F.struct(F.lit("shrunk").alias("method"), F.col("y_calib").alias("c")), F.struct(F.lit("squared").alias("method"), (F.col("y_pred") * F.col("y_pred")).alias("c"))
    )
    long = rows.select("sample", "y_true", "y_pred", F.explode(variants).alias("v")).select("sample", "y_true", "y_pred", "v.method", F.col("v.c").alias("y_calib"))
    return tidy(calibration.calibration_comparison(calibration.calibration_stats(long, ["method", "sample"]), SAMPLE_NAMES))


def linear_calibration(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.binary_sample(spark, sf)
    variants = [(scale, weighted) for scale in ("plain", "odds", "ln-odds") for weighted in (False, True)]
    return tidy(calibration.linear_lines(rows, ["sample"], "score", "y", variants))


def volume_gate(spark: SparkSession, sf: str) -> DataFrame:
    return gates.volume_gate(fx.model_predictions(spark, sf), ["model", "sample"], "y")


def model_registry(spark: SparkSession, sf: str) -> DataFrame:
    registry = gates.model_registry(fx.model_predictions(spark, sf), fx.model_importance(spark, sf), label="y", samples=SAMPLE_NAMES, forbidden=["size_qty"])
    return tidy(registry)


def model_gate(spark: SparkSession, sf: str) -> DataFrame:
    registry = gates.model_registry(fx.model_predictions(spark, sf), fx.model_importance(spark, sf), label="y", samples=SAMPLE_NAMES)
    bad = gates.problem_models(registry)
    return tidy(bad.select("model", "bp", "sp", "t_min", "gini_dif", "forbidden_start", "weak_gini", "unstable_gini"))


def used_features(spark: SparkSession, sf: str) -> DataFrame:
    return gates.used_features(fx.model_importance(spark, sf), fx.MODELS)


def agg_feature_models(spark: SparkSession, sf: str) -> DataFrame:
    return gates.aggregate_feature_models(fx.model_importance(spark, sf))


def feature_usage(spark: SparkSession, sf: str) -> DataFrame:
    return gates.feature_usage(fx.model_importance(spark, sf))


def model_titles(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(gates.model_titles(fx.binary_sample(spark, sf), "y"))


def multi_model_gini(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.model_predictions(spark, sf).where(F.col("sample") == "OOT")
    return tidy(binary.gini(rows, ["model"], "score", "y"))


QUERIES = {
    "quantile_bins": quantile_bins,
    "lower_deciles": lower_deciles,
    "psi_numeric": psi_numeric,
    "psi_equal_width": psi_equal_width,
    "psi_categorical": psi_categorical,
    "psi_categorical_documents": psi_categorical_documents,
    "psi_array": psi_array,
    "psi_detailed": psi_detailed,
    "psi_short": psi_short,
    "gini_features": gini_features,
    "gini_documents": gini_documents,
    "gini_flagged": gini_flagged,
    "gini_stability": gini_stability,
    "binary_metrics": binary_metrics,
    "binary_report": binary_report,
    "binary_bins": binary_bins,
    "auc_interval": auc_interval,
    "roc_curve": roc_curve,
    "pr_curve": pr_curve,
    "bin_means": bin_means,
    "confusion": confusion,
    "regression_metrics": regression_metrics,
    "regression_eval_metrics": regression_eval_metrics,
    "regression_bins": regression_bins,
    "regression_delta": regression_delta,
    "traffic_light": traffic_light,
    "rec_curve": rec_curve,
    "rec_area": rec_area,
    "scatter_sample": scatter_sample,
    "scatter_limits": scatter_limits,
    "calibration_stats": calibration_stats,
    "calibration_compare": calibration_compare,
    "linear_calibration": linear_calibration,
    "volume_gate": volume_gate,
    "model_registry": model_registry,
    "model_gate": model_gate,
    "used_features": used_features,
    "agg_feature_models": agg_feature_models,
    "feature_usage": feature_usage,
    "model_titles": model_titles,
    "multi_model_gini": multi_model_gini,
}

# ---------------------------------------------------------------------------------------------
# SQL twins.


def _grid(n: int) -> str:
    return "[" + ", ".join(repr(i / (n - 1)) for i in range(n)) + "]::DOUBLE[]"


def _binned(source: str, keys: str, value: str, n_edges: int, name: str = "binned") -> str:
    """CTEs that add `bin` (right-closed, null for the lowest value) to `source`."""
    join = " AND ".join(f"s.{k} = e.{k}" for k in keys.split(", "))
    return f"""edges_{name} AS (SELECT {keys}, list_sort(list_distinct(quantile_cont({value}, {_grid(n_edges)}))) AS edges FROM {source} GROUP BY ALL),
    {name} AS (SELECT s.*, nullif(len(list_filter(e.edges, lambda x: x < s.{value})), 0) - 1 AS bin FROM {source} s JOIN edges_{name} e ON {join})"""


def _long_sql(source: str, features: tuple[str, ...], extra: str) -> str:
    return " UNION ALL ".join(f"SELECT {extra}, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source}" for f in features)


def _psi_sql(source: str, features: tuple[str, ...], edges: str, actual: str, floor: float, selected: str = "") -> str:
    """PSI with left-closed bins; `edges` builds the sorted unique edge list from column `value`."""
    return rounded_sql(
        f"""{with_sql(source[0])}, l AS (SELECT * FROM ({_long_sql(source[1], features, "sample")}) WHERE sample IN ('train', '{actual}')),
    e AS (SELECT feature, list_sort(list_distinct({edges})) AS edges FROM l WHERE sample = 'train' AND value IS NOT NULL GROUP BY 1),
    b AS (SELECT feature, sample, CASE WHEN v >= edges[1] AND v <= edges[-1] THEN least(len(list_filter(edges, lambda x: x <= v)), len(edges) - 1) END AS bin
          FROM (SELECT feature, sample, coalesce(value, -9999) AS v FROM l) JOIN e USING (feature)),
    n AS (SELECT feature, sample, count(*) AS total FROM b GROUP BY ALL),
    c AS (SELECT feature, bin, sum(CASE WHEN sample = 'train' THEN 1 ELSE 0 END) AS ne, sum(CASE WHEN sample = '{actual}' THEN 1 ELSE 0 END) AS na FROM b WHERE bin IS NOT NULL GROUP BY ALL),
    s AS (SELECT c.feature, coalesce(nullif(ne / CAST(x.total AS DOUBLE), 0), {floor}::DOUBLE) AS e, coalesce(nullif(na / CAST(y.total AS DOUBLE), 0), {floor}::DOUBLE) AS a
          FROM c JOIN n x ON x.feature = c.feature AND x.sample = 'train' JOIN n y ON y.feature = c.feature AND y.sample = '{actual}')
    SELECT feature, sum((e - a) * ln(e / a)) AS psi{selected} FROM s GROUP BY 1""",
        "psi",
    )


def _psi_text_sql(source: tuple[str, str], features: tuple[str, ...]) -> str:
    rows = " UNION ALL ".join(f"SELECT sample, '{f}' AS feature, {f} AS value FROM {source[1]} WHERE {f} IS NOT NULL AND sample IN ('train', 'OOT')" for f in features)
    return rounded_sql(
        f"""{with_sql(source[0])}, l AS ({rows}), n AS (SELECT feature, sample, count(*) AS total FROM l GROUP BY ALL),
    v AS (SELECT DISTINCT feature, value FROM l),
    c AS (SELECT feature, value, sample, count(*) AS k FROM l GROUP BY ALL),
    s AS (SELECT v.feature, coalesce(ct.k / CAST(nt.total AS DOUBLE), 0.005::DOUBLE) AS e, coalesce(co.k / CAST(no.total AS DOUBLE), 0.005::DOUBLE) AS a FROM v
          LEFT JOIN c ct ON ct.feature = v.feature AND ct.value = v.value AND ct.sample = 'train'
          LEFT JOIN c co ON co.feature = v.feature AND co.value = v.value AND co.sample = 'OOT'
          JOIN n nt ON nt.feature = v.feature AND nt.sample = 'train' JOIN n no ON no.feature = v.feature AND no.sample = 'OOT')
    SELECT feature, sum((e - a) * ln(e / a)) AS psi FROM s GROUP BY 1""",
        "psi",
    )


_DETAILED = f"""{with_sql("gappy")},
    parts AS (SELECT *, unnest(CASE WHEN y = 1 THEN ['all', 'events'] ELSE ['all', 'nevents'] END) AS data_part FROM gappy WHERE sample <> 'valid'),
    l AS ({_long_sql("parts", (*fx.NUMERIC, "score"), "sample, data_part")}),
    r AS (SELECT feature, data_part, value, row_number() OVER w AS i, count(*) OVER (PARTITION BY feature, data_part) AS n
          FROM l WHERE sample = 'train' AND value IS NOT NULL WINDOW w AS (PARTITION BY feature, data_part ORDER BY value)),
    e AS (SELECT feature, data_part, list_sort(list(DISTINCT value)) AS edges FROM r
          WHERE list_contains([CAST(floor(d / 10::DOUBLE * (n - 1)) AS BIGINT) + 1 FOR d IN range(11)], i) GROUP BY ALL),
    b AS (SELECT l.feature, l.data_part, l.sample, l.value AS number,
            CASE WHEN value IS NULL THEN 'MISSING' WHEN value >= edges[1] AND value <= edges[-1]
                 THEN CAST(greatest(len(list_filter(edges, lambda x: x < value)), 1) - 1 AS VARCHAR) END AS bucket FROM l JOIN e USING (feature, data_part)
          UNION ALL SELECT 'p_brand', data_part, sample, NULL, coalesce(p_brand, 'MISSING') FROM parts),
    k AS (SELECT feature, data_part, bucket, sample, count(*) AS n, min(number) AS lo, max(number) AS hi FROM b WHERE bucket IS NOT NULL GROUP BY ALL),
    t AS (SELECT feature, data_part, sample, sum(n) AS total FROM k GROUP BY ALL),
    u AS (SELECT DISTINCT feature, data_part, bucket, versus FROM k CROSS JOIN (SELECT unnest(['test', 'OOT']) AS versus)),
    d AS (SELECT u.feature, u.bucket, u.data_part, u.versus, x.lo AS min_value, x.hi AS max_value, CAST(coalesce(x.n, 0) AS BIGINT) AS base_count,
            coalesce(x.n / CAST(tx.total AS DOUBLE), 0.001::DOUBLE) AS base_share, CAST(coalesce(z.n, 0) AS BIGINT) AS versus_count,
            coalesce(z.n / CAST(tz.total AS DOUBLE), 0.001::DOUBLE) AS versus_share
          FROM u LEFT JOIN k x ON x.feature = u.feature AND x.data_part = u.data_part AND x.bucket = u.bucket AND x.sample = 'train'
          LEFT JOIN k z ON z.feature = u.feature AND z.data_part = u.data_part AND z.bucket = u.bucket AND z.sample = u.versus
          JOIN t tx ON tx.feature = u.feature AND tx.data_part = u.data_part AND tx.sample = 'train'
          JOIN t tz ON tz.feature = u.feature AND tz.data_part = u.data_part AND tz.sample = u.versus
          WHERE x.n IS NOT NULL OR z.n IS NOT NULL),
    psi AS (SELECT *, (versus_share - base_share) * ln(versus_share / base_share) AS psi FROM d)"""

_SHORT_NAMES = {f"PSI_train_vs_{s}_{p}": (s, p) for s in AGAINST for p in ("all", "events", "nevents")}


def _auc_sql(source: str, keys: str, value: str, label: str = "y") -> str:
    """(keys, pos, neg, auc) by comparing average ranks, an independent route to the AUC."""
    part = f"PARTITION BY {keys}" if keys else ""
    group = f"{keys}, " if keys else ""
    return f"""SELECT {group}sum({label}) AS pos, sum(1 - {label}) AS neg,
      (sum(CASE WHEN {label} = 1 THEN r END) - sum({label}) * (sum({label}) + 1) / 2.0::DOUBLE) / CAST(nullif(sum({label}) * sum(1 - {label}), 0) AS DOUBLE) AS auc
      FROM (SELECT *, rank() OVER ({part} ORDER BY {value}) + (count(*) OVER ({part + ' ,' if part else 'PARTITION BY'} {value}) - 1) / 2.0::DOUBLE AS r FROM {source}) GROUP BY ALL"""


_SPEARMAN = """corr(rank_y, rank_p) FROM (SELECT *,
    rank() OVER (PARTITION BY {k} ORDER BY y) + (count(*) OVER (PARTITION BY {k}, y) - 1) / 2.0::DOUBLE AS rank_y,
    rank() OVER (PARTITION BY {k} ORDER BY y_pred) + (count(*) OVER (PARTITION BY {k}, y_pred) - 1) / 2.0::DOUBLE AS rank_p FROM {s})"""


def _regression_sql(source: str, keys: str, factor: int = 1, mape: str = "abs(1 + y)") -> str:
    return f"""SELECT {keys}, count(*) AS n_rows, avg(abs(y - y_pred)) AS mae, {factor} * avg(abs(y - y_pred) / {mape}) AS mape,
      sqrt(avg((y - y_pred) * (y - y_pred))) AS rmse, {factor} * (1 - sum((y - y_pred) * (y - y_pred)) / nullif(var_pop(y) * count(*), 0)) AS r2,
      {factor} * corr(y, y_pred) AS pearson, {factor} * {_SPEARMAN.format(k=keys, s=source)} GROUP BY ALL"""


def _curve_sql(select: str) -> str:
    return f"""{with_sql('binary')}, v AS (SELECT sample, score, sum(y) AS pos, sum(1 - y) AS neg FROM bin_sample GROUP BY ALL),
    c AS (SELECT sample, score AS threshold, CAST(sum(pos) OVER top AS DOUBLE) AS tp, CAST(sum(neg) OVER top AS DOUBLE) AS fp,
          CAST(sum(pos) OVER (PARTITION BY sample) AS DOUBLE) AS p, CAST(sum(neg) OVER (PARTITION BY sample) AS DOUBLE) AS n
          FROM v WINDOW top AS (PARTITION BY sample ORDER BY score DESC)) SELECT sample, threshold, {select} FROM c"""


def _binary_metrics_sql(source: str, keys: str) -> str:
    """Gini, average precision and log-loss per group from separate definitions."""
    clip = "least(greatest(score, 1e-15::DOUBLE), 1 - 1e-15::DOUBLE)"
    using = f"USING ({keys})"
    return f"""a AS ({_auc_sql(source, keys, "score")}),
    v AS (SELECT {keys}, score, sum(y) AS pos, count(*) AS n FROM {source} GROUP BY ALL),
    w AS (SELECT *, CAST(sum(pos) OVER top AS DOUBLE) AS tp, CAST(sum(n) OVER top AS DOUBLE) AS k FROM v WINDOW top AS (PARTITION BY {keys} ORDER BY score DESC)),
    ap AS (SELECT {keys}, sum(pos * tp / k) / sum(pos) AS ap FROM w GROUP BY ALL),
    ll AS (SELECT {keys}, count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS n_events, -avg(y * ln({clip}) + (1 - y) * ln(1 - {clip})) AS loss FROM {source} GROUP BY ALL),
    m AS (SELECT {keys}, n_rows, n_events, 100 * (2 * auc - 1) AS gini, 100 * ap AS pr_auc, 100 * loss AS log_loss FROM a JOIN ap {using} JOIN ll {using})"""


def _wide(values: tuple[str, ...], samples: tuple[str, ...] = SAMPLE_NAMES) -> str:
    return ", ".join(f"max(CASE WHEN sample = '{s}' THEN {v} END) AS {v}_{s}" for v in values for s in samples)


_BIN_TABLE = f"""{with_sql('binary')}, {_binned('bin_sample', 'sample', 'score', 20)},
    t AS (SELECT sample, coalesce(bin, -1) AS b, min(score) AS prob_min, avg(score) AS prob_mean, max(score) AS prob_max, avg(y) AS eventrate,
            count(*) AS n_obs, CAST(sum(y) AS BIGINT) AS n_event FROM binned GROUP BY ALL),
    c AS (SELECT t.*, n_obs - n_event AS n_nonevent,
            (SELECT count(*) FROM bin_sample x WHERE x.sample = t.sample AND x.score >= t.prob_min AND x.y = 1) AS cum_event,
            (SELECT count(*) FROM bin_sample x WHERE x.sample = t.sample AND x.score >= t.prob_min AND x.y = 0) AS cum_nonevent FROM t)"""

_GATE = """flags AS (SELECT *, abs(gini_test - gini_train) AS gini_dif,
      ((bp IN ('dc1', 'dc2p') AND sp = 'dc') OR bp = sp OR bp = sp || '2' OR (bp LIKE 'EL%' AND sp = 'pl')) AND t_min = 0 AS forbidden_start,
      least(gini_train, gini_valid, gini_test) < 0.3 AS weak_gini, abs(gini_test - gini_train) > 0.05 AS unstable_gini FROM registry)"""

_REGISTRY = f"""{with_sql('importance')}, a AS ({_auc_sql('predictions', 'model, sample', 'score')}),
    g AS (SELECT model, {_wide(('gini',))} FROM (SELECT model, sample, 2 * auc - 1 AS gini FROM a) GROUP BY 1),
    s AS (SELECT model, CAST(sum(y) FILTER (sample = 'train') AS BIGINT) AS events_train, CAST(sum(y) FILTER (sample = 'OOT') AS BIGINT) AS events_OOT,
            avg(y) FILTER (sample = 'train') AS rate_train, avg(y) FILTER (sample = 'OOT') AS rate_OOT, min(T) AS t_min, max(T) AS t_max FROM predictions GROUP BY 1),
    p AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS place FROM importance),
    u AS (SELECT model, split_part(model, '_', 1) AS bp, split_part(model, '_', -1) AS sp, max(CASE WHEN feature = split_part(model, '_', 1) THEN importance END) AS bp_feature_importance,
            max(CASE WHEN feature = split_part(model, '_', 1) AND importance > 0 THEN place END) AS bp_feature_importance_place,
            CAST(count(*) AS INT) AS used_features_qty, string_agg(feature, ',' ORDER BY place) AS used_features,
            coalesce(string_agg(CASE WHEN feature = 'size_qty' THEN feature END, ','), '') AS forbidden_features FROM p GROUP BY 1),
    registry AS (SELECT * FROM u JOIN g USING (model) JOIN s USING (model))"""

_CALIB = """SELECT {k}, CAST(bin AS VARCHAR) AS bin, avg(y_pred) AS mean_proba, avg(y_calib) AS calibration_proba, avg(y_true) AS event_rate, count(*) AS n_obs FROM binned WHERE bin IS NOT NULL GROUP BY ALL"""
_CLIP = "least(greatest({c}, 1e-5::DOUBLE), 1 - 1e-5::DOUBLE)"


def _calibration_sql(source: str, keys: str) -> str:
    def loss(c: str) -> str:
        p = _CLIP.format(c=c)
        return f"-avg(y_true * ln({p}) + (1 - y_true) * ln(1 - {p}))"

    return f"""{_binned(source, keys, "y_pred", 21)}, bins AS ({_CALIB.format(k=keys)}),
    err AS (SELECT {keys}, sum(abs(event_rate - mean_proba) * n_obs) / sum(n_obs) AS mae, sum(abs(event_rate - calibration_proba) * n_obs) / sum(n_obs) AS mae_calibrated,
            CAST(sum(n_obs) AS BIGINT) AS n_obs FROM bins GROUP BY ALL),
    tot AS (SELECT {keys}, avg(y_pred) AS mean_proba, avg(y_calib) AS calibration_proba, avg(y_true) AS event_rate, avg((y_true - y_pred) ** 2) AS brier,
            avg((y_true - y_calib) ** 2) AS brier_calibrated, {loss("y_pred")} AS logloss, {loss("y_calib")} AS logloss_calibrated FROM {source} GROUP BY ALL),
    stats AS (SELECT *, NULL::DOUBLE AS mae, NULL::DOUBLE AS mae_calibrated, NULL::DOUBLE AS brier, NULL::DOUBLE AS brier_calibrated, NULL::DOUBLE AS logloss, NULL::DOUBLE AS logloss_calibrated FROM bins
      UNION ALL BY NAME SELECT tot.*, err.* EXCLUDE ({keys}, n_obs), coalesce(err.n_obs, 0) AS n_obs, 'Total' AS bin FROM tot LEFT JOIN err USING ({keys}))"""


_CALIB_COLUMNS = ("mean_proba", "calibration_proba", "event_rate", "mae", "mae_calibrated", "brier", "brier_calibrated", "logloss", "logloss_calibrated")
_COMPARE = [(m, s) for m in ("mae", "brier", "logloss") for s in SAMPLE_NAMES]


def _linear_sql() -> str:
    maps = {"plain": "{v}", "odds": "{v} / nullif(1 - {v}, 0)", "ln-odds": "CASE WHEN {v} > 0 AND {v} < 1 THEN ln({v} / (1 - {v})) END"}
    rows = []
    for scale, form in maps.items():
        for weighted in (False, True):
            rows.append(
                f"""SELECT '{scale}' AS scale, {str(weighted).lower()} AS weighted, sample, {form.format(v="x")} AS x, {form.format(v="y")} AS y, {"w" if weighted else "1.0::DOUBLE"} AS w FROM m"""
            )
    return rounded_sql(
        f"""{with_sql('binary')}, {_binned('bin_sample', 'sample', 'score', 20)},
    m AS (SELECT *, events / sum(events) OVER (PARTITION BY sample) AS w FROM (
          SELECT sample, bin, avg(score) AS x, avg(y) AS y, CAST(sum(y) AS DOUBLE) AS events FROM binned WHERE bin IS NOT NULL GROUP BY ALL)),
    pts AS ({" UNION ALL ".join(rows)}),
    c AS (SELECT scale, weighted, sample, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM pts WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL)
    SELECT scale, weighted, sample, sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) ** 2) AS slope,
           my - mx * sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) ** 2) AS intercept
    FROM pts JOIN c USING (scale, weighted, sample) GROUP BY scale, weighted, sample, mx, my""",
        "slope", "intercept",
    )


_REG_BINNED = f"{with_sql('regression')}, {_binned('reg_sample', 'sample', 'y_pred', 20)}"
_SPREAD = """min(y_pred) AS pred_min, avg(y_pred) AS pred_mean, max(y_pred) AS pred_max, min(y) AS real_min, avg(y) AS real_mean, max(y) AS real_max,
    quantile_cont(y, 0.25::DOUBLE) AS real_p25, quantile_cont(y, 0.5::DOUBLE) AS real_p50, quantile_cont(y, 0.75::DOUBLE) AS real_p75"""
_REG_COLUMNS = ("mae", "mape", "rmse", "r2", "pearson", "spearman")
_SPREAD_COLUMNS = ("pred_min", "pred_mean", "pred_max", "real_min", "real_mean", "real_max", "real_p25", "real_p50", "real_p75")


def _named_regression(source: str, keys: str, **more) -> str:
    return _regression_sql(source, keys, **more).replace("corr(rank_y, rank_p) FROM", "corr(rank_y, rank_p) AS spearman FROM")


def _delta_status(s: str, low: float, high: float) -> str:
    d = f"(\"{s}\" - train) / nullif(train, 0)"
    return f"""CASE WHEN metric IN ('r2', 'pearson', 'spearman') THEN CASE WHEN {d} > -{low} THEN 'green' WHEN {d} < -{high} THEN 'red' WHEN {d} IS NOT NULL THEN 'yellow' END
      ELSE CASE WHEN {d} < {low} THEN 'green' WHEN {d} > {high} THEN 'red' WHEN {d} IS NOT NULL THEN 'yellow' END END AS status_{s}"""


def _stability_sql() -> str:
    deltas = []
    for s in ("valid", "test", "OOT"):
        yellow, red = binary.GINI_BAND[s]
        d = f"(gini_{s} - gini_train) / CASE WHEN gini_train = 0 THEN 0.00001 ELSE gini_train END"
        deltas.append(f"""{d} AS delta_train_vs_{s}, CASE WHEN feature = 'model' THEN CASE WHEN {d} > {yellow} THEN 'green' WHEN {d} < {red} THEN 'red' ELSE 'yellow' END
          ELSE CASE WHEN {d} <= {red} THEN 'red' END END AS status_{s}""")
    rows = _long_sql("gappy", fx.NUMERIC, "sample, y") + " UNION ALL SELECT sample, y, 'model', score FROM gappy"
    return rounded_sql(
        f"""{with_sql('gappy')}, l AS (SELECT sample, y, feature, coalesce(value, -9999) AS value FROM ({rows})),
    a AS ({_auc_sql('l', 'sample, feature', 'value')}), w AS (SELECT feature, {_wide(('gini',))} FROM (SELECT feature, sample, 200 * abs(auc - 0.5) AS gini FROM a) GROUP BY 1)
    SELECT *, {", ".join(deltas)} FROM w""",
        *[f"gini_{s}" for s in SAMPLE_NAMES], *[f"delta_train_vs_{s}" for s in SAMPLE_NAMES[1:]],
    )


_TRAIN_GINI = f"""{with_sql('gappy')}, l AS (SELECT y, feature, coalesce(value, -9999) AS value FROM ({_long_sql('gappy', fx.NUMERIC, 'sample, y')}) WHERE sample = 'train'),
    a AS ({_auc_sql('l', 'feature', 'value')}), g AS (SELECT feature, 200 * abs(auc - 0.5) AS gini FROM a)"""

ORACLE = {
    "quantile_bins": rounded_sql(
        f"""{with_sql('binary')}, {_binned('bin_sample', 'sample', 'l_extendedprice', 20)} SELECT sample, CAST(coalesce(bin, -1) AS INT) AS bin, count(*) AS n,
        min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM binned GROUP BY 1, 2""", "low", "high"),
    "lower_deciles": rounded_sql(
        f"""{with_sql('binary')}, r AS (SELECT sample, l_extendedprice, row_number() OVER (PARTITION BY sample ORDER BY l_extendedprice) - 1 AS i,
          count(*) OVER (PARTITION BY sample) AS n FROM bin_sample), d AS (SELECT unnest(range(11)) AS decile)
        SELECT sample, n AS n_rows, CAST(decile AS INT) AS decile, l_extendedprice AS edge FROM r JOIN d ON i = CAST(floor(decile / 10::DOUBLE * (n - 1)) AS BIGINT)""", "edge"),
    "psi_numeric": f"SELECT *, CAST(psi < 0.002 AS INT) AS selected FROM ({_psi_sql(('gappy', 'gappy'), fx.NUMERIC, f'quantile_cont(value, {_grid(21)})', 'OOT', 0.005)})",
    "psi_equal_width": _psi_sql(
        ("gappy", "gappy"), fx.NUMERIC,
        "list_append([min(value) + i * ((max(value) - min(value)) / 20::DOUBLE) FOR i IN range(20)], max(value))", "OOT", 0.005),
    "psi_categorical": _psi_text_sql(("gappy", "gappy"), ("p_brand", "l_returnflag")),
    "psi_categorical_documents": _psi_text_sql(("document_parts", "doc_parts"), ("lang", "source")),
    "psi_array": _psi_sql(("binary", "bin_sample"), ("l_quantity", "l_extendedprice", "score"), f"quantile_cont(value, {_grid(11)})", "test", 0.0001),
    "psi_detailed": rounded_sql(f"{_DETAILED} SELECT * FROM psi", "min_value", "max_value", "base_share", "versus_share", "psi"),
    "psi_short": rounded_sql(
        f"""{_DETAILED}, w AS (SELECT feature, {", ".join(f"sum(CASE WHEN versus = '{s}' AND data_part = '{p}' THEN psi END) AS {n}" for n, (s, p) in _SHORT_NAMES.items())} FROM psi GROUP BY 1)
        SELECT *, CASE WHEN greatest({", ".join(_SHORT_NAMES)}) >= 0.2 THEN 'red' END AS status FROM w""", *_SHORT_NAMES),
    "gini_features": rounded_sql(f"{_TRAIN_GINI} SELECT feature, gini, CAST(gini > 0.8 AS INT) AS selected FROM g UNION ALL SELECT 'p_brand', NULL, 1", "gini"),
    "gini_documents": rounded_sql(
        f"""{with_sql('document')}, l AS (SELECT quality, toxic AS y, 'n_chars' AS feature, n_chars AS value FROM doc_sample),
        a AS ({_auc_sql('l', 'quality, feature', 'value')}) SELECT quality, feature, 200 * abs(auc - 0.5) AS gini FROM a""", "gini"),
    "gini_flagged": rounded_sql(
        f"""{_TRAIN_GINI} SELECT feature, gini, CAST(feature IN ('l_quantity', 'l_discount') AS INT) AS model_flag,
        CASE WHEN feature IN ('p_size', 'p_retailprice') THEN 'parts of ' || (SELECT count(DISTINCT p_type) FROM part) || ' types' END AS description FROM g""", "gini"),
    "gini_stability": _stability_sql(),
    "binary_metrics": rounded_sql(f"{with_sql('binary')}, {_binary_metrics_sql('bin_sample', 'sample')} SELECT * FROM m", "gini", "pr_auc", "log_loss"),
    "binary_report": rounded_sql(
        f"{with_sql('predictions')}, {_binary_metrics_sql('predictions', 'model, sample')} SELECT model, {_wide(('gini', 'pr_auc', 'log_loss'))} FROM m GROUP BY 1",
        *[f"{v}_{s}" for v in ("gini", "pr_auc", "log_loss") for s in SAMPLE_NAMES]),
    "binary_bins": rounded_sql(
        f"""{_BIN_TABLE} SELECT sample, CAST(row_number() OVER (PARTITION BY sample ORDER BY b) AS VARCHAR) AS bin, prob_min, prob_mean, prob_max, eventrate,
        n_obs, n_event, n_nonevent, cum_event, cum_nonevent, 100 * cum_nonevent / CAST(sum(n_nonevent) OVER (PARTITION BY sample) AS DOUBLE) AS one_minus_specificity,
        100 * cum_event / CAST(sum(n_event) OVER (PARTITION BY sample) AS DOUBLE) AS sensitivity FROM c
        UNION ALL SELECT sample, 'Total', NULL, NULL, NULL, sum(n_event) / CAST(sum(n_obs) AS DOUBLE), CAST(sum(n_obs) AS BIGINT), CAST(sum(n_event) AS BIGINT),
        CAST(sum(n_nonevent) AS BIGINT), NULL, NULL, NULL, NULL FROM c GROUP BY 1""",
        "prob_min", "prob_mean", "prob_max", "eventrate", "one_minus_specificity", "sensitivity"),
    "auc_interval": rounded_sql(
        f"""{with_sql('binary')}, a AS (SELECT sample, 100 * auc AS auc, 1.96::DOUBLE * sqrt(100 * auc * (100 - 100 * auc) / (pos + neg)) AS e FROM ({_auc_sql('bin_sample', 'sample', 'score')}))
        SELECT sample, 2 * auc - 100 AS gini, auc, e AS auc_std_err, auc - e AS auc_lcl, auc + e AS auc_ucl FROM a""",
        "gini", "auc", "auc_std_err", "auc_lcl", "auc_ucl"),
    "roc_curve": rounded_sql(_curve_sql("tp / p AS tpr, fp / n AS fpr"), "threshold", "tpr", "fpr"),
    "pr_curve": rounded_sql(_curve_sql("tp / (tp + fp) AS precision, tp / p AS recall, p / (p + n) AS base_rate"), "threshold", "precision", "recall", "base_rate"),
    "bin_means": rounded_sql(
        f"""{_REG_BINNED} SELECT sample, CAST(coalesce(bin, -1) AS INT) AS bin, avg(y_pred) AS pred_mean, avg(y) AS target_mean, count(*) AS n_obs,
        quantile_cont(y, 0.25::DOUBLE) AS target_p25, quantile_cont(y, 0.5::DOUBLE) AS target_p50, quantile_cont(y, 0.75::DOUBLE) AS target_p75 FROM binned GROUP BY 1, 2""",
        "pred_mean", "target_mean", "target_p25", "target_p50", "target_p75"),
    "confusion": rounded_sql(f"{with_sql('binary')} SELECT y AS x, CAST(score > 0.5 AS INT) AS y, ln(count(*)) AS value FROM bin_sample GROUP BY bin_sample.y, score > 0.5", "value"),
    "regression_metrics": rounded_sql(f"{with_sql('regression')} {_named_regression('reg_sample', 'sample')}", *_REG_COLUMNS),
    "regression_eval_metrics": rounded_sql(
        f"""{with_sql('regression')} SELECT sample, avg(abs(y - y_pred)) AS mae, avg((y - y_pred) ** 2) AS mse, sqrt(avg((y - y_pred) ** 2)) AS rmse,
        sqrt(avg((ln(1 + y_pred) - ln(1 + y)) ** 2)) AS rmsle, 1 - sum((y - y_pred) ** 2) / (var_pop(y) * count(*)) AS r2,
        100 * avg(abs(y - y_pred) / y) AS mape_signed, avg(abs((y - y_pred) / y)) AS mape_plain FROM reg_sample GROUP BY 1""",
        "mae", "mse", "rmse", "rmsle", "r2", "mape_signed", "mape_plain", digits=1),
    "regression_bins": rounded_sql(
        f"""{_REG_BINNED}, b AS (SELECT * REPLACE (coalesce(bin, -1) AS bin) FROM binned),
        m AS ({_named_regression('b', 'sample, bin', factor=100)}), q AS (SELECT sample, bin, {_SPREAD} FROM b GROUP BY ALL),
        tm AS ({_named_regression('reg_sample', 'sample', factor=100)}), tq AS (SELECT sample, {_SPREAD} FROM reg_sample GROUP BY ALL)
        SELECT m.* REPLACE (CAST(row_number() OVER (PARTITION BY sample ORDER BY bin) AS VARCHAR) AS bin), q.* EXCLUDE (sample, bin) FROM m JOIN q USING (sample, bin)
        UNION ALL BY NAME SELECT tm.*, tq.* EXCLUDE (sample), 'Total' AS bin FROM tm JOIN tq USING (sample)""", *_REG_COLUMNS, *_SPREAD_COLUMNS),
    "regression_delta": rounded_sql(
        f"""{with_sql('regression')}, m AS ({_named_regression('reg_sample', 'sample', mape='abs(y)')}),
        l AS (UNPIVOT (SELECT * EXCLUDE (n_rows) FROM m) ON mae, mape, rmse, r2, pearson, spearman INTO NAME metric VALUE v),
        w AS (SELECT metric, {", ".join(f"max(CASE WHEN sample = '{s}' THEN v END) AS {s}" for s in SAMPLE_NAMES)} FROM l GROUP BY 1)
        SELECT *, {", ".join(f"({s} - train) / nullif(train, 0) AS delta_train_vs_{s}" for s in SAMPLE_NAMES[1:])}, {_delta_status("test", 0.2, 0.3)}, {_delta_status("OOT", 0.15, 0.25)} FROM w""",
        *SAMPLE_NAMES, *[f"delta_train_vs_{s}" for s in SAMPLE_NAMES[1:]]),
    "traffic_light": rounded_sql(
        f"""{with_sql('mart')}, c AS (SELECT epk_id, report_dt, (spend_amt - lag(spend_amt) OVER w) / nullif(lag(spend_amt) OVER w, 0) AS delta FROM mart
          WINDOW w AS (PARTITION BY epk_id ORDER BY report_dt))
        SELECT epk_id, report_dt, delta, CASE WHEN delta IS NULL THEN NULL WHEN delta < 0.2 THEN 'green' WHEN delta <= 0.3 THEN 'yellow' ELSE 'red' END AS two_sided,
        CASE WHEN delta IS NULL THEN NULL WHEN delta > -0.2 THEN 'green' WHEN delta >= -0.3 THEN 'yellow' ELSE 'red' END AS two_sided_reverse,
        CASE WHEN delta < 0.2 THEN 'green' WHEN delta >= 0.3 THEN 'red' END AS one_sided, CASE WHEN delta > -0.2 THEN 'green' WHEN delta <= -0.3 THEN 'red' END AS one_sided_reverse,
        CASE WHEN delta <= -0.25 THEN 'red' END AS boundary, CASE WHEN delta >= 0.25 THEN 'red' END AS boundary_reverse FROM c""", "delta"),
    "rec_curve": rounded_sql(
        f"""{with_sql('regression')}, mu AS (SELECT sample, avg(y) AS c FROM reg_sample GROUP BY 1),
        e AS (SELECT sample, 'model' AS curve, abs(y - y_pred) AS error FROM reg_sample UNION ALL SELECT sample, 'baseline', abs(y - c) FROM reg_sample JOIN mu USING (sample))
        SELECT DISTINCT sample, curve, error, count(*) OVER (PARTITION BY sample, curve ORDER BY error) / CAST(count(*) OVER (PARTITION BY sample, curve) AS DOUBLE) AS share FROM e""",
        "error", "share", digits=4),
    "rec_area": rounded_sql(
        f"""{with_sql('regression')}, mu AS (SELECT sample, avg(y) AS c FROM reg_sample GROUP BY 1),
        e AS (SELECT sample, 'model' AS curve, abs(y - y_pred) AS x FROM reg_sample UNION ALL SELECT sample, 'baseline', abs(y - c) FROM reg_sample JOIN mu USING (sample)),
        o AS (SELECT sample, curve, x, row_number() OVER w / CAST(count(*) OVER (PARTITION BY sample, curve) AS DOUBLE) AS h FROM e WINDOW w AS (PARTITION BY sample, curve ORDER BY x)),
        s AS (SELECT *, (x - lag(x) OVER w) * (h + lag(h) OVER w) / 2 AS strip FROM o WINDOW w AS (PARTITION BY sample, curve ORDER BY x, h)),
        a AS (SELECT sample, curve, max(x) * max(h) - sum(strip) AS aoc FROM s GROUP BY ALL)
        SELECT sample, max(CASE WHEN curve = 'model' THEN aoc END) AS aoc_model, max(CASE WHEN curve = 'baseline' THEN aoc END) AS aoc_baseline,
        max(CASE WHEN curve = 'model' THEN aoc END) / max(CASE WHEN curve = 'baseline' THEN aoc END) AS aoc_ratio FROM a GROUP BY 1""",
        "aoc_model", "aoc_baseline", "aoc_ratio", digits=4),
    "scatter_sample": f"""{with_sql('regression')} SELECT o_orderkey, y, y_pred FROM reg_sample
        WHERE ('0x' || substr(md5(o_orderkey || '|3'), 1, 13))::BIGINT / 4503599627370496::DOUBLE < greatest(0.1, 10000::DOUBLE / (SELECT count(*) FROM reg_sample))""",
    "scatter_limits": rounded_sql(
        f"""{with_sql('regression')} SELECT axis, count(*) AS n_rows, quantile_cont(v, 0.01::DOUBLE) AS p1, quantile_cont(v, 0.99::DOUBLE) AS p99
        FROM (SELECT 'y' AS axis, y AS v FROM reg_sample UNION ALL SELECT 'y_pred', y_pred FROM reg_sample) GROUP BY 1""", "p1", "p99"),
    "calibration_stats": rounded_sql(f"{with_sql('calibration')}, {_calibration_sql('calib', 'sample')} SELECT * FROM stats", *_CALIB_COLUMNS, digits=9),
    "calibration_compare": rounded_sql(
        f"""{with_sql('calibration')}, two AS (SELECT 'shrunk' AS method, * FROM calib UNION ALL SELECT 'squared', * REPLACE (y_pred * y_pred AS y_calib) FROM calib),
        {_calibration_sql('two', 'method, sample')} SELECT method, {", ".join(
            f"max(CASE WHEN sample = '{s}' THEN {m} END) AS {m}_{s}, max(CASE WHEN sample = '{s}' THEN {m}_calibrated END) AS {m}_calibrated_{s}, "
            f"max(CASE WHEN sample = '{s}' THEN {m}_calibrated - {m} END) AS delta_{m}_{s}" for m, s in _COMPARE)} FROM stats WHERE bin = 'Total' GROUP BY 1""",
        *[f"{p}{m}{q}_{s}" for m, s in _COMPARE for p, q in (("", ""), ("", "_calibrated"), ("delta_", ""))]),
    "linear_calibration": _linear_sql(),
    "volume_gate": f"""{with_sql('predictions')} SELECT model, sample, count(*) AS n_rows, count(*) FILTER (y > 0) AS n_positive, count(*) < 500000 AS low_rows,
        count(*) FILTER (y > 0) * 0.6 < 1000 OR count(*) FILTER (y > 0) * 0.2 < 100 AS few_positives FROM predictions GROUP BY ALL""",
    "model_registry": rounded_sql(f"{_REGISTRY} SELECT * FROM registry", "bp_feature_importance", *[f"gini_{s}" for s in SAMPLE_NAMES], "rate_train", "rate_OOT"),
    "model_gate": rounded_sql(
        f"""{_REGISTRY}, {_GATE} SELECT model, bp, sp, t_min, gini_dif, forbidden_start, weak_gini, unstable_gini FROM flags
        WHERE forbidden_start OR weak_gini OR unstable_gini""", "gini_dif"),
    "used_features": f"""{with_sql('importance')} SELECT feature, {", ".join(f"max(CAST(model = '{m}' AS INT)) AS {m}" for m in fx.MODELS)} FROM importance GROUP BY 1""",
    "agg_feature_models": f"""{with_sql('importance')} SELECT model, count(*) AS n_aggregates, string_agg(feature, ',' ORDER BY feature) AS aggregates FROM importance
        WHERE regexp_matches(feature, '_[0-9]+a$') GROUP BY 1""",
    "feature_usage": f"""{with_sql('importance')} SELECT feature, count(DISTINCT model) AS n_models, regexp_matches(feature, '_[0-9]+a$') AS is_aggregate FROM importance GROUP BY 1""",
    "model_titles": rounded_sql(
        f"""{with_sql('binary')}, a AS ({_auc_sql('bin_sample', 'sample', 'score')}) SELECT sample, CAST(pos + neg AS BIGINT) AS n_obs, CAST(pos AS BIGINT) AS n_events,
        pos / CAST(pos + neg AS DOUBLE) AS eventrate, 2 * auc - 1 AS gini FROM a""", "eventrate", "gini"),
    "multi_model_gini": rounded_sql(
        f"""{with_sql('predictions')}, o AS (SELECT * FROM predictions WHERE sample = 'OOT'), a AS ({_auc_sql('o', 'model', 'score')})
        SELECT model, CAST(pos + neg AS BIGINT) AS n_rows, CAST(pos AS BIGINT) AS n_events, 2 * auc - 1 AS gini FROM a""", "gini"),
}
