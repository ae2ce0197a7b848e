"""Registered queries: mart, targets, cleaning, profiles, encoding."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.functions.columns import blank_free_lower, log_target, replace_in_order, unlog_target
from valuekit.operators import clean, encode, mart, profile, regression, targets
from valuekit.plans import fixtures as fx
from valuekit.plans.fixtures import rounded_sql, tidy, with_sql
from valuekit.roles import align_columns, categorical_columns, drop_matching, drop_roles, numeric_columns, promote_new

AVERAGED = ("ord_qty", "qty_amt", "spend_amt", "disc_avg")
FEATURES = (*AVERAGED, "prio_cd", "seg_cd", "bal_amt")


def mart_slice(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(mart.mart_slice(
        fx.mart(spark, sf, fx.slice_months()), fx.SLICE_DATE, key="epk_id", month="report_dt", features=FEATURES, averaged=AVERAGED, condition=fx.VALID_CLIENT
    ))


def _slice_sql() -> str:
    def months(k: int) -> str:
        return ", ".join(f"DATE '{m}'" for m in fx.slice_months(k))

    means = [f"avg(CASE WHEN report_dt IN ({months(k)}) THEN {c} END) AS {c}_{k}a" for k in (3, 6, 12) for c in AVERAGED]
    return rounded_sql(
        f"""{with_sql("mart")}
        SELECT s.epk_id, s.ord_qty, s.qty_amt, s.spend_amt, s.disc_avg, s.prio_cd, s.seg_cd, s.bal_amt, a.* EXCLUDE (epk_id)
        FROM (SELECT * FROM mart WHERE report_dt = DATE '{fx.SLICE_DATE}' AND {fx.VALID_CLIENT}) s
        JOIN (SELECT epk_id, {", ".join(means)} FROM mart WHERE {fx.VALID_CLIENT} GROUP BY 1) a USING (epk_id)""",
        "qty_amt", "spend_amt", "disc_avg", "bal_amt", *[f"{c}_{k}a" for k in (3, 6, 12) for c in AVERAGED],
    )


def latest_month(spark: SparkSession, sf: str) -> DataFrame:
    return mart.latest_month(fx.mart(spark, sf), "report_dt")


def freshness_gate(spark: SparkSession, sf: str) -> DataFrame:
    return mart.freshness(fx.mart(spark, sf), date(2001, 9, 12), "report_dt")


def text_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return fx.mart(spark, sf).select(
        "epk_id",
        "report_dt",
        blank_free_lower(F.col("prio_cd")).alias("prio_cd"),
        F.lower("seg_cd").alias("seg_cd"),
        replace_in_order(F.col("prio_cd"), {"NOT ": "UN", "UNSPEC": "spec", "-": "_"}).alias("prio_text"),
    )


def expr_projection(spark: SparkSession, sf: str) -> DataFrame:
    expressions = ["epk_id", "report_dt", "qty_amt / ord_qty AS qty_per_ord", "coalesce(seg_cd, 'NA') AS segment", "CAST(report_dt AS STRING) AS month_text"]
    return tidy(clean.project(fx.mart(spark, sf), expressions, {"segment": "seg_new", "qty_per_ord": "avg_qty"}))


def constant_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.mart_with_gaps(spark, sf)
    return clean.column_levels(rows, rows.columns).select("column", "is_constant")


def null_share_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.mart_with_gaps(spark, sf)
    levels = clean.column_levels(rows, rows.columns)
    return tidy(levels.select("column", "null_share", (F.col("null_share") > 0.5).alias("dropped")))


GAP_COLUMNS = ("epk_id", "report_dt", "prio_cd", "seg_cd", "ord_qty", "qty_amt", "disc_avg", "one_value", "one_or_null")


def _levels_sql(select: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS d, count(*) - count({c}) AS nulls, count(*) AS n FROM gaps" for c in GAP_COLUMNS
    )
    return f"{with_sql('gaps')} SELECT \"column\", {select} FROM ({rows})"


def role_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Row, filled and distinct counts of the columns each role picks from the binary sample."""
    rows = drop_roles(fx.binary_sample(spark, sf), fx.LINE_ROLES)
    picked = {"categorical": categorical_columns(rows, ["p_size"], ["sample"]), "numeric": numeric_columns(rows, [*fx.LINE_KEY, "p_size"])}
    long = F.array(*[
        F.struct(F.lit(r).alias("role"), F.lit(c).alias("column"), F.col(c).cast("string").isNotNull().alias("has")) for r, cs in picked.items() for c in cs
    ])
    cells = rows.select(F.explode(long).alias("c")).select("c.*")
    return cells.groupBy("role", "column").agg(F.count_if("has").alias("n_filled"))


def align_columns_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.gappy_sample(spark, sf)
    train = clean.drop_sparse(rows.where(F.col("sample") == "train").select("sample", "y", "l_discount", "p_size"))
    oot = align_columns(rows.where(F.col("sample") == "OOT"), train)
    return tidy(oot.groupBy("sample", "y").agg(F.count(F.lit(1)).alias("n"), F.avg("l_discount").alias("disc"), F.avg("p_size").alias("size")))


def outlier_trim(spark: SparkSession, sf: str) -> DataFrame:
    kept = clean.trim_outliers(fx.regression_sample(spark, sf), "y")
    return tidy(kept.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("low"), F.max("y").alias("high"), F.avg("y").alias("mean")))


def outlier_trim_sets(spark: SparkSession, sf: str) -> DataFrame:
    kept = clean.trim_eval_sets(fx.regression_sample(spark, sf), "y")
    return tidy(kept.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("low"), F.max("y").alias("high"), F.avg("y").alias("mean")))


def type_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.gappy_sample(spark, sf)
    return clean.type_profile(rows, ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "p_size", "y"])


def compact_types(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "p_size", "y"]
    compact = clean.compact_types(fx.gappy_sample(spark, sf).select(*columns), columns, replace_missing=True)
    return compact.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty"), F.sum(F.col("p_size").cast("bigint")).alias("size")
    ).select(F.col("y").cast("int").alias("y"), "n", "qty", "size")


def null_flags(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(clean.null_flags(fx.mart_with_gaps(spark, sf).select("epk_id", "report_dt", "qty_amt", "disc_avg"), ["qty_amt", "disc_avg"]))


def export_clean(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.mart_with_gaps(spark, sf).select(
        "epk_id", "report_dt", "qty_amt", "disc_avg", F.when(F.col("prio_cd") == "5-LOW", "null").otherwise(F.col("prio_cd")).alias("prio_cd")
    )
    return tidy(clean.export_clean(rows.withColumn("disc_avg", F.nanvl("disc_avg", F.lit(None).cast("double"))), ["qty_amt", "disc_avg"], ["prio_cd"]))


def tokenise(spark: SparkSession, sf: str) -> DataFrame:
    return encode.tokens(fx.gappy_sample(spark, sf), "p_brand")


def targets_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.targets_wide(spark, sf)
    wide = promote_new(wide.drop(*drop_matching(wide.columns, ["gld", "oi", "pp", "sale_month", "lag_t"], ["mapp"])))
    return targets.long_targets([wide], ["client_dk", "report_dt", "dc"], "dc")


def pair_list(spark: SparkSession, sf: str) -> DataFrame:
    return targets.pair_list(fx.pair_matrix(spark, sf))


def resume_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.mart(spark, sf).groupBy("epk_id").agg(F.count(F.lit(1)).alias("n_months"), F.max("bal_amt").alias("bal_amt"))
    return tidy(encode.pending_rows(rows, rows.where(fx.VALID_CLIENT), "epk_id"))


def feature_target_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = mart.join_targets(fx.client_features(spark, sf), targets_long(spark, sf), "client_dk", first_t=1)
    return tidy(joined.select("client_dk", "Product", "T", "TRG", "dc", "ord_qty", "spend_amt"))


def join_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return mart.join_coverage(fx.client_features(spark, sf), targets_long(spark, sf), "client_dk")


def sample_stats(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profile.sample_stats(fx.binary_sample(spark, sf), "y"))


def target_stats(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profile.target_stats(fx.regression_sample(spark, sf), "y"))


def target_stats_log(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.regression_sample(spark, sf)
    low = rows.agg(F.min("y").alias("low")).scalar()
    return tidy(profile.target_stats(rows.select("sample", log_target(F.col("y"), low).alias("y")), "y"))


def variable_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.gappy_sample(spark, sf).where(F.col("sample") == "train")
    return tidy(profile.variable_profile(rows, fx.NUMERIC, ["p_brand"]))


def variable_types(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.binary_sample(spark, sf)
    return profile.variable_types(rows, "y", fx.NUMERIC, categorical_columns(rows, excluded=["sample", "l_returnflag"]))


def category_values(spark: SparkSession, sf: str) -> DataFrame:
    values = profile.category_values(fx.gappy_sample(spark, sf), ["p_brand", "l_returnflag"])
    return profile.big_categories(values, limit=10)


def mean_interval(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(regression.mean_interval(fx.regression_sample(spark, sf), ["sample"], "y"), 3)


def category_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return encode.fit_dictionary(fx.gappy_sample(spark, sf).where(F.col("sample") == "train"), ["p_brand", "l_returnflag"])


def encode_query(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary from the early part of the mart, applied to all of it."""
    rows = fx.mart_with_gaps(spark, sf).withColumn("seg_cd", F.nullif("seg_cd", F.lit("BUILDING")))
    fitted = encode.fit_dictionary(rows.where((F.col("report_dt") < "1998-01-01") & (F.col("seg_cd") != "MACHINERY")), ["prio_cd", "seg_cd"])
    return encode.encode(rows.select("epk_id", "report_dt", "prio_cd", "seg_cd"), fitted, ["prio_cd", "seg_cd"])


def global_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.mart(spark, sf)
    return encode.fit_global_dictionary([rows.where(F.col("report_dt") < "1998-01-01"), rows.where(F.col("report_dt") >= "1998-01-01")], ["prio_cd", "seg_cd"])


def encode_normalised(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.mart(spark, sf)
    fitted = encode.fit_global_dictionary([rows], ["prio_cd"])
    return encode.encode(rows.select("epk_id", "report_dt", "prio_cd"), fitted, ["prio_cd"], normalise=True)


def log_target_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.regression_sample(spark, sf)
    low = rows.agg(F.min("y").alias("low")).scalar()
    logged = rows.select("o_orderkey", "y", log_target(F.col("y"), low, 0.5).alias("z"))
    return tidy(logged.withColumn("back", F.round(unlog_target(F.col("z"), low, 0.5), 2)))


def product_code(spark: SparkSession, sf: str) -> DataFrame:
    """Targets of one product picked by its dictionary code."""
    rows = targets_long(spark, sf)
    fitted = encode.fit_dictionary(rows, ["Product"])
    encoded = encode.encode(rows, fitted, ["Product"])
    return encoded.where(F.col("Product") == encode.code_of(fitted, "Product", "purchase")).groupBy("Product", "T").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TRG").cast("bigint").alias("events")
    )


QUERIES = {
    "mart_slice": mart_slice,
    "latest_month": latest_month,
    "freshness_gate": freshness_gate,
    "text_normalise": text_normalise,
    "expr_projection": expr_projection,
    "constant_columns": constant_columns,
    "null_share_columns": null_share_columns,
    "role_columns": role_columns,
    "align_columns": align_columns_query,
    "outlier_trim": outlier_trim,
    "outlier_trim_sets": outlier_trim_sets,
    "type_profile": type_profile,
    "compact_types": compact_types,
    "null_flags": null_flags,
    "export_clean": export_clean,
    "tokenise": tokenise,
    "targets_long": targets_long,
    "pair_list": pair_list,
    "resume_anti_join": resume_anti_join,
    "feature_target_join": feature_target_join,
    "join_coverage": join_coverage,
    "sample_stats": sample_stats,
    "target_stats": target_stats,
    "target_stats_log": target_stats_log,
    "variable_profile": variable_profile,
    "variable_types": variable_types,
    "category_values": category_values,
    "mean_interval": mean_interval,
    "category_dictionary": category_dictionary,
    "encode": encode_query,
    "global_dictionary": global_dictionary,
    "encode_normalised": encode_normalised,
    "log_target": log_target_query,
    "product_code": product_code,
}

_STATS = """count(y) AS n_obs, avg(y) AS mean, stddev_pop(y) AS std_pop, stddev_samp(y) AS std_samp, min(y) AS "min",
  quantile_cont(y, 0.25::DOUBLE) AS p25, quantile_cont(y, 0.5::DOUBLE) AS p50, quantile_cont(y, 0.75::DOUBLE) AS p75, max(y) AS "max\""""
_STAT_COLUMNS = ("mean", "std_pop", "std_samp", "min", "p25", "p50", "p75", "max")
_TRIMMED = "count(*) AS n, min(y) AS low, max(y) AS high, avg(y) AS mean"
_INSIDE = "y > (SELECT quantile_cont(y, 0.01::DOUBLE) FROM {s}) AND y < (SELECT quantile_cont(y, 0.99::DOUBLE) FROM {s})"


def _profile_sql() -> str:
    numeric = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS n_filled, count({c}) / CAST(count(*) AS DOUBLE) AS share_filled,
        count(DISTINCT {c}) + CAST(count(*) > count({c}) AS BIGINT) AS n_unique, avg({c}) AS mean, stddev_samp({c}) AS std,
        CAST(min({c}) AS DOUBLE) AS "min", quantile_cont(CAST({c} AS DOUBLE), 0.25::DOUBLE) AS p25,
        quantile_cont(CAST({c} AS DOUBLE), 0.5::DOUBLE) AS p50, quantile_cont(CAST({c} AS DOUBLE), 0.75::DOUBLE) AS p75,
        CAST(max({c}) AS DOUBLE) AS "max" FROM part_rows"""
        for c in fx.NUMERIC
    )
    text = """SELECT 'p_brand', count(p_brand), count(p_brand) / CAST(count(*) AS DOUBLE),
        count(DISTINCT p_brand) + CAST(count(*) > count(p_brand) AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part_rows"""
    return rounded_sql(
        f"{with_sql('gappy')}, part_rows AS (SELECT * FROM gappy WHERE sample = 'train') {numeric} UNION ALL {text}",
        "share_filled", "mean", "std", "min", "p25", "p50", "p75", "max",
    )


def _types_sql() -> str:
    def one(c: str) -> str:
        v = f"CAST({c} AS DOUBLE)"
        return f"""SELECT '{c}' AS "column", min({v}) AS "min", max({v}) AS "max", bool_or({c} IS NULL) AS has_null,
            bool_and({c} IS NOT NULL) AND sum(abs({v} - trunc({v}))) < 0.01 AS integerable FROM gappy"""

    rows = " UNION ALL ".join(one(c) for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "p_size", "y"))
    return f"""{with_sql("gappy")} SELECT *, CASE WHEN NOT integerable THEN 'float32' WHEN "min" >= 0 AND "max" <= 255 THEN 'uint8'
        WHEN "min" >= 0 AND "max" <= 65535 THEN 'uint16' WHEN "min" >= 0 AND "max" <= 4294967295 THEN 'uint32' ELSE 'uint64' END AS type
        FROM ({rows})"""


ORACLE = {
    "mart_slice": _slice_sql(),
    "latest_month": f"{with_sql('mart')} SELECT max(report_dt) AS latest_month FROM mart",
    "freshness_gate": f"""{with_sql('mart')} SELECT max(report_dt) AS latest_month, DATE '2001-08-31' AS due_month,
        max(report_dt) = DATE '2001-08-31' AS is_fresh FROM mart""",
    "text_normalise": f"""{with_sql('mart')} SELECT epk_id, report_dt, lower(replace(prio_cd, ' ', '')) AS prio_cd, lower(seg_cd) AS seg_cd,
        replace(replace(replace(prio_cd, 'NOT ', 'UN'), 'UNSPEC', 'spec'), '-', '_') AS prio_text FROM mart""",
    "expr_projection": rounded_sql(
        f"""{with_sql('mart')} SELECT epk_id, report_dt, qty_amt / ord_qty AS avg_qty, seg_cd AS seg_new,
        CAST(report_dt AS VARCHAR) AS month_text FROM mart""", "avg_qty"),
    "constant_columns": _levels_sql("d + CAST(nulls > 0 AS INT) < 2 AS is_constant"),
    "null_share_columns": rounded_sql(_levels_sql("nulls / CAST(n AS DOUBLE) AS null_share, nulls / CAST(n AS DOUBLE) > 0.5 AS dropped"), "null_share"),
    "role_columns": f"""{with_sql('binary')} SELECT role, "column", n_filled FROM (SELECT count(*) AS n_filled FROM bin_sample) CROSS JOIN (
        SELECT 'numeric' AS role, unnest(['l_quantity','l_extendedprice','l_discount','l_tax','p_retailprice','T','score']) AS "column"
        UNION ALL SELECT 'categorical', unnest(['p_brand','p_size']))""",
    "align_columns": rounded_sql(
        f"{with_sql('gappy')} SELECT sample, y, count(*) AS n, avg(l_discount) AS disc, avg(p_size) AS size FROM gappy WHERE sample = 'OOT' GROUP BY ALL", "disc", "size"),
    "outlier_trim": rounded_sql(
        f"{with_sql('regression')} SELECT sample, {_TRIMMED} FROM reg_sample WHERE {_INSIDE.format(s='reg_sample')} GROUP BY 1", "low", "high", "mean"),
    "outlier_trim_sets": rounded_sql(
        f"""{with_sql('regression')}, edges AS (SELECT sample, quantile_cont(y, 0.01::DOUBLE) AS e1, quantile_cont(y, 0.99::DOUBLE) AS e2 FROM reg_sample GROUP BY 1),
        marked AS (SELECT r.*, y > e1 AND y < e2 AS inside FROM reg_sample r JOIN edges USING (sample))
        SELECT sample, {_TRIMMED} FROM marked WHERE inside OR sample NOT IN ('train', 'valid') GROUP BY 1
        UNION ALL SELECT 'test2', {_TRIMMED} FROM marked WHERE inside AND sample = 'test'""", "low", "high", "mean"),
    "type_profile": _types_sql(),
    "compact_types": f"""{with_sql('gappy')} SELECT y, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty,
        CAST(sum(coalesce(p_size, 0)) AS BIGINT) AS size FROM gappy GROUP BY 1""",
    "null_flags": rounded_sql(
        f"""{with_sql('gaps')} SELECT epk_id, report_dt, coalesce(qty_amt, 0) AS qty_amt, coalesce(disc_avg, 0) AS disc_avg,
        qty_amt IS NULL AS qty_amt_null_flag, disc_avg IS NULL AS disc_avg_null_flag FROM gaps""", "qty_amt", "disc_avg"),
    "export_clean": rounded_sql(
        f"""{with_sql('gaps')} SELECT epk_id, report_dt, CAST(qty_amt AS BIGINT) AS qty_amt, disc_avg,
        CASE WHEN prio_cd <> '5-LOW' THEN prio_cd END AS prio_cd FROM gaps""", "disc_avg"),
    "tokenise": f"""{with_sql('gappy')} SELECT p_brand AS value, CASE WHEN p_brand IS NULL THEN -1
        ELSE dense_rank() OVER (ORDER BY p_brand NULLS LAST) - 1 END AS token FROM (SELECT DISTINCT p_brand FROM gappy)""",
    "targets_long": f"{with_sql('targets_long')} SELECT * FROM targets_long",
    "pair_list": f"""{with_sql('matrix')}, pairs AS (
        SELECT BP AS bp, sp, CAST(priority AS INT) AS priority FROM (UNPIVOT matrix ON click, error, purchase, signup, "view" INTO NAME sp VALUE cell)
        WHERE cell > 0 AND priority > 0)
        SELECT bp, sp, priority, CAST(row_number() OVER w AS INT) AS place, round(100 * row_number() OVER w / CAST(count(*) OVER () AS DOUBLE), 2) AS done_percent
        FROM pairs WINDOW w AS (ORDER BY priority, bp, sp)""",
    "resume_anti_join": rounded_sql(
        f"{with_sql('mart')} SELECT epk_id, count(*) AS n_months, max(bal_amt) AS bal_amt FROM mart GROUP BY 1 HAVING NOT max(bal_amt) > 0", "bal_amt"),
    "feature_target_join": rounded_sql(
        f"""{with_sql('client_features', 'targets_long')} SELECT t.client_dk, t.Product, t.T, t.TRG, t.dc, f.ord_qty, f.spend_amt
        FROM client_features f JOIN targets_long t ON f.client_dk = t.client_dk AND year(f.report_dt) = year(t.report_dt)
        AND month(f.report_dt) = month(t.report_dt) WHERE t.T >= 1""", "spend_amt"),
    "join_coverage": f"""{with_sql('client_features', 'targets_long')} SELECT
        (SELECT count(DISTINCT client_dk) FROM client_features) AS n_features, (SELECT count(DISTINCT client_dk) FROM targets_long) AS n_targets,
        (SELECT count(DISTINCT client_dk) FROM client_features JOIN targets_long USING (client_dk)) AS n_joined""",
    "sample_stats": rounded_sql(
        f"{with_sql('binary')} SELECT sample, count(*) AS n_obs, CAST(sum(y) AS BIGINT) AS n_events, avg(y) AS eventrate FROM bin_sample GROUP BY 1", "eventrate"),
    "target_stats": rounded_sql(f"{with_sql('regression')} SELECT sample, {_STATS} FROM reg_sample GROUP BY 1", *_STAT_COLUMNS),
    "target_stats_log": rounded_sql(
        f"""{with_sql('regression')} SELECT sample, {_STATS} FROM (SELECT sample, ln(y - (SELECT min(y) FROM reg_sample) + 1) AS y FROM reg_sample) GROUP BY 1""", *_STAT_COLUMNS),
    "variable_profile": _profile_sql(),
    "variable_types": f"""{with_sql('binary')} SELECT 'y' AS target, CAST(count(p_brand) > 0 AS INT) AS n_categorical,
        {" + ".join(f"CAST(count({c}) > 0 AS INT)" for c in fx.NUMERIC)} AS n_numeric, count(y) AS n_labelled FROM bin_sample""",
    "category_values": f"""{with_sql('gappy')} SELECT 'p_brand' AS feature, count(DISTINCT p_brand) AS n_values, count(DISTINCT p_brand) > 10 AS suspicious FROM gappy
        UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag), count(DISTINCT l_returnflag) > 10 FROM gappy""",
    "mean_interval": rounded_sql(
        # 1.959963985 is the normal quantile; the expansion in 1/n is written out to the second order.
        f"""{with_sql('regression')} SELECT sample, n, mean, mean - t * sd / sqrt(n) AS lower, mean + t * sd / sqrt(n) AS upper FROM (
        SELECT *, z + (z**3 + z) / (4 * n) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * n * n) + (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / (384 * n**3) AS t
        FROM (SELECT sample, count(*) AS n, avg(y) AS mean, stddev_samp(y) AS sd, 1.959963984540054::DOUBLE AS z FROM reg_sample GROUP BY 1))""",
        "mean", "lower", "upper", digits=3),
    "category_dictionary": f"""{with_sql('gappy')} SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS code FROM (
        SELECT DISTINCT 'p_brand' AS feature, coalesce(p_brand, 'NA') AS value FROM gappy WHERE sample = 'train'
        UNION SELECT DISTINCT 'l_returnflag', l_returnflag FROM gappy WHERE sample = 'train')""",
    "encode": f"""{with_sql('gaps')}, marked AS (SELECT epk_id, report_dt, prio_cd, nullif(seg_cd, 'BUILDING') AS seg_cd FROM gaps),
        early AS (SELECT * FROM marked WHERE report_dt < DATE '1998-01-01' AND seg_cd <> 'MACHINERY'),
        p AS (SELECT prio_cd AS v, row_number() OVER (ORDER BY prio_cd) - 1 AS code FROM (SELECT DISTINCT prio_cd FROM early)),
        s AS (SELECT seg_cd AS v, row_number() OVER (ORDER BY seg_cd) - 1 AS code FROM (SELECT DISTINCT seg_cd FROM early))
        SELECT epk_id, report_dt, coalesce(p.code, 0) AS prio_cd, coalesce(s.code, 0) AS seg_cd
        FROM marked m LEFT JOIN p ON m.prio_cd = p.v LEFT JOIN s ON m.seg_cd = s.v""",
    "global_dictionary": f"""{with_sql('mart')}, vals AS (
        SELECT 'prio_cd' AS feature, prio_cd AS value FROM mart UNION SELECT 'seg_cd', seg_cd FROM mart
        UNION SELECT 'prio_cd', lower(replace(prio_cd, ' ', '')) FROM mart WHERE contains(prio_cd, ' ')
        UNION SELECT 'seg_cd', lower(replace(seg_cd, ' ', '')) FROM mart WHERE contains(seg_cd, ' ')
        UNION SELECT f, v FROM (SELECT unnest(['prio_cd', 'seg_cd']) AS f) CROSS JOIN (SELECT unnest(['NA', '', ' ']) AS v))
        SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS code FROM vals""",
    "encode_normalised": f"""{with_sql('mart')}, vals AS (
        SELECT DISTINCT prio_cd AS value FROM mart UNION SELECT lower(replace(prio_cd, ' ', '')) FROM mart WHERE contains(prio_cd, ' ')
        UNION SELECT unnest(['NA', '', ' '])),
        d AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM vals)
        SELECT epk_id, report_dt, coalesce(d.code, (SELECT code FROM d WHERE value = 'NA')) AS prio_cd
        FROM mart LEFT JOIN d ON lower(replace(prio_cd, ' ', '')) = d.value""",
    "log_target": rounded_sql(
        f"{with_sql('regression')} SELECT o_orderkey, y, ln(y - (SELECT min(y) FROM reg_sample) + 1.5) AS z, round(y, 2) AS back FROM reg_sample", "y", "z", "back"),
    "product_code": f"""{with_sql('targets_long')}, codes AS (SELECT Product, row_number() OVER (ORDER BY Product) - 1 AS code FROM (SELECT DISTINCT Product FROM targets_long))
        SELECT c.code AS Product, T, count(*) AS n, CAST(sum(TRG) AS BIGINT) AS events FROM targets_long JOIN codes c USING (Product) WHERE Product = 'purchase' GROUP BY ALL""",
}
