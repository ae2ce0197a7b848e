"""Registered queries on inputs with gaps: null keys, empty variables and groups, unseen and many values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.operators import encode, profile, ranks, scoring, targets
from valuekit.plans import fixtures as fx
from valuekit.plans import mart_queries
from valuekit.plans.fixtures import rounded_sql, tidy, with_sql
from valuekit.roles import drop_matching, promote_new


def running_totals_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Totals below each quantity per flag, one flag missing, in one range and in three."""
    lines = fx.table(spark, sf, "lineitem").select(F.nullif("l_returnflag", F.lit("R")).alias("flag"), F.col("l_quantity").alias("quantity"))
    measures = {"n": F.count(F.lit(1))}
    paths = {"one": [], "ranged": [10.5, 30.5]}
    one, ranged = (ranks.running_totals(lines, ["flag"], "quantity", measures, totals=True, cuts=c).withColumn("path", F.lit(p)) for p, c in paths.items())
    return tidy(one.unionByName(ranged))


def encode_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary as large as the table: customers' and orders' keys as text, fitted on finished orders."""
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderkey").cast("string").alias("order_text"), F.col("o_custkey").cast("string").alias("cust_text"))
    fitted = encode.fit_dictionary(orders.where("o_orderstatus = 'F'"), ["order_text", "cust_text"])
    return encode.encode(orders, fitted, ["order_text", "cust_text"]).drop("o_orderstatus")


def targets_union(spark: SparkSession, sf: str) -> DataFrame:
    """Long targets of two target tables that share the clients between them."""
    wide = fx.targets_wide(spark, sf)
    wide = promote_new(wide.drop(*drop_matching(wide.columns, ["gld", "oi", "pp", "sale_month", "lag_t"], ["mapp"])))
    first = F.pmod("client_dk", F.lit(2)) == 0
    return targets.long_targets([wide.where(first), wide.where(~first)], ["client_dk", "report_dt", "dc"], "dc")


def profile_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A numeric and a text variable without any value stay in the profile."""
    lines = fx.table(spark, sf, "lineitem").select("l_quantity", F.lit(None).cast("double").alias("no_number"), "l_returnflag", F.lit(None).cast("string").alias("no_text"))
    got = profile.variable_profile(lines, ["l_quantity", "no_number"], ["l_returnflag", "no_text"])
    return tidy(got.select("feature", "n_filled", "share_filled", "n_unique", "min", "max"))


def target_stats_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """A sample without targets and rows without a sample are listed."""
    rows = fx.regression_sample(spark, sf)
    gaps = rows.select(F.nullif("sample", F.lit("test")).alias("sample"), F.when(F.col("sample") != "valid", F.col("y")).alias("y"))
    return tidy(profile.target_stats(gaps, "y"))


def pair_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Period windows of the wanted pairs; pairs outside the configuration get the global window."""
    wanted = targets.pair_list(fx.pair_matrix(spark, sf))
    return scoring.pair_windows(wanted, fx.pair_periods(spark, sf).where("T_max >= 9"), scoring.Window(0, 12))


_STATS = """count(y) AS n_obs, avg(y) AS mean, stddev_pop(y) AS std_pop, stddev_samp(y) AS std_samp, min(y) AS "min",
  quantile_cont(y, 0.25::DOUBLE) AS p25, quantile_cont(y, 0.5::DOUBLE) AS p50, quantile_cont(y, 0.75::DOUBLE) AS p75, max(y) AS "max\""""

QUERIES = {
    "running_totals_null_keys": running_totals_null_keys,
    "encode_wide": encode_wide,
    "targets_union": targets_union,
    "profile_empty": profile_empty,
    "target_stats_gaps": target_stats_gaps,
    "pair_windows": pair_windows,
}

ORACLE = {
    "running_totals_null_keys": """WITH l AS (SELECT nullif(l_returnflag, 'R') AS flag, l_quantity AS quantity, count(*) AS n FROM lineitem GROUP BY 1, 2),
        t AS (SELECT flag, quantity, n, sum(n) OVER (PARTITION BY flag ORDER BY quantity) - n AS n_below, sum(n) OVER (PARTITION BY flag) AS n_all FROM l)
        SELECT flag, quantity, n, CAST(n_below AS BIGINT) AS n_below, CAST(n_all AS BIGINT) AS n_all, path FROM t, (VALUES ('one'), ('ranged')) p(path)""",
    "encode_wide": """WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderkey AS VARCHAR) AS a, CAST(o_custkey AS VARCHAR) AS b FROM orders),
        ca AS (SELECT a, row_number() OVER (ORDER BY a) - 1 AS code FROM (SELECT DISTINCT a FROM o WHERE o_orderstatus = 'F')),
        cb AS (SELECT b, row_number() OVER (ORDER BY b) - 1 AS code FROM (SELECT DISTINCT b FROM o WHERE o_orderstatus = 'F'))
        SELECT o_orderkey, coalesce(ca.code, 0) AS order_text, coalesce(cb.code, 0) AS cust_text FROM o LEFT JOIN ca USING (a) LEFT JOIN cb USING (b)""",
    "targets_union": mart_queries.ORACLE["targets_long"],
    "profile_empty": rounded_sql(
        """SELECT 'l_quantity' AS feature, count(l_quantity) AS n_filled, count(l_quantity) / CAST(count(*) AS DOUBLE) AS share_filled, count(DISTINCT l_quantity) AS n_unique,
        CAST(min(l_quantity) AS DOUBLE) AS "min", CAST(max(l_quantity) AS DOUBLE) AS "max" FROM lineitem
        UNION ALL SELECT 'no_number', 0, 0.0, 1, NULL, NULL
        UNION ALL SELECT 'l_returnflag', count(l_returnflag), count(l_returnflag) / CAST(count(*) AS DOUBLE), count(DISTINCT l_returnflag), NULL, NULL FROM lineitem
        UNION ALL SELECT 'no_text', 0, 0.0, 1, NULL, NULL""",
        "share_filled", "min", "max"),
    "target_stats_gaps": rounded_sql(
        f"""{with_sql('regression')} SELECT sample, {_STATS} FROM (SELECT nullif(sample, 'test') AS sample, CASE WHEN sample <> 'valid' THEN y END AS y FROM reg_sample) GROUP BY 1""",
        "mean", "std_pop", "std_samp", "min", "p25", "p50", "p75", "max"),
    "pair_windows": f"""{with_sql('matrix')}, wanted AS (
        SELECT BP AS bp, sp FROM (UNPIVOT matrix ON click, error, purchase, signup, "view" INTO NAME sp VALUE cell) WHERE cell > 0 AND CAST(priority AS INT) > 0),
        p AS (SELECT lower(c_mktsegment) AS bp, event_type AS sp, CAST(count(*) % 3 AS INT) AS lo, CAST(6 + count(*) % 7 AS INT) AS hi
              FROM events JOIN customer ON c_custkey = user_id GROUP BY ALL HAVING 6 + count(*) % 7 >= 9)
        SELECT w.bp, w.sp, coalesce(p.lo, 0) AS T_min, coalesce(p.hi, 12) AS T_max FROM wanted w LEFT JOIN p USING (bp, sp)""",
}
