"""Input frames of the registered queries, derived from the test tables.

Each frame stands for one input of a real run (mart, wide targets, predictions, pair matrix ...).
`SQL` holds the same definitions as common table expressions for the SQL twins.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.functions.columns import month_list
from valuekit.roles import Roles

SLICE_DATE = date(2001, 6, 30)
VALID_CLIENT = "bal_amt > 0"
NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice")
LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
LINE_ROLES = Roles(id=LINE_KEY, target="y", numeric=NUMERIC, categorical=("p_brand",), drop=("l_returnflag",))
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENT_DAYS = 30
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
MODELS = ("dc1_dc", "cc2_cc", "pl_mb", "EL11_pl", "sf_ph")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, read as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns so that two engines can be compared; a negative zero becomes zero."""
    floating = {c for c, t in df.dtypes if t in ("double", "float")}
    return df.selectExpr(*[f"round(`{c}`, {digits}) + 0.0D AS `{c}`" if c in floating else f"`{c}`" for c in df.columns])


def _year_sample(year: Column) -> Column:
    return F.when(year <= 1998, "train").when(year == 1999, "valid").when(year == 2000, "test").otherwise("OOT")


def mart(spark: SparkSession, sf_dir: str, months: list[date] | None = None) -> DataFrame:
    """One row per client and month end. `months` limits the orders read to those months."""
    orders = table(spark, sf_dir, "orders")
    if months:
        first, after = min(months).replace(day=1), date(max(months).year + max(months).month // 12, max(months).month % 12 + 1, 1)
        orders = orders.where((F.col("o_orderdate") >= F.lit(first)) & (F.col("o_orderdate") < F.lit(after)))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
    # Per order first: the join already placed its lines together, so only order rows move on.
    per_order = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(
            "o_orderkey",
            F.col("o_custkey").alias("epk_id"),
            F.last_day("o_orderdate").alias("report_dt"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("prio"),
        )
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.sum("l_extendedprice").alias("spend"),
            F.sum("l_discount").alias("disc"),
            F.count("l_discount").alias("n_lines"),
        )
    )
    monthly = per_order.groupBy("epk_id", "report_dt").agg(
        F.count(F.lit(1)).alias("ord_qty"),
        F.sum("qty").alias("qty_amt"),
        F.sum("spend").alias("spend_amt"),
        (F.sum("disc") / F.sum("n_lines")).alias("disc_avg"),
        F.min("prio").alias("prio"),
    )
    clients = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("epk_id"), F.col("c_mktsegment").alias("seg_cd"), F.col("c_acctbal").alias("bal_amt")
    )
    return monthly.join(clients, "epk_id").select(
        "epk_id",
        "report_dt",
        "ord_qty",
        "qty_amt",
        "spend_amt",
        "disc_avg",
        F.element_at(F.lit(list(PRIORITIES)), F.col("prio")).alias("prio_cd"),
        "seg_cd",
        "bal_amt",
    )


def slice_months(horizon: int = 12) -> list[date]:
    return month_list(SLICE_DATE, horizon)


def mart_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart with missing values and a constant column, for the cleaning operators."""
    return mart(spark, sf_dir).select(
        "epk_id",
        "report_dt",
        "prio_cd",
        "seg_cd",
        F.nullif("ord_qty", F.lit(1)).alias("ord_qty"),
        F.when(F.col("qty_amt") >= 100, F.col("qty_amt")).alias("qty_amt"),
        F.when(F.col("disc_avg") <= 0.0512345, F.col("disc_avg")).otherwise(F.lit(float("nan"))).alias("disc_avg"),
        F.lit(7).alias("one_value"),
        F.when(F.col("bal_amt") > 0, 1).alias("one_or_null"),
    )


def client_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each client's row of their last mart month."""
    rows = mart(spark, sf_dir)
    last = rows.groupBy("epk_id").agg(F.max("report_dt").alias("report_dt"))
    return rows.join(last, ["epk_id", "report_dt"]).withColumnRenamed("epk_id", "client_dk")


def targets_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per client with `<event>_t<day>` counts, null after the client's last event.

    Carries noise and `_new` columns, as the raw tables do. An event outside the layout of EVENT_TYPES and
    EVENT_DAYS is an error.
    """
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("client_dk"), "event_type", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("day")
    )
    names = [f"{e}_t{d}" for e in EVENT_TYPES for d in range(EVENT_DAYS)]
    name = F.concat("event_type", F.lit("_t"), F.col("day").cast("string"))
    outside = F.raise_error(F.concat(F.lit("event outside the layout of targets_wide: "), F.coalesce(name, F.lit("null"))))
    named = events.withColumn("name", F.when(name.isin(names), name).otherwise(outside))
    counts = named.groupBy("client_dk").pivot("name", names).agg(F.count(F.lit(1)))
    last = events.groupBy("client_dk").agg(F.max("day").alias("last_day"))
    reported = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "lineitem").select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .groupBy(F.col("o_custkey").alias("client_dk"))
        .agg(F.last_day(F.max("o_orderdate")).alias("report_dt"))
    )
    clients = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("client_dk"), F.col("c_mktsegment").alias("dc_new"))
    wide = counts.join(last, "client_dk").join(reported, "client_dk").join(clients, "client_dk")
    kept = [f"IF(last_day >= {n.rsplit('_t', 1)[1]}, coalesce({n}, 0), NULL) AS {n}" for n in names]
    return wide.selectExpr("client_dk", "report_dt", "'old' AS dc", "dc_new", "1 AS gld_flag", "0 AS sale_month", *kept)


def binary_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with features, label, sample, period and a fixed-formula score."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        *LINE_KEY,
        "l_returnflag",
        *NUMERIC,
        "p_brand",
        _year_sample(F.year("l_shipdate")).alias("sample"),
        (F.month("l_shipdate") - 1).alias("T"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (0.5 + (0.02 * F.col("l_quantity") - 8 * F.col("l_discount")) / 4).alias("score"),
    )


def gappy_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The binary sample with missing numbers and categories."""
    return binary_sample(spark, sf_dir).withColumns({
        "l_discount": F.nullif("l_discount", F.lit(0.0)),
        "p_size": F.nullif("p_size", F.lit(50)),
        "p_brand": F.nullif("p_brand", F.lit("Brand#3")),
    })


def document_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic", F.when(F.col("n_chars") >= 3000, "OOT").otherwise("train").alias("sample")
    )


def document_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, labelled or not, as short (train) or long (OOT)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.withColumn("sample", F.when(F.col("n_chars") >= 3000, "OOT").otherwise("train"))


def regression_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with total price as target and the net line total as prediction.

    Net totals have four exact decimals; the small shift keeps halves from rounding either way.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("y_pred"),
        F.sum("l_quantity").alias("qty"),
        F.count(F.lit(1)).cast("double").alias("n_lines"),
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        "o_orderkey",
        F.col("o_totalprice").alias("y"),
        F.round(F.col("y_pred") + 0.000013, 2).alias("y_pred"),
        "qty",
        "n_lines",
        _year_sample(F.year("o_orderdate")).alias("sample"),
    )


def calibration_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_sample(spark, sf_dir).select(
        "sample", F.col("y").alias("y_true"), F.col("score").alias("y_pred"), (0.9 * F.col("score") + 0.02).alias("y_calib")
    )


def treatment_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with arm `cc`, period T and whether any line came back."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("y"), F.sum("l_quantity").alias("qty_amt"), F.avg("l_discount").alias("disc_avg")
    )
    orders = table(spark, sf_dir, "orders")
    months = F.floor(F.months_between(F.trunc("o_orderdate", "month"), F.lit("1995-01-01").cast("date")))
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").cast("int").alias("cc"),
        F.pmod(months, F.lit(13)).cast("int").alias("T"),
        "y",
        F.col("o_totalprice").alias("total_amt"),
        "qty_amt",
        "disc_avg",
        _year_sample(F.year("o_orderdate")).alias("sample"),
    )


def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long frame of several fixed-formula models over the binary sample."""
    rows = binary_sample(spark, sf_dir)
    scores = {
        "dc1_dc": F.col("score"),
        "cc2_cc": 1 / (1 + F.col("l_quantity")),
        "pl_mb": F.col("l_discount") * 5 + 0.1,
        "EL11_pl": F.col("p_size") / 51.0,
        "sf_ph": (F.col("y") + F.col("l_discount")) / 1.2,
    }
    entries = F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in scores.items()])
    return rows.select(*LINE_KEY, *NUMERIC, "sample", "T", "y", F.explode(entries).alias("m")).select(
        *LINE_KEY, *NUMERIC, "sample", "T", "y", "m.model", "m.score"
    )


def model_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, feature, importance): 100 * |corr(score, feature)|, with one feature per model
    named after its base product and one with a trailing-mean name."""
    names = {"l_quantity": "qty_amt", "l_discount": "disc_avg_3a", "p_size": "size_qty", "l_extendedprice": "spend_amt"}
    wide = model_predictions(spark, sf_dir).groupBy("model").agg(
        *[(100 * F.abs(F.corr("score", c))).alias(n) for c, n in names.items()], (100 * F.abs(F.corr("score", "l_tax"))).alias("own")
    )
    long = wide.unpivot(["model"], [*names.values(), "own"], "feature", "importance")
    named = F.when(F.col("feature") == "own", F.substring_index("model", "_", 1)).otherwise(F.col("feature"))
    # Each model keeps only what its score depends on; weak entries are noise.
    return long.select("model", named.alias("feature"), F.round("importance", 6).alias("importance")).where(
        (F.col("importance") > 5) | (F.col("feature") == F.substring_index("model", "_", 1))
    )


def pair_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base product by sold product matrix with a priority, from the events of each segment."""
    clients = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.lower("c_mktsegment").alias("BP"))
    events = table(spark, sf_dir, "events").join(clients, "user_id")
    return events.groupBy("BP").agg(
        (F.count(F.lit(1)) % 4).alias("priority"), *[(F.count_if(F.col("event_type") == e) % 3).alias(e) for e in EVENT_TYPES]
    )


def pair_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period window per pair."""
    clients = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.lower("c_mktsegment").alias("bp"))
    events = table(spark, sf_dir, "events").join(clients, "user_id")
    n = F.count(F.lit(1))
    return events.groupBy("bp", F.col("event_type").alias("sp")).agg((n % 3).alias("T_min"), (6 + n % 7).alias("T_max"))


# ---------------------------------------------------------------------------------------------
# The same definitions for the SQL twins.

_YEAR_SAMPLE = "CASE WHEN year({d}) <= 1998 THEN 'train' WHEN year({d}) = 1999 THEN 'valid' WHEN year({d}) = 2000 THEN 'test' ELSE 'OOT' END"

SQL: dict[str, str] = {
    "mart": """mart AS (
  SELECT o_custkey AS epk_id, last_day(CAST(o_orderdate AS DATE)) AS report_dt,
         CAST(count(DISTINCT o_orderkey) AS BIGINT) AS ord_qty, sum(l_quantity) AS qty_amt, sum(l_extendedprice) AS spend_amt,
         avg(l_discount) AS disc_avg, min(o_orderpriority) AS prio_cd, min(c_mktsegment) AS seg_cd, min(c_acctbal) AS bal_amt
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2)""",
    "gaps": """gaps AS (
  SELECT epk_id, report_dt, prio_cd, seg_cd, nullif(ord_qty, 1) AS ord_qty,
         CASE WHEN qty_amt >= 100 THEN qty_amt END AS qty_amt,
         CASE WHEN disc_avg <= 0.0512345 THEN disc_avg END AS disc_avg,
         7 AS one_value, CASE WHEN bal_amt > 0 THEN 1 END AS one_or_null
  FROM mart)""",
    "client_features": """client_features AS (
  SELECT epk_id AS client_dk, * EXCLUDE (epk_id) FROM mart
  QUALIFY row_number() OVER (PARTITION BY epk_id ORDER BY report_dt DESC) = 1)""",
    "targets_month": """days AS (
  SELECT user_id AS client_dk, event_type, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day FROM events),
client_span AS (SELECT client_dk, max(day) AS last_day FROM days GROUP BY 1),
reported AS (
  SELECT o_custkey AS client_dk, last_day(CAST(max(o_orderdate) AS DATE)) AS report_dt
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1),
targets_month AS (
  SELECT s.client_dk, r.report_dt, c.c_mktsegment AS segment, e.event_type, CAST(d.day AS INT) AS day,
         CASE WHEN d.day <= s.last_day THEN coalesce(n.n, 0) END AS n
  FROM client_span s JOIN reported r USING (client_dk) JOIN customer c ON c.c_custkey = s.client_dk
  CROSS JOIN (SELECT unnest(['click','error','purchase','signup','view']) AS event_type) e
  CROSS JOIN (SELECT unnest(range(30)) AS day) d
  LEFT JOIN (SELECT client_dk, event_type, day, count(*) AS n FROM days GROUP BY ALL) n
    ON n.client_dk = s.client_dk AND n.event_type = e.event_type AND n.day = d.day)""",
    "targets_long": """targets_long AS (
  SELECT client_dk, report_dt, lower(segment) AS dc,
         CAST(CASE WHEN count(n) < count(*) THEN NULL WHEN sum(n) > 0 THEN 1 ELSE 0 END AS INT) AS TRG,
         event_type AS Product, CAST(CASE WHEN day = 0 THEN 0 ELSE day // 3 + 1 END AS INT) AS T
  FROM targets_month GROUP BY client_dk, report_dt, segment, event_type, CASE WHEN day = 0 THEN 0 ELSE day // 3 + 1 END
  HAVING count(n) = count(*))""",
    "binary": f"""bin_sample AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax,
         p_size, p_retailprice, p_brand, {_YEAR_SAMPLE.format(d="l_shipdate")} AS sample,
         CAST(month(l_shipdate) - 1 AS INT) AS T, CAST(l_returnflag = 'R' AS INT) AS y,
         0.5::DOUBLE + (0.02::DOUBLE * l_quantity - 8 * l_discount) / 4 AS score
  FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "gappy": """gappy AS (
  SELECT * REPLACE (nullif(l_discount, 0.0) AS l_discount, nullif(p_size, 50) AS p_size, nullif(p_brand, 'Brand#3') AS p_brand)
  FROM bin_sample)""",
    "document_parts": "doc_parts AS (SELECT doc_id, lang, source, n_chars, CASE WHEN n_chars >= 3000 THEN 'OOT' ELSE 'train' END AS sample FROM documents)",
    "document": """doc_sample AS (
  SELECT doc_id, lang, source, n_chars, quality, toxic, CASE WHEN n_chars >= 3000 THEN 'OOT' ELSE 'train' END AS sample
  FROM labels JOIN documents USING (doc_id))""",
    "regression": f"""reg_sample AS (
  SELECT o_orderkey, o_totalprice AS y, round(y_pred + 0.000013::DOUBLE, 2) AS y_pred, qty, n_lines, {_YEAR_SAMPLE.format(d="o_orderdate")} AS sample
  FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS y_pred, sum(l_quantity) AS qty,
                           CAST(count(*) AS DOUBLE) AS n_lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)""",
    "calibration": """calib AS (
  SELECT sample, y AS y_true, score AS y_pred, 0.9::DOUBLE * score + 0.02::DOUBLE AS y_calib FROM bin_sample)""",
    "predictions": """predictions AS (
  SELECT l_quantity, l_discount, l_extendedprice, l_tax, p_size, sample, T, y, 'dc1_dc' AS model, score FROM bin_sample
  UNION ALL SELECT l_quantity, l_discount, l_extendedprice, l_tax, p_size, sample, T, y, 'cc2_cc', 1 / (1 + l_quantity) FROM bin_sample
  UNION ALL SELECT l_quantity, l_discount, l_extendedprice, l_tax, p_size, sample, T, y, 'pl_mb', l_discount * 5 + 0.1::DOUBLE FROM bin_sample
  UNION ALL SELECT l_quantity, l_discount, l_extendedprice, l_tax, p_size, sample, T, y, 'EL11_pl', p_size / 51.0::DOUBLE FROM bin_sample
  UNION ALL SELECT l_quantity, l_discount, l_extendedprice, l_tax, p_size, sample, T, y, 'sf_ph', (y + l_discount) / 1.2::DOUBLE FROM bin_sample)""",
    "importance": """importance AS (
  SELECT model, feature, round(v, 6) AS importance FROM (
    SELECT model, unnest(['qty_amt', 'disc_avg_3a', 'size_qty', 'spend_amt', split_part(model, '_', 1)]) AS feature,
           unnest([100 * abs(corr(score, l_quantity)), 100 * abs(corr(score, l_discount)), 100 * abs(corr(score, p_size)),
                   100 * abs(corr(score, l_extendedprice)), 100 * abs(corr(score, l_tax))]) AS v
    FROM predictions GROUP BY model)
  WHERE round(v, 6) > 5 OR feature = split_part(model, '_', 1))""",
    "matrix": """matrix AS (
  SELECT lower(c_mktsegment) AS BP, count(*) % 4 AS priority,
         count(*) FILTER (event_type = 'click') % 3 AS click, count(*) FILTER (event_type = 'error') % 3 AS error,
         count(*) FILTER (event_type = 'purchase') % 3 AS purchase, count(*) FILTER (event_type = 'signup') % 3 AS signup,
         count(*) FILTER (event_type = 'view') % 3 AS "view"
  FROM events JOIN customer ON user_id = c_custkey GROUP BY 1)""",
}
_NEEDS = {
    "gaps": ["mart"],
    "client_features": ["mart"],
    "targets_long": ["targets_month"],
    "gappy": ["binary"],
    "calibration": ["binary"],
    "predictions": ["binary"],
    "importance": ["binary", "predictions"],
}


def with_sql(*names: str) -> str:
    """`WITH` clause of the named definitions and what they build on."""
    ordered = reduce(lambda acc, n: acc + [x for x in [*_NEEDS.get(n, []), n] if x not in acc], names, [])
    return "WITH " + ",\n".join(SQL[n] for n in ordered)


def rounded_sql(body: str, *columns: str, digits: int = 6) -> str:
    """Wrap a query so that its floating columns are rounded like `tidy` does."""
    replaced = ", ".join(f'round("{c}", {digits}) + 0.0::DOUBLE AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({body})"
