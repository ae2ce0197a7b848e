"""SQL twins of queries on fitted things that have an exact formula."""

from __future__ import annotations

from valuekit.plans import fixtures as fx
from valuekit.plans import formulas
from valuekit.plans.fixtures import rounded_sql, with_sql
from valuekit.plans.metric_queries import _COMPARE, _auc_sql, _calibration_sql, _long_sql

_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def hash_sql(*keys: str, seed: int) -> str:
    text = " || '|' || ".join([*keys, f"'{seed}'"])
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT / 4503599627370496::DOUBLE"


#: The binary sample with a label that its features explain, as `sig`.
SIGNAL = f"""sig AS (SELECT * REPLACE (CAST({hash_sql(*_KEY, seed=11)} < 0.1::DOUBLE + 0.012::DOUBLE * l_quantity - 2 * l_discount AS INT) AS y) FROM bin_sample)"""


def isotonic_sql(points: str) -> str:
    """CTE `iso` (x, v) by the min-max formula over `points` (x, y): v(i) is the largest over a <= i of the least mean of a..b over b >= i."""
    return f"""pt AS (SELECT x, CAST(sum(y) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS w FROM {points} GROUP BY x),
    cu AS (SELECT x, s, w, row_number() OVER o AS i, sum(s) OVER o AS cs, sum(w) OVER o AS cw FROM pt WINDOW o AS (ORDER BY x)),
    mn AS (SELECT a.i AS a, b.i AS b, (b.cs - a.cs + a.s) / (b.cw - a.cw + a.w) AS m FROM cu a JOIN cu b ON b.i >= a.i),
    lo AS (SELECT a, b, min(m) OVER (PARTITION BY a ORDER BY b DESC) AS m FROM mn),
    iso AS (SELECT x, v FROM cu JOIN (SELECT b AS i, max(m) AS v FROM lo GROUP BY b) USING (i))"""


def between_sql(source: str, x: str) -> str:
    """`source` with `v`, the line between the neighbours of column `x` in `iso`, constant outside."""
    return f"""SELECT q.*, CASE WHEN a.x IS NULL THEN b.v WHEN b.x IS NULL OR a.x = b.x THEN a.v ELSE a.v + (b.v - a.v) * (q.{x} - a.x) / (b.x - a.x) END AS v
    FROM {source} q ASOF LEFT JOIN iso a ON q.{x} >= a.x ASOF LEFT JOIN iso b ON q.{x} <= b.x"""


def _compare_sql() -> str:
    columns = ", ".join(
        f"max(CASE WHEN sample = '{s}' THEN {m} END) AS {m}_{s}, max(CASE WHEN sample = '{s}' THEN {m}_calibrated END) AS {m}_calibrated_{s}, "
        f"max(CASE WHEN sample = '{s}' THEN {m}_calibrated - {m} END) AS delta_{m}_{s}"
        for m, s in _COMPARE
    )
    return f"SELECT method, {columns} FROM stats WHERE bin = 'Total' GROUP BY 1"


_COMPARED = [f"{p}{m}{q}_{s}" for m, s in _COMPARE for p, q in (("", ""), ("", "_calibrated"), ("delta_", ""))]


def _isotonic() -> str:
    return rounded_sql(
        f"""{with_sql('binary')}, {SIGNAL}, tr AS (SELECT score AS x, y FROM sig WHERE sample = 'train'), {isotonic_sql('tr')},
    cal AS (SELECT 'isotonic' AS method, sample, y AS y_true, score AS y_pred, v AS y_calib FROM ({between_sql('sig', 'score')})),
    {_calibration_sql('cal', 'method, sample')} {_compare_sql()}""",
        *_COMPARED,
    )


def _isotonic_points() -> str:
    return f"""{with_sql('binary')}, {SIGNAL}, tr AS (SELECT score AS x, y FROM sig WHERE sample = 'train'), {isotonic_sql('tr')},
    s AS (SELECT score, count(*) AS n FROM sig GROUP BY score) SELECT score, n, round(v, 9) AS v FROM ({between_sql('s', 'score')})"""


def feature_tree_sql(source: str, features: tuple[str, ...], depth: int = 3) -> str:
    """CTEs up to `tree` (sample, feature, correlation) for exact depth-limited trees of one feature."""
    group = "sample, feature, node"
    steps = [f"""cell0 AS (SELECT sample, feature, coalesce(value, -9999) AS value, 0 AS node, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS s, CAST(sum(y * y) AS DOUBLE) AS q
      FROM ({_long_sql(source, features, "sample, y")}) WHERE y IS NOT NULL GROUP BY ALL)"""]
    for d in range(depth):
        steps.append(f"""run{d} AS (SELECT {group}, value, sum(n) OVER o AS nl, sum(s) OVER o AS sl, sum(n) OVER g AS na, sum(s) OVER g AS sa
      FROM cell{d} WINDOW o AS (PARTITION BY {group} ORDER BY value), g AS (PARTITION BY {group})),
    cut{d} AS (SELECT {group}, value AS cut FROM (SELECT {group}, value, sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) - sa * sa / na AS gain FROM run{d} WHERE na > nl)
      WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY {group} ORDER BY gain DESC, value) = 1),
    cell{d + 1} AS (SELECT c.sample, c.feature, c.value, c.node * 2 + CASE WHEN c.value > t.cut THEN 1 ELSE 0 END AS node, n, s, q
      FROM cell{d} c LEFT JOIN cut{d} t ON t.sample IS NOT DISTINCT FROM c.sample AND t.feature = c.feature AND t.node = c.node)""")
    steps.append(f"""leaf AS (SELECT {group}, sum(n) AS n, sum(s) AS s, sum(q) AS q FROM cell{depth} GROUP BY ALL),
    tree AS (SELECT sample, feature, 100 * sqrt(CASE WHEN sum(s * s / n) - sum(s) * sum(s) / sum(n) > 0 THEN sum(s * s / n) - sum(s) * sum(s) / sum(n) END
      / nullif(sum(q) - sum(s) * sum(s) / sum(n), 0)) AS correlation FROM leaf GROUP BY ALL)""")
    return ",\n    ".join(steps)


def _tree_delta() -> str:
    names = ("train", "valid", "test", "OOT")
    columns = [f"max(CASE WHEN sample = '{s}' THEN correlation END) AS {s}" for s in names]
    deltas = [f"({s} - train) / nullif(train, 0) AS delta_train_vs_{s}" for s in names[1:]]
    return rounded_sql(
        f"""{with_sql('binary')}, {SIGNAL}, {feature_tree_sql('sig', fx.NUMERIC)}, w AS (SELECT feature, {", ".join(columns)} FROM tree GROUP BY 1) SELECT *, {", ".join(deltas)} FROM w""",
        *names, *[f"delta_train_vs_{s}" for s in names[1:]],
    )


def _prefix_gini() -> str:
    """CTE `path` with the Gini of every prefix of the stumps by comparing ranks."""
    margin, parts = "0", []
    for i, (f, cut, above, below, weight) in enumerate(formulas.STUMPS, 1):
        margin += f" + {weight}::DOUBLE * CASE WHEN {f} > {cut}::DOUBLE THEN {above}::DOUBLE ELSE {below}::DOUBLE END"
        parts.append(f"SELECT sample, y, {i} AS n_trees, {margin} AS m FROM sig WHERE sample IN ('train', 'valid')")
    return f"""{with_sql('binary')}, {SIGNAL}, l AS ({" UNION ALL ".join(parts)}), a AS ({_auc_sql('l', 'sample, n_trees', 'm')}),
    g AS (SELECT n_trees, max(CASE WHEN sample = 'train' THEN 200 * auc - 100 END) AS gini_train, max(CASE WHEN sample = 'valid' THEN 200 * auc - 100 END) AS gini_valid FROM a GROUP BY 1),
    path AS (SELECT *, gini_train - gini_valid AS absolute_diff, 100 * (gini_train - gini_valid) / nullif(gini_train, 0) AS relative_diff FROM g)"""


def permuted_sql(source: str, keys: tuple[str, ...], features: tuple[str, ...]) -> str:
    """CTE `both`: rows of `source` (with sample) and the features of the row half a turn further in hash order, as d_<feature>."""
    donors = ", ".join(f"d.{f} AS d_{f}" for f in features)
    return f"""rk AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY {hash_sql(*keys, seed=0)}) - 1 AS i, count(*) OVER (PARTITION BY sample) AS n FROM {source}),
    both_rows AS (SELECT r.*, {donors} FROM rk r JOIN rk d ON d.sample IS NOT DISTINCT FROM r.sample AND (d.i + d.n // 2) % d.n = r.i)"""


def _variants(expression: str, features: tuple[str, ...], columns: str) -> str:
    parts = []
    for moved in ("", *features):
        score = expression.format(**{f: f"d_{f}" if f == moved else f for f in features})
        parts.append(f"SELECT {columns}, '{moved}' AS permuted, {score} AS s FROM both_rows")
    return " UNION ALL ".join(parts)


def line_importance_sql(source: str) -> str:
    """CTE `imp` (sample, feature, importance): fall of the Gini of the line formula."""
    return f"""{permuted_sql(source, _KEY, formulas.MODEL_FEATURES)}, v AS ({_variants(formulas.LINE_SQL, formulas.MODEL_FEATURES, "sample, y")}),
    a AS ({_auc_sql('v', 'sample, permuted', 's')}), imp AS (SELECT p.sample, p.permuted AS feature, 200 * (b.auc - p.auc) AS importance
      FROM a p JOIN a b ON b.sample IS NOT DISTINCT FROM p.sample AND b.permuted = '' WHERE p.permuted <> '')"""


_TESTED = f"{with_sql('binary')}, {SIGNAL}, tested AS (SELECT * FROM sig WHERE sample IN ('test', 'OOT')), {line_importance_sql('tested')}"
RELEVANCY = """SELECT i.sample, 100.0::DOUBLE * count(*) FILTER (importance / nullif(best, 0) > 0.2) / count(importance) AS factors_relevancy
    FROM imp i JOIN (SELECT sample, max(importance) AS best FROM imp GROUP BY 1) b ON b.sample IS NOT DISTINCT FROM i.sample GROUP BY 1"""
#: The regression sample as the value models see it: the net total is the target.
_VALUE_ROWS = f"{with_sql('regression')}, v0 AS (SELECT o_orderkey, qty, n_lines, y_pred AS y, sample FROM reg_sample)"


def _regressor_importance() -> str:
    return rounded_sql(
        f"""{_VALUE_ROWS}, {permuted_sql('v0', ('o_orderkey',), formulas.VALUE_FEATURES)}, v AS ({_variants(formulas.VALUE_SQL, formulas.VALUE_FEATURES, "sample, y")}),
    m AS (SELECT sample, permuted, avg(abs(y - s)) AS e FROM v GROUP BY ALL)
    SELECT p.sample, p.permuted AS feature, (p.e - b.e) / b.e AS importance FROM m p JOIN m b ON b.sample = p.sample AND b.permuted = '' WHERE p.permuted <> ''""",
        "importance",
    )


def _regression_path() -> str:
    parts = [p.format(qty="qty", n_lines="n_lines") for p in formulas.VALUE_TREES_SQL]
    errors = " UNION ALL ".join(f"SELECT {k} AS n_trees, sample, avg(abs(y - ({' + '.join(parts[:k])}))) AS e FROM v0 GROUP BY sample" for k in range(1, len(parts) + 1))
    return rounded_sql(
        f"""{_VALUE_ROWS}, e AS ({errors}), w AS (SELECT CAST(n_trees AS INT) AS n_trees, max(CASE WHEN sample = 'train' THEN e END) AS train, max(CASE WHEN sample = 'valid' THEN e END) AS valid FROM e GROUP BY 1)
    SELECT *, 100 * abs(train - valid) / nullif(train, 0) AS relative_diff FROM w""",
        "train", "valid", "relative_diff", digits=4,
    )


#: Orders with treatment `cc` and quantity, as `treated`.
TREATED = "treated AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INT) AS cc, sum(l_quantity) AS qty FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)"

ORACLE = {
    "gap_limited_trees": rounded_sql(f"{_prefix_gini()} SELECT * FROM path", "gini_train", "gini_valid", "absolute_diff", "relative_diff"),
    "gap_limited_count": f"""{_prefix_gini()} SELECT max(CASE WHEN absolute_diff <= 5 AND relative_diff <= 10 THEN n_trees END) AS n_trees,
        count(*) FILTER (absolute_diff <= 5 AND relative_diff <= 10) AS n_passing, count(*) AS n_built FROM path""",
    "permutation_importance": rounded_sql(f"{_TESTED} SELECT * FROM imp", "importance"),
    "factor_relevancy": rounded_sql(f"{_TESTED} {RELEVANCY}", "factors_relevancy"),
    "regressor_importance": _regressor_importance(),
    "regression_path": _regression_path(),
    "uplift_curve": rounded_sql(
        f"""WITH {TREATED} SELECT 'cc_pl' AS pair, CAST(t AS INT) AS T, count(*) AS n, avg({formulas.uplift_sql('qty', 't')}) AS uplift
        FROM treated, (SELECT unnest(range(10)) AS t) GROUP BY 2""", "uplift"),
    "npv_score": f"{_VALUE_ROWS} SELECT o_orderkey, round({formulas.VALUE_SQL.format(qty='qty', n_lines='n_lines')}, 2) AS npv_cc FROM v0",
    "segment_score": f"""{_VALUE_ROWS} SELECT o_orderkey, round(CASE WHEN n_lines > 3 THEN {formulas.VALUE_SQL.format(qty='qty', n_lines='n_lines')}
        ELSE {formulas.SMALL_VALUE_SQL.format(qty='qty', n_lines='n_lines')} END, 2) AS npv_dc FROM v0""",
    "isotonic": _isotonic(),
    "isotonic_points": _isotonic_points(),
    "tree_correlation": rounded_sql(f"{with_sql('binary')}, {SIGNAL}, {feature_tree_sql('sig', fx.NUMERIC)} SELECT * FROM tree", "correlation"),
    "tree_correlation_delta": _tree_delta(),
}
