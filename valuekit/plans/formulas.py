"""Fixed models of the registered queries, as Spark expressions and as SQL.

They stand behind the interface of fitted models, so that scoring, permutation, prefixes and batch runs can be checked
to the last digit by another engine. Fitted models themselves are in `gbt_fit`, `rf_fit` and their kind.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from valuekit.operators.training import Formula

MODEL_FEATURES = ("l_quantity", "l_discount", "l_tax", "p_size", "T")
ORDER_FEATURES = ("total_amt", "qty_amt", "disc_avg", "T", "cc")
VALUE_FEATURES = ("qty", "n_lines")

#: (feature, threshold, above, otherwise) of eight stumps, with their weights. All values are sums of powers of two.
STUMPS = (
    ("l_quantity", 25.0, 0.5, -0.5, 1.0),
    ("l_discount", 0.05, -0.25, 0.125, 0.5),
    ("l_quantity", 40.0, 0.25, -0.125, 0.5),
    ("p_size", 25.0, 0.125, -0.125, 0.5),
    ("l_discount", 0.08, -0.5, 0.0625, 0.5),
    ("l_quantity", 10.0, 0.125, -0.25, 0.5),
    ("l_tax", 0.04, 0.0625, -0.0625, 0.5),
    ("p_size", 40.0, -0.25, 0.25, 0.5),
)


def _stump(feature: str, threshold: float, above: float, below: float):
    return lambda x: F.when(x[feature] > threshold, above).otherwise(below)


LINE_TREES = Formula(MODEL_FEATURES, lambda x: F.lit(0.5), tuple(_stump(*s[:4]) for s in STUMPS), tuple(s[4] for s in STUMPS))


def _line(x: Mapping[str, Column]) -> Column:
    return 0.1 + 0.0125 * x["l_quantity"] - 2 * x["l_discount"] + 0.5 * x["l_tax"] + 0.001953125 * x["p_size"]


LINE = Formula(MODEL_FEATURES, _line)
LINE_SQL = "0.1::DOUBLE + 0.0125::DOUBLE * {l_quantity} - 2 * {l_discount} + 0.5::DOUBLE * {l_tax} + 0.001953125::DOUBLE * {p_size}"

VALUE = Formula(VALUE_FEATURES, lambda x: 1200.5 * x["qty"] + 310.25 * x["n_lines"])
VALUE_SQL = "1200.5::DOUBLE * {qty} + 310.25::DOUBLE * {n_lines}"
SMALL_VALUE = Formula(VALUE_FEATURES, lambda x: 1300.5 * x["qty"] - 40.75 * x["n_lines"])
SMALL_VALUE_SQL = "1300.5::DOUBLE * {qty} - 40.75::DOUBLE * {n_lines}"

#: An additive value model: a part for the quantity, one for the lines, and a step, the last at half its weight.
VALUE_TREES = Formula(
    VALUE_FEATURES,
    VALUE.expression,
    (lambda x: 1200.5 * x["qty"], lambda x: 310.25 * x["n_lines"], lambda x: F.when(x["qty"] > 100, 500.0).otherwise(-250.0)),
    (1.0, 1.0, 0.5),
)
VALUE_TREES_SQL = ("1200.5::DOUBLE * {qty}", "310.25::DOUBLE * {n_lines}", "0.5::DOUBLE * CASE WHEN {qty} > 100 THEN 500.0::DOUBLE ELSE -250.0::DOUBLE END")


def response(shift: int = 0) -> Formula:
    """P(y) of an order: rises with the quantity, and with the treatment less each period."""
    return Formula(ORDER_FEATURES, lambda x: 0.125 + 0.001 * x["qty_amt"] + x["cc"] * (0.15 - 0.01 * x["T"] + 0.001 * shift))


def uplift_sql(qty: str, t: str, shift: str = "0") -> str:
    """Uplift of `response` from rounded probabilities."""
    p = "round(0.125::DOUBLE + 0.001::DOUBLE * {q} + {a} * (0.15::DOUBLE - 0.01::DOUBLE * {t} + 0.001::DOUBLE * {s}), 5)"
    return f"{p.format(q=qty, a='1.0::DOUBLE', t=t, s=shift)} - {p.format(q=qty, a='0.0::DOUBLE', t=t, s=shift)}"
