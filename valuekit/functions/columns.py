"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for "missing" in numeric features.
MISSING_NUMBER = -9999.0
# Fixed value: stands for "missing" in categories.
MISSING_CATEGORY = "NA"
# Degrees of freedom up to which Student quantiles come from the exact series.
EXACT_FREEDOM = 200


def known(col: Column) -> Column:
    """A number with NaN turned into null, so aggregates skip it as pandas does."""
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))


def filled(col: Column, value: float = MISSING_NUMBER) -> Column:
    return F.coalesce(known(col), F.lit(value))


def finite_or(col: Column, value: float = 0.0) -> Column:
    """Null, NaN and infinities replaced by `value`."""
    number = known(col)
    return F.when(F.abs(number) != float("inf"), number).otherwise(F.lit(value))


def blank_free_lower(col: Column) -> Column:
    return F.lower(F.replace(col, F.lit(" "), F.lit("")))


def replace_in_order(col: Column, substitutes: Mapping[str, str]) -> Column:
    """Substring replacements applied one after another, in mapping order."""
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), substitutes.items(), col)


def whole_or_null(col: Column) -> Column:
    """Export clean-up for numbers: a whole float becomes an integer, anything else stays null."""
    value = finite_or(col, float("nan"))
    return F.when(value % 1 == 0, value.cast("bigint"))


def null_text(col: Column) -> Column:
    """Export clean-up for strings: the literal text 'null' becomes NULL."""
    return F.nullif(col, F.lit("null"))


def month_list(slice_date: date, months: int, snap: bool = True) -> list[date]:
    """`slice_date` and the `months - 1` months before it.

    With `snap` each entry is a month end, which is what month-end partitions need. Without it
    the day number is kept (clipped to the month's length).
    """

    def end(year: int, month: int) -> date:
        return date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)

    out = []
    for back in range(months):
        index = slice_date.year * 12 + slice_date.month - 1 - back
        last = end(index // 12, index % 12 + 1)
        out.append(last if snap else last.replace(day=min(last.day, slice_date.day)))
    return out


def months_of(names: Sequence[int], step: int = 3) -> dict[int, int]:
    """Month offset to period number: 0 stays 0, then every `step` offsets form one period."""
    return {t: 0 if t == 0 else t // step + 1 for t in names}


def hash_fraction(*cols: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends only on the key and the seed.

    Re-runs and retried tasks agree, unlike `rand()`. It takes the first 52 bits of an md5 digest,
    which every SQL engine has, so a split can be checked elsewhere.
    """
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def odds(p: Column) -> Column:
    return F.try_divide(p, 1 - p)


def logit(p: Column) -> Column:
    ratio = odds(p)
    return F.when(ratio > 0, F.log(ratio))


def expit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def log_target(y: Column, low: Column | float, bias: float = 0.0) -> Column:
    return F.log(y - low + 1 + bias)


def unlog_target(z: Column, low: Column | float, bias: float = 0.0) -> Column:
    """Exact inverse of `log_target` with the same fitted minimum."""
    return F.exp(z) + low - 1 - bias


def _student_inside(angle: float, freedom: int) -> float:
    """Probability of |T| below tan(angle) * sqrt(freedom), by the finite series for whole degrees."""
    cosine, term, total = math.cos(angle), 1.0, 1.0
    if freedom == 1:
        return 2 * angle / math.pi
    for k in range(1 + freedom % 2, freedom - 2 + freedom % 2, 2):
        term *= cosine**2 * k / (k + 1)
        total += term
    if freedom % 2:
        return 2 / math.pi * (angle + math.sin(angle) * cosine * total)
    return math.sin(angle) * total


def exact_student_quantile(prob: float, freedom: int) -> float:
    """Student quantile for whole degrees of freedom and prob above one half, by bisection of the exact series."""
    low, high = 0.0, math.pi / 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if _student_inside(middle, freedom) < 2 * prob - 1 else (low, middle)
    return math.tan(low) * math.sqrt(freedom)


def student_quantile(prob: float, freedom: Column) -> Column:
    """Student quantile (prob above one half) as an expression of the whole degrees of freedom.

    Exact values up to `EXACT_FREEDOM`, from there the normal quantile with the usual expansion in
    1/freedom up to the fourth order, which is then exact to 1e-10. Null for no degrees.
    """
    z = NormalDist().inv_cdf(prob)
    # Polynomial coefficients of the expansion, by power of 1/freedom.
    terms = (
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    )
    n = freedom.cast("double")
    series = reduce(lambda acc, kt: acc + F.try_divide(F.lit(kt[1]), F.pow(n, F.lit(kt[0]))), enumerate(terms, 1), F.lit(z))
    exact = F.lit([exact_student_quantile(prob, k) for k in range(1, EXACT_FREEDOM + 1)])
    return F.when(freedom > EXACT_FREEDOM, series).when(freedom >= 1, F.get(exact, (freedom - 1).cast("int")))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation as an aggregate; null where one side is constant, which `corr` takes as an error."""
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def status_two_sided(value: Column, lower: float, upper: float, order: str = "straight") -> Column:
    """green / yellow / red around a band. `straight`: small is good; `reverse`: large is good."""
    if order == "straight":
        green, red = value < lower, value > upper
    elif order == "reverse":
        green, red = value > lower, value < upper
    else:
        raise ValueError(f"order must be 'straight' or 'reverse', not {order!r}")
    return F.when(value.isNull(), None).when(green, "green").when(red, "red").otherwise("yellow")


def status_one_sided(value: Column, lower: float, upper: float, order: str = "straight") -> Column:
    """green below `lower`, red from `upper` on, nothing between (mirrored for `reverse`)."""
    if order == "straight":
        green, red = value < lower, value >= upper
    elif order == "reverse":
        green, red = value > lower, value <= upper
    else:
        raise ValueError(f"order must be 'straight' or 'reverse', not {order!r}")
    return F.when(green, "green").when(red, "red")


def status_boundary(value: Column, boundary: float, order: str = "straight") -> Column:
    """red at or past one boundary, else nothing. `straight` marks low values, `reverse` high."""
    if order not in ("straight", "reverse"):
        raise ValueError(f"order must be 'straight' or 'reverse', not {order!r}")
    return F.when(value <= boundary if order == "straight" else value >= boundary, "red")


def rounded(col: Column, digits: int = 6) -> Column:
    return F.round(col, digits)
