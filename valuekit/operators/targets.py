"""Period targets: from wide month columns to (client, product, T, outcome)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.functions.columns import months_of

_MONTH_COLUMN = re.compile(r"^(?P<product>.+)_t(?P<month>\d+)$")


def period_columns(columns: Sequence[str], step: int = 3) -> dict[str, list[str]]:
    """`<product>_t<period>` to the month columns it collapses, in month order."""
    parsed = [(m["product"], int(m["month"])) for m in map(_MONTH_COLUMN.match, columns) if m]
    period = months_of([t for _, t in parsed], step)
    out: dict[str, list[str]] = {}
    for product, t in sorted(parsed):
        out.setdefault(f"{product}_t{period[t]}", []).append(f"{product}_t{t}")
    return out


def _outcome(name: str, months: Sequence[str]) -> Column:
    """1 if the months add up above 0, 0 if to 0, null if any month is null."""
    total = " + ".join(f"`{m}`" for m in months)
    return F.expr(f"max(CASE WHEN {total} > 0 THEN 1 WHEN {total} = 0 THEN 0 END) AS `{name}`")


def collapse_periods(wide: DataFrame, keys: Sequence[str], step: int = 3) -> DataFrame:
    """One row per key with period columns; duplicates of a key combine by maximum."""
    groups = period_columns([c for c in wide.columns if c not in set(keys)], step)
    return wide.groupBy(*keys).agg(*[_outcome(name, months) for name, months in groups.items()])


def unpivot_periods(periods: DataFrame, keys: Sequence[str], target: str = "TRG") -> DataFrame:
    """(keys, target, Product, T) with one row per period column."""
    columns = [c for c in periods.columns if c not in set(keys)]
    long = periods.unpivot([*keys], columns, "product_t", target)
    return long.select(
        *keys,
        target,
        F.regexp_extract("product_t", r"^(.+)_t\d+$", 1).alias("Product"),
        F.regexp_extract("product_t", r"_t(\d+)$", 1).cast("int").alias("T"),
    )


def long_targets(tables: Sequence[DataFrame], keys: Sequence[str], base_product: str | None = None, step: int = 3, target: str = "TRG") -> DataFrame:
    """Collapse and unpivot each target table, union them, keep labelled rows."""
    parts = [unpivot_periods(collapse_periods(t, keys, step), keys, target) for t in tables]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part.select(*out.columns))
    if base_product:
        out = out.withColumn(base_product, F.lower(base_product))
    return out.where(F.col(target).isNotNull())


def pair_list(matrix: DataFrame, base: str = "BP", priority: str = "priority") -> DataFrame:
    """Ordered (bp, sp) pairs of a base-by-sold matrix: positive cell and positive priority.

    `place` is the position in (priority, bp, sp) order and `done_percent` the progress after it.
    The matrix is configuration, so its pair list is small by nature.
    """
    sold = [c for c in matrix.columns if c not in (base, priority)]
    typed = matrix.select(base, F.col(priority).cast("int"), *[F.col(c).cast("int") for c in sold])
    pairs = typed.unpivot([base, priority], sold, "sp", "cell").where((F.col("cell") > 0) & (F.col(priority) > 0))
    packed = pairs.agg(F.array_sort(F.collect_list(F.struct(F.col(priority), F.col(base).alias("bp"), "sp"))).alias("p"))
    return packed.select(F.size("p").alias("n"), F.posexplode("p").alias("at", "pair")).select(
        F.col("pair.bp").alias("bp"),
        F.col("pair.sp").alias("sp"),
        F.col(f"pair.{priority}").alias("priority"),
        (F.col("at") + 1).alias("place"),
        F.round(100 * (F.col("at") + 1) / F.col("n"), 2).alias("done_percent"),
    )
