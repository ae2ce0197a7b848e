"""Monthly feature mart: slice with trailing means, feature-target join, coverage."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.functions.columns import month_list
from valuekit.roles import require_columns

# Fixed value: horizons of the trailing means, in months.
HORIZONS = (3, 6, 12)


def _literals(months: Sequence[date]) -> str:
    return ", ".join(f"DATE '{m}'" for m in months)


def mart_slice(
    mart: DataFrame,
    slice_date: date,
    *,
    key: str = "client_id",
    month: str = "month",
    features: Sequence[str],
    averaged: Sequence[str],
    horizons: Sequence[int] = HORIZONS,
    condition: str | None = None,
    snap: bool = True,
) -> DataFrame:
    """Rows of the slice month with `<c>_<k>a`: the mean of `c` over the last k months.

    One scan of the longest window: every horizon is a conditional mean in the same aggregate,
    which is shuffled by key as partial sums, once. The months are literals, so a mart partitioned
    by month reads only those partitions.
    """
    require_columns(mart, {key, month, *features, *averaged})
    windows = {k: month_list(slice_date, k, snap) for k in horizons}
    longest = max(windows.values(), key=len, default=[slice_date])
    rows = mart.where(F.col(month).isin(*longest))
    if condition:
        rows = rows.where(condition)
    wanted = [key, *dict.fromkeys([*averaged, *features])]
    current = rows.where(F.col(month) == slice_date).select(*wanted)
    if not averaged:
        return current
    means = rows.groupBy(key).agg(*[
        F.expr(f"avg(IF(`{month}` IN ({_literals(months)}), `{c}`, NULL)) AS `{c}_{k}a`") for k, months in windows.items() for c in averaged
    ])
    return current.join(means, key)


def latest_month(mart: DataFrame, month: str = "month") -> DataFrame:
    """The newest month, one row. For a partition column no data column is read."""
    return mart.agg(F.max(month).alias("latest_month"))


def freshness(mart: DataFrame, today: date | None = None, month: str = "month") -> DataFrame:
    """Is the newest month the last full month before `today`?"""
    now = F.lit(today) if today else F.current_date()
    due = F.last_day(F.add_months(now, -1))
    return latest_month(mart, month).select("latest_month", due.alias("due_month"), (F.col("latest_month") == due).alias("is_fresh"))


def join_targets(features: DataFrame, targets: DataFrame, key: str, date_column: str = "report_dt", first_t: int = 0) -> DataFrame:
    """Features and targets of the same client, year and month, for T from `first_t` on."""
    def dated(df: DataFrame) -> DataFrame:
        return df.withColumn("y_", F.year(date_column)).withColumn("m_", F.month(date_column)).drop(date_column)

    late = targets.where(F.col("T") >= first_t)
    return dated(features).join(dated(late), [key, "y_", "m_"]).drop("y_", "m_")


def first_period(base: str, sold: str) -> int:
    """T = 0 is left out where the sold product is the base product itself."""
    # The product codes of the same product under another name.
    same = base == sold or base == f"{sold}2" or (base in ("dc1", "dc2p") and sold == "dc")
    return 1 if same else 0


def join_coverage(features: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Distinct clients in the features, in the targets and in their join.

    Each side is first reduced to its distinct keys and marked; one grouped pass over the union
    then knows for every client where it occurs.
    """
    marked = features.select(key, F.lit(1).alias("f"), F.lit(0).alias("t")).unionByName(
        targets.select(key, F.lit(0).alias("f"), F.lit(1).alias("t"))
    )
    clients = marked.groupBy(key).agg(F.max("f").alias("f"), F.max("t").alias("t"))
    return clients.agg(
        F.coalesce(F.sum("f"), F.lit(0)).cast("bigint").alias("n_features"),
        F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("n_targets"),
        F.count_if((F.col("f") == 1) & (F.col("t") == 1)).alias("n_joined"),
    )
