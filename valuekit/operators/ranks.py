"""Exact ordered statistics without a one-task sort.

Gini, ROC and precision-recall curves, quantiles, Spearman ranks, dense codes and exact sample
cuts all need "how much lies below this value in its group". A window over the whole group would
put a hot group (a third of the rows, say) into one task. Here it is done in three steps:

1. rows collapse to one per (group, value) with map-side combine, so repeated values cost nothing; these
   are written once, so the frame itself (a join, a score) is evaluated once however many passes follow;
2. the value axis is cut into ranges of similar row counts and the window runs per (group, range);
3. per-range totals, one row per group and range, give the offset that is joined back on.

A frame that fits one range skips 2 and 3. Where the caller knows the cuts, nothing is written. The cut points are plain literals in the plan, so a
recomputed task always lands in the same range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.operators.frames import join_on
from valuekit.session import settle

# A task sorts this many rows of one group without trouble. The number of ranges follows the rows.
ROWS_PER_RANGE = 5_000_000
_RANGE = "_range"


def broadcast_within(df: DataFrame, rows: int, limit: int = 100_000) -> DataFrame:
    """Broadcast hint only when the stated row bound is small; otherwise Spark chooses by size."""
    return F.broadcast(df) if rows <= limit else df


def pinned(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """Evaluate a small per-group table once and give it back as a broadcast side.

    For tables whose row count only the data can tell. At most `limit` + 1 rows ever reach the
    driver; a larger table comes back as it was and Spark joins it by shuffling.
    """
    table = df.limit(limit + 1).toArrow()
    if table.num_rows > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=df.schema))


def _present(df: DataFrame, value: str) -> DataFrame:
    """Rows with a value; NaN is missing, as null is."""
    kind = df.schema[value].dataType
    floating = isinstance(kind, (T.DoubleType, T.FloatType))
    return df.where(F.expr(f"`{value}` IS NOT NULL AND NOT isnan(`{value}`)" if floating else f"`{value}` IS NOT NULL"))


def cut_points(df: DataFrame, value: str, rows_per_range: int = ROWS_PER_RANGE) -> list:
    """Split points that cut the value axis into ranges of about `rows_per_range` rows.

    A count decides how many ranges are needed; an empty list means that one is enough. Beyond that
    a mergeable sketch finds the points in one pass without a shuffle.
    """
    if isinstance(df.schema[value].dataType, T.StringType):
        return _text_cut_points(df, value, rows_per_range)
    present = _present(df, value)
    ranges = math.ceil(present.count() / rows_per_range)
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    numbers = present.select(F.col(value).cast("double").alias(value))
    return sorted(set(numbers.approxQuantile(value, shares, 0.25 / ranges)))


def _text_cut_points(df: DataFrame, value: str, rows_per_range: int) -> list:
    """Split points for strings: a hash sample of the distinct values, at most 32 per range."""
    distinct = df.select(value).where(F.col(value).isNotNull()).distinct()
    total = distinct.count()
    ranges = math.ceil(total / rows_per_range)
    if ranges < 2:
        return []
    every = max(1, total // (ranges * 32))
    sample = distinct.where(F.pmod(F.xxhash64(value), F.lit(every)) == 0)
    texts = sorted(r[0] for r in sample.collect())
    step = max(1, len(texts) // ranges)
    return texts[step::step]


def _with_range(df: DataFrame, value: str, cuts: Sequence) -> DataFrame:
    if not cuts:
        return df.withColumn(_RANGE, F.lit(0))
    if isinstance(df.schema[value].dataType, T.StringType):
        edges = np.array(list(cuts), dtype=object)

        @F.pandas_udf("int")
        def locate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(np.searchsorted(edges, texts.to_numpy(dtype=object), side="right"))

        return df.withColumn(_RANGE, locate(F.col(value)))
    position = "_position"
    split = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=position, outputCol=_RANGE)
    return split.transform(df.withColumn(position, F.col(value).cast("double"))).drop(position).withColumn(
        # Never null (the input is not), stated so that both uses of the frame plan the same shuffle.
        _RANGE,
        F.coalesce(F.col(_RANGE).cast("int"), F.lit(0)),
    )


def known_cuts(rows: int, rows_per_range: int = ROWS_PER_RANGE) -> list | None:
    """`cuts` for ordered operators on so many rows: none where one range is enough, else they are looked for."""
    return [] if rows <= rows_per_range else None


def in_ranges(df: DataFrame, value: str, cuts: Sequence, name: str) -> DataFrame:
    """Add the number of the range that a value lies in; a cut point begins the range after it."""
    return _with_range(df, value, cuts).withColumnRenamed(_RANGE, name)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    measures: Mapping[str, Column],
    *,
    totals: bool = False,
    cuts: Sequence | None = None,
) -> DataFrame:
    """One row per (keys, value): each measure, and `<measure>_below` over smaller values.

    `measures` are aggregate columns that add up (sums, counts). With `totals` every row also has
    `<measure>_all`, the sum over its group. A null key is a group; missing values are left out.
    """
    present = _present(df, value)
    names = list(measures)
    if cuts is None:
        present = settle(present.groupBy(*keys, value).agg(*[c.alias(n) for n, c in measures.items()]))
        measures = {n: F.sum(n) for n in names}
        cuts = cut_points(present, value)
    elif isinstance(df.schema[value].dataType, T.StringType) and cuts:
        # Collapse before the Python hop, so that it sees each value once per group.
        present = present.groupBy(*keys, value).agg(*[c.alias(n) for n, c in measures.items()])
        measures = {n: F.sum(n) for n in names}
    if not cuts:
        per_value = present.groupBy(*keys, value).agg(*[c.alias(n) for n, c in measures.items()])
        earlier = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        below = [F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_below") for n in names]
        whole = [F.sum(n).over(Window.partitionBy(*keys)).alias(f"{n}_all") for n in names] if totals else []
        return per_value.select("*", *below, *whole)

    ranged = _with_range(present, value, cuts)
    sums = [c.alias(n) for n, c in measures.items()]
    previous = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and range: summed before the shuffle, evaluated once, then broadcast.
    offsets = pinned(
        ranged.groupBy(*keys, _RANGE).agg(*sums).select(
            *keys,
            _RANGE,
            *[F.coalesce(F.sum(n).over(previous), F.lit(0)).alias(f"_{n}_before") for n in names],
            *[F.sum(n).over(Window.partitionBy(*keys)).alias(f"{n}_all") for n in names],
        )
    )
    earlier = Window.partitionBy(*keys, _RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.groupBy(*keys, _RANGE, value).agg(*sums).select(
        "*", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_below") for n in names]
    )
    return join_on(inside, offsets, [*keys, _RANGE]).select(
        *keys,
        value,
        *names,
        *[(F.col(f"{n}_below") + F.col(f"_{n}_before")).alias(f"{n}_below") for n in names],
        *[F.col(f"{n}_all") for n in names if totals],
    )


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    *,
    kind: str = "linear",
    name: str = "quantiles",
    counts: Mapping[str, Column] | None = None,
    cuts: Sequence | None = None,
) -> DataFrame:
    """Exact quantiles per group as an array in `probs` order, one row per group.

    `kind="linear"` interpolates between neighbours, `kind="lower"` takes the lower neighbour.
    `counts` gives several populations of the same rows at once (name to counting aggregate), each
    with its own array column; by default all rows count and the array is called `name`.
    """
    if kind not in ("linear", "lower"):
        raise ValueError(f"kind must be 'linear' or 'lower', not {kind!r}")
    counts = dict(counts or {name: F.count(F.lit(1))})
    measures = {f"n{i}": c for i, c in enumerate(counts.values())}
    rows = running_totals(df, keys, value, measures, totals=True, cuts=cuts)
    sides = ("floor",) if kind == "lower" else ("floor", "ceil")

    def spot(m: str, p: float) -> str:
        return f"({float(p)!r}D * ({m}_all - 1))"

    # One conditional aggregate per wanted rank: compiled, and combined before the shuffle.
    found = rows.groupBy(*keys).agg(
        *[F.max(f"{m}_all").alias(f"{m}_all") for m in measures],
        *[
            F.expr(
                f"max(CASE WHEN {side}({spot(m, p)}) >= {m}_below AND {side}({spot(m, p)}) < {m}_below + {m} "
                f"THEN `{value}` END) AS _{m}_{side}_{i}"
            )
            for m in measures
            for i, p in enumerate(probs)
            for side in sides
        ],
    )

    def one(m: str, i: int, p: float) -> str:
        low, x = f"_{m}_floor_{i}", spot(m, p)
        return low if kind == "lower" else f"{low} + (_{m}_ceil_{i} - {low}) * ({x} - floor({x}))"

    arrays = [F.expr(f"array({', '.join(one(m, i, p) for i, p in enumerate(probs))}) AS `{n}`") for n, m in zip(counts, measures, strict=True)]
    return found.select(*keys, F.col("n0_all").alias("n_rows"), *arrays)


def bin_of(value: str, edges: str, n_edges: int, *, closed: str = "right", lowest: bool = False) -> Column:
    """Zero-based bin of column `value` among sorted unique `edges`; null when outside.

    `closed="right"` is (a, b], with `lowest` also taking the smallest edge into bin 0.
    `closed="left"` is [a, b) with the last bin closed on both sides. `n_edges` is the most edges
    the array can have: the comparison is unrolled, so it compiles, and stated as one SQL text,
    which is much cheaper to build than a tree of column objects.
    """
    passes = ">" if closed == "right" else ">="
    above = " + ".join(f"IF({value} {passes} get({edges}, {i}), 1, 0)" for i in range(n_edges))
    inside = f"size({edges}) > 1 AND {value} >= get({edges}, 0) AND {value} <= get({edges}, size({edges}) - 1)"
    if closed == "left":
        return F.expr(f"IF({inside}, least({above}, size({edges}) - 1) - 1, NULL)")
    if lowest:
        return F.expr(f"IF({inside}, greatest({above}, 1) - 1, NULL)")
    return F.expr(f"IF({inside} AND {value} > get({edges}, 0), {above} - 1, NULL)")


def unique_edges(edges: Column) -> Column:
    return F.array_sort(F.array_distinct(edges))


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, name: str, weight: Column | None = None, cuts: Sequence | None = None) -> DataFrame:
    """One row per (keys, value) with the average 1-based rank of its ties."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rows = running_totals(df, keys, value, {"n": n}, cuts=cuts)
    return rows.select(*keys, value, (F.col("n_below") + (F.col("n") + 1) / 2).alias(name))


def dense_codes(df: DataFrame, keys: Sequence[str], value: str, name: str = "code") -> DataFrame:
    """Distinct values of each group numbered 0, 1, ... in ascending order."""
    rows = running_totals(df.select(*keys, value).distinct(), keys, value, {"n": F.count(F.lit(1))})
    return rows.select(*keys, value, F.col("n_below").cast("bigint").alias(name))


def rank_cuts(df: DataFrame, keys: Sequence[str], value: str, shares: Mapping[str, float | int]) -> DataFrame:
    """For each group and each entry of `shares`, the largest value inside that share of rows.

    A float is a fraction of the group's rows, an int a row count. Used to cut a frame ordered by
    a hash into parts of exact size.
    """
    rows = running_totals(df, keys, value, {"n": F.count(F.lit(1))}, totals=True)

    def inside(share: float | int) -> Column:
        size = F.floor(F.lit(share) * F.col("n_all")) if isinstance(share, float) else F.lit(share)
        return F.col("n_below") < size

    return rows.groupBy(*keys).agg(*[F.max(F.when(inside(s), F.col(value))).alias(n) for n, s in shares.items()])
