"""Isotonic regression without an ordered pass in one place.

Points are the distinct scores. The score axis is cut into ranges; inside a range adjacent violators are pooled, which
leaves blocks of rising means. Two neighbouring ranges of blocks are then merged, and so on in a tree: blocks on both
sides stay, except those around the seam, which become one block. Its members are known without walking: with t the
mean of the pool, they are the left blocks with means above t and the right blocks with means up to t, and
    sum over left blocks above t of (s - t w) + sum over right blocks below t of (s - t w)
falls as t grows and crosses zero there. Both sums are running totals of the blocks ordered by mean, so a merge is one
ordered job over all pairs of ranges, however many blocks a range has, and no task or driver sees all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.operators.ranks import ROWS_PER_RANGE, cut_points, in_ranges, pinned, running_totals
from valuekit.session import settle

_BLOCKS = "range int, low double, high double, s double, w double"
#: Block ends that are shipped with a task; with more, rows and ends meet by ranges.
SHIPPED_ENDS = 100_000
#: Copies of the block ends of a range, so that its rows are dealt to as many tasks.
SALTS = 16


def pool_adjacent(low: np.ndarray, high: np.ndarray, s: np.ndarray, w: np.ndarray) -> list[tuple[float, float, float, float]]:
    """Blocks (low, high, sum, weight) with strictly rising means from points or blocks in order."""
    out: list[tuple[float, float, float, float]] = []
    for a, b, total, size in zip(low.tolist(), high.tolist(), s.tolist(), w.tolist()):
        while out and out[-1][2] * size >= total * out[-1][3]:
            a, _, more, rows = out.pop()
            total, size = total + more, size + rows
        out.append((a, b, total, size))
    return out


def _pool_range(table: pa.Table) -> pa.Table:
    table = table.sort_by("low")
    blocks = pool_adjacent(*(table[c].to_numpy() for c in ("low", "high", "s", "w")))
    columns = [pa.array([table["range"][0].as_py()] * len(blocks), pa.int32())]
    return pa.Table.from_arrays(columns + [pa.array([b[i] for b in blocks], pa.float64()) for i in range(4)], ["range", "low", "high", "s", "w"])


def merged(blocks: DataFrame) -> DataFrame:
    """Blocks of ranges 2k and 2k + 1 as blocks of range k."""
    left = F.pmod("range", F.lit(2)) == 0
    rows = blocks.select(F.shiftright("range", 1).alias("range"), left.alias("is_left"), "low", "high", "s", "w", (F.col("s") / F.col("w")).alias("mean"))
    side = {n: F.sum(F.when(F.col("is_left") == (n[1] == "l"), F.col(n[0])).otherwise(0.0)) for n in ("sl", "wl", "sr", "wr")}
    sums = running_totals(rows, ["range"], "mean", side, totals=True)
    above = {n: F.col(f"{n}_all") - F.col(f"{n}_below") - F.col(n) for n in ("sl", "wl")}
    balance = above["sl"] - F.col("mean") * above["wl"] + F.col("sr_below") - F.col("mean") * F.col("wr_below")
    seams = sums.groupBy("range").agg(F.max(F.when(balance >= 0, F.col("mean"))).alias("seam"))
    placed = rows.join(pinned(seams), "range")
    pooled = F.when(F.col("is_left"), F.col("mean") > F.col("seam")).otherwise(F.col("mean") <= F.col("seam"))
    # What is pooled has no own key, so each range has one such block.
    own = F.when(pooled, F.lit(None)).otherwise(F.col("low"))
    return placed.groupBy("range", own.alias("own")).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("s").alias("s"), F.sum("w").alias("w")).drop("own")


def isotonic_blocks(df: DataFrame, score: str, label: str, *, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(low, high, value, n): the blocks of the rising step function that fits `label` best.

    Rows without a score or a label are left out.
    """
    known = df.select(F.col(score).cast("double").alias("low"), F.col(label).cast("double").alias("y")).where("low IS NOT NULL AND NOT isnan(low) AND y IS NOT NULL")
    points = settle(known.groupBy("low").agg(F.sum("y").alias("s"), F.count(F.lit(1)).cast("double").alias("w")))
    cuts = cut_points(points, "low", rows_per_range)
    ranged = in_ranges(points, "low", cuts, "range").select("range", "low", F.col("low").alias("high"), "s", "w")
    blocks = settle(ranged.groupBy("range").applyInArrow(_pool_range, _BLOCKS))
    for _ in range(math.ceil(math.log2(len(cuts) + 1))):
        blocks = settle(merged(blocks))
    return blocks.select("low", "high", (F.col("s") / F.col("w")).alias("value"), F.col("w").cast("bigint").alias("n"))


@dataclass
class Isotonic:
    """A rising function: constant in each block, a line between blocks, constant outside."""

    blocks: DataFrame
    shipped_ends: int = SHIPPED_ENDS

    def ends(self) -> DataFrame:
        """(x, v): both ends of every block."""
        return self.blocks.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("x"), F.col("value").alias("v"))

    def apply(self, df: DataFrame, score: str, name: str = "y_calib") -> DataFrame:
        """Add the calibrated score; null for a null score, and for all where nothing was fitted."""
        table = self.ends().limit(self.shipped_ends + 1).toArrow()
        if table.num_rows > self.shipped_ends:
            return self._apply_by_ranges(df, score, name)
        if table.num_rows == 0:
            return df.withColumn(name, F.lit(None).cast("double"))
        order = np.argsort(table["x"].to_numpy())
        x, v = table["x"].to_numpy()[order], table["v"].to_numpy()[order]

        @F.pandas_udf("double")
        def calibrated(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for scores in batches:
                yield pd.Series(np.interp(scores.to_numpy(dtype=float), x, v))

        value = F.col(score).cast("double")
        return df.withColumn(name, F.when(value.isNotNull() & ~F.isnan(value), calibrated(value)))

    def _apply_by_ranges(self, df: DataFrame, score: str, name: str) -> DataFrame:
        """The same by sorting rows among the ends of their range; each range also has the nearest ends outside it."""
        ends = settle(self.ends())
        cuts = cut_points(ends, "x", self.shipped_ends)
        ranged = in_ranges(ends, "x", cuts, "_range")
        # A few rows a range: the last end before it and the first one after it.
        edges = ranged.groupBy("_range").agg(F.min(F.struct("x", "v")).alias("first"), F.max(F.struct("x", "v")).alias("last")).orderBy("_range").collect()
        near = []
        for r in range(len(cuts) + 1):
            before, after = [e["last"] for e in edges if e["_range"] < r], [e["first"] for e in edges if e["_range"] > r]
            near += [(r, *before[-1])] if before else []
            near += [(r, *after[0])] if after else []
        every = ranged.select("_range", "x", "v").unionByName(df.sparkSession.createDataFrame(near, "_range int, x double, v double"))
        copies = every.select("_range", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.col("x").alias("_x"), F.col("v").alias("_v"))
        value = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
        rows = in_ranges(df.withColumn("_x", value).where(F.col("_x").isNotNull()), "_x", cuts, "_range")
        rows = rows.withColumn("_salt", F.pmod(F.hash(*[F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]), F.lit(SALTS)).cast("int")).withColumn("_row", F.lit(True))
        met = rows.unionByName(copies, allowMissingColumns=True)
        spot = Window.partitionBy("_range", "_salt").orderBy("_x")
        end = F.when(F.col("_row").isNull(), F.struct("_x", "_v"))
        # Range frames: an end at the row's own score counts on both sides.
        below = F.max(end).over(spot.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        above = F.min(end).over(spot.rangeBetween(Window.currentRow, Window.unboundedFollowing))
        both = met.withColumns({"_a": below, "_b": above}).where("_row")
        step = F.col("_b._v") - F.col("_a._v")
        line = F.col("_a._v") + step * F.try_divide(F.col("_x") - F.col("_a._x"), F.col("_b._x") - F.col("_a._x"))
        out = both.withColumn(name, F.coalesce(F.when(F.col("_a").isNull(), F.col("_b._v")), F.when(F.col("_b").isNull() | (step == 0) | (F.col("_a._x") == F.col("_b._x")), F.col("_a._v")), line))
        missing = df.where(F.coalesce(F.isnan(F.col(score).cast("double")), F.lit(True)) | F.col(score).isNull()).withColumn(name, F.lit(None).cast("double"))
        return out.select(*[F.col(f"`{c}`") for c in df.columns], name).unionByName(missing)

    def equation(self) -> None:
        return None


def fit_isotonic(df: DataFrame, score: str, label: str, *, rows_per_range: int = ROWS_PER_RANGE, shipped_ends: int = SHIPPED_ENDS) -> Isotonic:
    """Blocks in the shared folder and what applies them."""
    return Isotonic(settle(isotonic_blocks(df, score, label, rows_per_range=rows_per_range)), shipped_ends)
