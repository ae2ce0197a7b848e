"""Exact Gini of every prefix of a boosted ensemble, without a row per prefix.

A model of P trees is P models, one for each number of trees kept. Their scores are running sums over the trees of a
row, so one narrow pass has them all. Tasks keep a histogram of scores for each (sample, prefix) and hand on bins:
events, non-events, and the lowest and highest score. Order between bins is known. Inside a bin it matters only where
both classes meet at different scores; a second pass sums those scores alone, merged in the task first. Early prefixes
have few different scores, so nearly all of their bins hold a single one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuekit.operators.frames import join_on
from valuekit.operators.ranks import running_totals
from valuekit.session import settle

#: Bins of a (sample, prefix): they bound a task's histogram and leave the result as it is.
BINS = 1024
#: Scores that a task merges before it hands them on.
HELD_SCORES = 1_000_000
_BIN_ROWS = "slot int, prefix int, bin int, pos bigint, neg bigint, low double, high double"
_SCORE_ROWS = "slot int, prefix int, bin int, margin double, pos bigint, neg bigint"


def tree_predictions(model, df: DataFrame, vector: str, keep: Sequence[str]) -> DataFrame:
    """(keep, trees): what each tree of the model says, as one array."""
    rows = df
    for i, tree in enumerate(model.trees):
        rows = tree.transform(rows, {tree.featuresCol: vector, tree.predictionCol: f"_t{i}"})
    return rows.select(*keep, F.array(*[f"_t{i}" for i in range(len(model.trees))]).alias("trees"))


def _margins(batch: pa.RecordBatch, weights: np.ndarray) -> np.ndarray:
    trees = batch.column(2).flatten().to_numpy().reshape(-1, len(weights))
    return np.cumsum(trees * weights, axis=1)


def _stands_for(batch: pa.RecordBatch) -> np.ndarray:
    """The number of equal rows each row stands for: the fourth column, or 1."""
    return batch.column(3).to_numpy().astype(np.int64) if batch.num_columns > 3 else np.ones(batch.num_rows, np.int64)


def _bins(margins: np.ndarray, n_bins: int) -> np.ndarray:
    """Bins by the probability that a margin stands for, which rises with it."""
    return np.minimum((n_bins / (1 + np.exp(-2 * margins))).astype(np.int64), n_bins - 1)


def prefix_bins(rows: DataFrame, weights: Sequence[float], n_slots: int, n_bins: int = BINS) -> DataFrame:
    """(slot, prefix, bin, pos, neg, low, high) from rows of (slot, label, trees, perhaps how many equal rows); prefixes count from 1."""
    w = np.array(weights)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = n_slots * len(w) * n_bins
        counts = np.zeros((2, size), np.int64)
        low, high = np.full(size, np.inf), np.full(size, -np.inf)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            margins, y, n = _margins(batch, w), batch.column(1).to_numpy(), _stands_for(batch)
            spot = (batch.column(0).to_numpy().astype(np.int64)[:, None] * len(w) + np.arange(len(w))) * n_bins + _bins(margins, n_bins)
            for label in (0, 1):
                np.add.at(counts[label], spot[y == label].ravel(), np.repeat(n[y == label], len(w)))
            np.minimum.at(low, spot.ravel(), margins.ravel())
            np.maximum.at(high, spot.ravel(), margins.ravel())
        used = np.flatnonzero(counts.sum(0))
        at = [used // (len(w) * n_bins), used // n_bins % len(w) + 1, used % n_bins]
        columns = [*(pa.array(a.astype(np.int32)) for a in at), pa.array(counts[1][used]), pa.array(counts[0][used]), pa.array(low[used]), pa.array(high[used])]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "prefix", "bin", "pos", "neg", "low", "high"])

    sums = [F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.min("low").alias("low"), F.max("high").alias("high")]
    return rows.mapInArrow(count, _BIN_ROWS).groupBy("slot", "prefix", "bin").agg(*sums)


def mixed_scores(rows: DataFrame, weights: Sequence[float], mixed: np.ndarray) -> DataFrame:
    """(slot, prefix, bin, margin, pos, neg) of the bins flagged in `mixed`, an array by slot, prefix and bin."""
    w, n_bins = np.array(weights), mixed.shape[2]
    flags = rows.sparkSession.sparkContext.broadcast(np.packbits(mixed.ravel()).tobytes())
    held = HELD_SCORES

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(flags.value, np.uint8))
        parts: list[tuple[np.ndarray, ...]] = []
        kept = 0

        def merged() -> tuple[np.ndarray, ...]:
            spot, margin, pos, neg = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((margin, spot))
            spot, margin = spot[order], margin[order]
            first = np.flatnonzero(np.concatenate([[True], (spot[1:] != spot[:-1]) | (margin[1:] != margin[:-1])]))
            return spot[first], margin[first], np.add.reduceat(pos[order], first), np.add.reduceat(neg[order], first)

        def out(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            spot, margin, pos, neg = found
            at = [spot // (len(w) * n_bins), spot // n_bins % len(w) + 1, spot % n_bins]
            return pa.RecordBatch.from_arrays([*(pa.array(a.astype(np.int32)) for a in at), pa.array(margin), pa.array(pos), pa.array(neg)], ["slot", "prefix", "bin", "margin", "pos", "neg"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            margins, y, n = _margins(batch, w), batch.column(1).to_numpy().astype(np.int64), _stands_for(batch)
            spot = (batch.column(0).to_numpy().astype(np.int64)[:, None] * len(w) + np.arange(len(w))) * n_bins + _bins(margins, n_bins)
            row, column = np.nonzero(wanted[spot])
            parts.append((spot[row, column], margins[row, column], (y * n)[row], ((1 - y) * n)[row]))
            kept += len(row)
            if kept > held:
                found = merged()
                # Where merging does not help any more, the rows go on.
                if 2 * len(found[0]) > held:
                    yield out(found)
                    parts, kept = [], 0
                else:
                    parts, kept = [found], len(found[0])
        if kept:
            yield out(merged())

    return rows.mapInArrow(pick, _SCORE_ROWS).groupBy("slot", "prefix", "bin", "margin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def prefix_auc(rows: DataFrame, weights: Sequence[float], sample: str, label: str, n_bins: int = BINS, weight: str | None = None) -> DataFrame:
    """(sample, n_trees, n_rows, n_events, auc) from rows of (sample, label, trees); rows without a label are left out.

    `weight` names a column with the number of equal rows a row stands for.
    """
    # Names of samples are configuration; a null one is a sample too.
    names = [r[0] for r in rows.select(sample).distinct().collect()]
    slot = F.coalesce(*[F.when(F.col(sample).eqNullSafe(F.lit(n)), F.lit(i)) for i, n in enumerate(names)], F.lit(-1)) if names else F.lit(-1)
    numbered = rows.where(F.col(label).isNotNull()).select(slot.cast("int").alias("slot"), F.col(label).cast("int").alias("y"), "trees", *([] if weight is None else [F.col(weight).cast("bigint").alias("n")]))
    numbered = settle(numbered)
    bins = settle(prefix_bins(numbered, weights, max(1, len(names)), n_bins))
    mixed = np.zeros((max(1, len(names)), len(weights), n_bins), bool)
    # At most one row a bin, and the bins are bounded.
    for r in bins.where("pos > 0 AND neg > 0 AND low < high").select("slot", "prefix", "bin").toLocalIterator():
        mixed[r.slot, r.prefix - 1, r.bin] = True
    sums = {"pos": F.sum("pos"), "neg": F.sum("neg")}
    ordered = running_totals(mixed_scores(numbered, weights, mixed), ["slot", "prefix", "bin"], "margin", sums)
    pairs = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)).alias("inside")
    inside = ordered.groupBy("slot", "prefix", "bin").agg(pairs)
    below = F.coalesce(F.sum("neg").over(Window.partitionBy("slot", "prefix").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = bins.withColumn("below", below).join(inside, ["slot", "prefix", "bin"], "left")
    won = F.sum(F.col("pos").cast("double") * F.col("below") + F.coalesce("inside", F.col("pos") * F.col("neg") / 2))
    got = whole.groupBy("slot", "prefix").agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n_rows"),
        F.sum("pos").alias("n_events"),
        F.try_divide(won, F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))).alias("auc"),
    )
    named = rows.sparkSession.createDataFrame(list(enumerate(names)), f"slot int, `{sample}` {rows.schema[sample].dataType.simpleString()}")
    return join_on(got, named, ["slot"]).select(sample, F.col("prefix").alias("n_trees"), "n_rows", "n_events", "auc")
