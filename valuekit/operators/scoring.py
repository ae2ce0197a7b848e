"""Batch scoring: uplift curves over T, value scores, segments, pending pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.operators.training import Fitted, Formula, vector_inputs
from valuekit.session import settle

# Last period of the curve, and the pair of different products that still count as
# one at T = 0.
LAST_PERIOD = 12
SAME_AT_START = (("kp", "pl"),)
#: Pairs whose mean uplifts are summed in one pass over the rows.
PAIRS_AT_ONCE = 5


@dataclass(frozen=True)
class Window:
    first: int
    last: int

    def periods(self, base: str, sold: str) -> list[int]:
        skip_start = base == sold or (base, sold) in SAME_AT_START
        return [t for t in range(self.first, self.last + 1) if 0 <= t <= LAST_PERIOD and not (skip_start and t == 0)]


def windows_by_pair(periods: DataFrame) -> dict[tuple[str, str], Window]:
    """Period window per pair from the configuration table (one row per pair)."""
    rows = periods.select("bp", "sp", F.col("T_min").cast("int"), F.col("T_max").cast("int")).collect()
    return {(r["bp"], r["sp"]): Window(r["T_min"], r["T_max"]) for r in rows}


def pair_windows(pairs: DataFrame, periods: DataFrame, default: Window) -> DataFrame:
    """(bp, sp, T_min, T_max) for every wanted pair; a pair without a row in `periods` gets the default window."""
    rows = periods.select("bp", "sp", F.col("T_min").cast("int").alias("_min"), F.col("T_max").cast("int").alias("_max"))
    joined = pairs.select("bp", "sp").join(rows, ["bp", "sp"], "left")
    return joined.select("bp", "sp", F.coalesce("_min", F.lit(default.first)).alias("T_min"), F.coalesce("_max", F.lit(default.last)).alias("T_max"))


def uplift_curve(df: DataFrame, fitted: Fitted | Formula, base: str, sold: str, window: Window, *, treatment: str, period: str = "T", name: str | None = None, digits: int = 5) -> DataFrame:
    """Add the 13-element uplift array: P(y | treated, T) - P(y | untreated, T).

    Each probability is rounded before the difference; periods outside the window are NaN. Every
    (T, arm) is one more vector on the same row, so the plan has no explode and no shuffle.
    """
    out_name = name or f"{base}_{sold}"
    plain = {f"_v_{f}": c for f, c in vector_inputs(df, [f for f in fitted.features if f not in (period, treatment)]).items()}
    rows = df.withColumns(plain)
    wanted = window.periods(base, sold)
    for t in wanted:
        for arm in (0, 1):
            fixed = {period: f"_t{t}", treatment: f"_a{arm}"}
            inputs = [fixed.get(f, f"_v_{f}") for f in fitted.features]
            with_point = rows.withColumns({f"_t{t}": F.lit(float(t)), f"_a{arm}": F.lit(float(arm))})
            assembled = VectorAssembler(inputCols=inputs, outputCol="_x").transform(with_point)
            rows = fitted.score_vector(assembled, "_x", f"_p{t}_{arm}").drop("_x", f"_t{t}", f"_a{arm}")

    def at(t: int) -> Column:
        if t not in wanted:
            return F.lit(float("nan"))
        return F.round(f"_p{t}_1", digits) - F.round(f"_p{t}_0", digits)

    return rows.withColumn(out_name, F.array(*[at(t) for t in range(LAST_PERIOD + 1)])).select(*df.columns, out_name)


def _period_uplifts(df: DataFrame, key: str | None, models: Mapping[tuple[str, str], Fitted | Formula], windows: Mapping[tuple[str, str], Window], default: Window, treatment: str | None, period: str) -> tuple[DataFrame, dict[tuple[str, str], Column], dict[tuple[str, str], str]]:
    """Rows of (_key, _t, ...) for each row and period, each pair's uplift as a column of them (NaN outside its window), and the error of each pair that cannot be scored.

    Models with the same features and treatment share the vectors of both arms; formulas need none and are evaluated on
    the columns.
    """
    failed = {}
    known = list(dict.fromkeys(f for m in models.values() for f in m.features if f in df.columns))
    # Two steps: an alias inside the inputs carries the mark of a category, which a second alias would lose.
    values = df.withColumns({f"_v_{f}": c for f, c in vector_inputs(df, known).items()})
    prepared = values.select(*([F.col(key).alias("_key")] if key else []), *[f"_v_{f}" for f in known])
    periods = F.explode(F.sequence(F.lit(0), F.lit(LAST_PERIOD))).alias("_t")
    rows = prepared.select("*", periods).withColumns({"_period": F.col("_t").cast("double"), "_arm_0": F.lit(0.0), "_arm_1": F.lit(1.0)})
    vectors, done = {}, {}
    for i, ((base, sold), fitted) in enumerate(models.items()):
        moved = treatment or base
        missing = [f for f in fitted.features if f not in (*known, period, moved)]
        if missing:
            failed[(base, sold)] = f"columns not found: {', '.join(missing)}"
            continue
        inputs = [[{period: "_period", moved: f"_arm_{arm}"}.get(f, f"_v_{f}") for f in fitted.features] for arm in (0, 1)]
        if isinstance(fitted, Formula):
            chance = [fitted.expression({f: F.col(c).cast("double") for f, c in zip(fitted.features, names, strict=True)}) for names in inputs]
        else:
            if (fitted.features, moved) not in vectors:
                vectors[fitted.features, moved] = f"_x_{len(vectors)}"
                for arm in (0, 1):
                    rows = VectorAssembler(inputCols=inputs[arm], outputCol=f"{vectors[fitted.features, moved]}_{arm}").transform(rows)
            for arm in (0, 1):
                rows = fitted.score_vector(rows, f"{vectors[fitted.features, moved]}_{arm}", f"_p_{i}_{arm}")
            chance = [F.col(f"_p_{i}_{arm}") for arm in (0, 1)]
        inside = F.col("_t").isin(windows.get((base, sold), default).periods(base, sold))
        done[base, sold] = F.when(inside, F.round(chance[1], 5) - F.round(chance[0], 5)).otherwise(float("nan"))
    return rows, done, failed


def uplift_all(df: DataFrame, key: str, models: Mapping[tuple[str, str], Fitted | Formula], windows: Mapping[tuple[str, str], Window], *, default: Window = Window(0, LAST_PERIOD), treatment: str | None = None, period: str = "T") -> tuple[DataFrame, dict[tuple[str, str], str]]:
    """(key, bp, sp, uplift) of every pair, and the error of each pair that cannot be scored.

    The rows are read once for any number of models. A row becomes one for each period; then its periods, which still
    follow each other, are put back into one array for each pair. Nothing is shuffled. A pair without a window of its
    own gets the default one; `treatment` is the base product unless it is named.
    """
    rows, done, failed = _period_uplifts(df, key, models, windows, default, treatment, period)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL("bp string, sp string, uplift array<double>").fields])
    if not done:
        return df.sparkSession.createDataFrame([], schema), failed
    return rows.select("_key", F.array(*done.values()).alias("u")).mapInArrow(_packed([b for b, _ in done], [s for _, s in done], key), schema), failed


def mean_uplifts(df: DataFrame, models: Mapping[tuple[str, str], Fitted | Formula], windows: Mapping[tuple[str, str], Window], *, default: Window = Window(0, LAST_PERIOD), treatment: str | None = None, period: str = "T") -> tuple[DataFrame, dict[tuple[str, str], str]]:
    """(bp, sp, T, n, uplift): rows and mean uplift of each pair and period with any, and the error of each pair that cannot be scored.

    The means of the arrays of `uplift_all`, which are not built: a row and period adds to one sum for each pair. The
    columns are written once, and PAIRS_AT_ONCE pairs at a time are summed from them: the code for all pairs is a
    method too large for the JVM's compiler.
    """
    kept = settle(df.select(*dict.fromkeys(f for m in models.values() for f in m.features if f in df.columns)))
    out = df.sparkSession.createDataFrame([], "bp string, sp string, T int, n bigint, uplift double")
    pairs, failed = list(models), {}
    for at in range(0, len(pairs), PAIRS_AT_ONCE):
        rows, done, wrong = _period_uplifts(kept, None, {p: models[p] for p in pairs[at : at + PAIRS_AT_ONCE]}, windows, default, treatment, period)
        failed |= wrong
        if not done:
            continue
        sums = [a for i, u in enumerate(done.values()) for a in (F.count_if(~F.isnan(u)).alias(f"n_{i}"), F.avg(F.nanvl(u, F.lit(None).cast("double"))).alias(f"u_{i}"))]
        cells = F.array(*[F.struct(F.lit(b).alias("bp"), F.lit(s).alias("sp"), F.col("_t").alias("T"), F.col(f"n_{i}").alias("n"), F.col(f"u_{i}").alias("uplift")) for i, (b, s) in enumerate(done)])
        out = out.unionByName(rows.groupBy("_t").agg(*sums).select(F.explode(cells).alias("_c")).select("_c.*").where("n > 0"))
    return out, failed


def _packed(bases: list[str], solds: list[str], key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every LAST_PERIOD + 1 rows of (key, one value per pair) as one row per pair with an array of the values."""
    periods, pairs = LAST_PERIOD + 1, len(bases)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            whole = table.num_rows // periods * periods
            rest = table.slice(whole)
            held = pa.RecordBatch.from_arrays([c.combine_chunks() for c in rest.columns], schema=batch.schema) if rest.num_rows else None
            if not whole:
                continue
            rows = whole // periods
            values = table["u"].slice(0, whole).combine_chunks().flatten().to_numpy().reshape(rows, periods, pairs).transpose(0, 2, 1)
            keys = table["_key"].take(pa.array(np.repeat(np.arange(rows) * periods, pairs))).combine_chunks()
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(rows * pairs + 1, dtype=np.int32) * periods), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(bases * rows), pa.array(solds * rows), arrays], names=[key, "bp", "sp", "uplift"])

    return pack


def uplift_long(scored: DataFrame, key: str, name: str) -> DataFrame:
    """(key, pair, T, uplift) with the periods of the window only."""
    long = scored.select(key, F.lit(name).alias("pair"), F.posexplode(name).alias("T", "uplift"))
    return long.where(~F.isnan("uplift"))


def npv_score(df: DataFrame, fitted: Fitted, name: str, encode: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Value score rounded to 2 digits, after an optional encoder."""
    ready = encode(df) if encode else df
    return fitted.score(ready, name).withColumn(name, F.round(name, 2))


def by_segment(df: DataFrame, condition: Column, when_true: Callable[[DataFrame], DataFrame], otherwise: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score two segments with their own models and put them back together.

    Splitting first means that each model sees only its rows; a CASE would run both on all.
    """
    holds = F.coalesce(condition, F.lit(False))
    return when_true(df.where(holds)).unionByName(otherwise(df.where(~holds)))


def score_with(df: DataFrame, predict: Callable[[pd.DataFrame], pd.Series], features: Sequence[str], keep: Sequence[str], name: str = "score") -> DataFrame:
    """Extension point for models Spark does not have: `predict` gets Arrow batches as pandas."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[list(keep)].copy()
            out[name] = predict(batch[list(features)])
            yield out

    wanted = df.select(*dict.fromkeys([*keep, *features]))
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return wanted.mapInPandas(run, f"{schema}, `{name}` double")


def pending_pairs(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Wanted (bp, sp) pairs that no score table holds yet."""
    return wanted.join(done.select("bp", "sp").distinct(), ["bp", "sp"], "left_anti")


def scored_pairs(spark: SparkSession, tables: Iterable[DataFrame], key: str) -> DataFrame:
    """(bp, sp) of every score column found in existing score tables; reads schemas only."""
    names = sorted({c for t in tables for c in t.columns if c != key and "_" in c})
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    parts = F.split("name", "_", 2)
    return frame.select(parts[0].alias("bp"), parts[1].alias("sp"))


def score_pairs(df: DataFrame, key: str, pairs: Sequence[tuple[str, str]], scorer: Callable[[DataFrame, str, str], DataFrame], write: Callable[[DataFrame, str], None], *, exists: Callable[[str], bool] = lambda name: False, date: str = "") -> list[dict]:
    """Score pairs in order and write one table each; a failing pair does not stop the others.

    Existing tables are skipped, so a broken run can simply be started again.
    """
    results = []
    for i, (base, sold) in enumerate(pairs, 1):
        name = f"uplifts_{base}_{sold}_{date}".rstrip("_")
        status, error = "skipped", None
        if not exists(name):
            try:
                write(scorer(df, base, sold).select(key, f"{base}_{sold}"), name)
                status = "scored"
            except Exception as problem:  # noqa: BLE001 - reported per pair
                status, error = "failed", str(problem).splitlines()[0]
        results.append({"bp": base, "sp": sold, "table": name, "status": status, "error": error, "done_percent": round(100 * i / len(pairs), 2)})
    return results

