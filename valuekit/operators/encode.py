"""Category dictionaries and their application."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.functions.columns import MISSING_CATEGORY, blank_free_lower
from valuekit.operators.frames import long_text
from valuekit.operators.ranks import dense_codes
from valuekit.session import settle

#: Rows of a dictionary that are shipped with a task: a bound on memory, codes are the same beyond it.
HELD_ROWS = 200_000


def fit_dictionary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, code): sorted distinct values numbered from 0, null as "NA"."""
    values = long_text(df, [], features).select("feature", F.coalesce("value", F.lit(MISSING_CATEGORY)).alias("value"))
    return dense_codes(values, ["feature"], "value")


def add_features(dictionary: DataFrame, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Extend a dictionary by features it does not have; present ones keep their codes."""
    fresh = fit_dictionary(df, features).join(dictionary.select("feature").distinct(), "feature", "left_anti")
    return dictionary.unionByName(fresh)


def fit_global_dictionary(frames: Sequence[DataFrame], features: Sequence[str]) -> DataFrame:
    """One dictionary over many tables.

    Values that contain blanks also enter in blank-free lower case, and every feature knows null,
    the empty string and a single blank.
    """
    parts = [long_text(df, [], [f for f in features if f in df.columns]).distinct() for df in frames]
    seen = reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull())
    variants = F.when(F.contains("value", F.lit(" ")), F.array(F.col("value"), blank_free_lower(F.col("value")))).otherwise(F.array(F.col("value")))
    grown = seen.select("feature", F.explode(variants).alias("value"))
    always = seen.select("feature").distinct().select(
        "feature", F.explode(F.array(F.lit(MISSING_CATEGORY), F.lit(""), F.lit(" "))).alias("value")
    )
    return dense_codes(grown.unionByName(always), ["feature"], "value")


def category_sizes(dictionary: DataFrame, features: Sequence[str]) -> dict[str, int]:
    """Number of codes by feature, for `clean.mark_categories`."""
    rows = dictionary.where(F.col("feature").isin(*features)).groupBy("feature").agg(F.max("code").alias("last")).collect()
    return {r["feature"]: int(r["last"]) + 1 for r in rows}


def encode(df: DataFrame, dictionary: DataFrame, features: Sequence[str], normalise: bool = False, held_rows: int = HELD_ROWS) -> DataFrame:
    """Replace categories by codes.

    Null counts as "NA"; an unseen value gets the code of "NA" when the dictionary has it, else 0.
    With `normalise` values are stripped of blanks and lower-cased first. The dictionary is evaluated once and written.
    Its smallest features, as many as have `held_rows` rows together, are looked up in one vectorised pass over the
    rows; each other one is joined, where adaptive execution splits a hot value.
    """
    wanted = settle(dictionary.where(F.col("feature").isin(*features)).select("feature", "value", F.col("code").cast("bigint").alias("code")))
    # One row a feature: its size and the code of "NA".
    sizes = wanted.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("value") == MISSING_CATEGORY, F.col("code"))).alias("missing")).orderBy("n", "feature").collect()
    fallback = {r["feature"]: r["missing"] or 0 for r in sizes}
    held, total = [f for f in features if f not in fallback], 0
    for r in sizes:
        total += r["n"]
        if total <= held_rows:
            held.append(r["feature"])

    def text(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        return F.coalesce(blank_free_lower(value) if normalise else value, F.lit(MISSING_CATEGORY))

    out = df
    for name in dict.fromkeys(f for f in features if f not in held):
        one = wanted.where(F.col("feature") == name).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        joined = out.withColumn("_text", text(name)).join(one, F.col("_text") == F.col("_value"), "left")
        out = joined.withColumn(name, F.coalesce("_code", F.lit(fallback[name]))).drop("_code", "_value", "_text")
    if held:
        found = _lookup(wanted.where(F.col("feature").isin(*held)), held, fallback)
        coded = out.withColumn("_codes", found(F.struct(*[text(f).alias(f"f{i}") for i, f in enumerate(held)])))
        out = coded.withColumns({f: F.col(f"_codes.f{i}") for i, f in enumerate(held)}).drop("_codes")
    return out.select(*[f"`{c}`" for c in df.columns])


def _lookup(dictionary: DataFrame, features: Sequence[str], fallback: Mapping[str, int]) -> Callable[[Column], Column]:
    """A vectorised function from a struct of texts to a struct of codes; the dictionary has a checked number of rows."""
    table = dictionary.toArrow().to_pandas()
    codes = {i: (part["value"].to_numpy(dtype=object), part["code"].to_numpy()) for i, f in enumerate(features) if len(part := table[table["feature"] == f])}
    rest = [fallback.get(f, 0) for f in features]
    shipped = dictionary.sparkSession.sparkContext.broadcast((codes, rest))

    @F.pandas_udf(", ".join(f"f{i} bigint" for i in range(len(features))))
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, other = shipped.value
        indexes = {i: pd.Index(values) for i, (values, _) in known.items()}
        for batch in batches:
            out = {}
            for i, missing in enumerate(other):
                if i not in known:
                    out[f"f{i}"] = np.full(len(batch), missing, np.int64)
                    continue
                place = indexes[i].get_indexer(batch.iloc[:, i])
                out[f"f{i}"] = np.where(place >= 0, known[i][1][place], missing)
            yield pd.DataFrame(out)

    return found


def pending_rows(source: DataFrame, encoded: DataFrame, key: str) -> DataFrame:
    """Rows of `source` whose key is not in `encoded` yet, for resuming a broken run. A null key is a key like others."""
    done = encoded.select(F.col(key).alias("_done"))
    return source.join(done, F.col(key).eqNullSafe(F.col("_done")), "left_anti")


def code_of(dictionary: DataFrame, feature: str, value: str) -> Column:
    """The code of one value as a scalar subquery, for filters on encoded columns."""
    hit = dictionary.where((F.col("feature") == feature) & (F.col("value") == value))
    return hit.agg(F.max("code").alias("code")).scalar()


def tokens(df: DataFrame, column: str, categories: Sequence[str] | None = None) -> DataFrame:
    """(value, token): listed categories (or all distinct values) numbered; the rest is -1."""
    values = df.select(F.col(column).alias("value")).distinct()
    if categories is not None:
        position = F.array_position(F.lit([*categories]), F.col("value")).cast("bigint") - 1
        return values.select("value", F.coalesce(position, F.lit(-1)).alias("token"))
    codes = dense_codes(values.where(F.col("value").isNotNull()).withColumn("_all", F.lit(0)), ["_all"], "value", "token")
    missing = values.where(F.col("value").isNull()).select("value", F.lit(-1).cast("bigint").alias("token"))
    return codes.select("value", "token").unionByName(missing)
