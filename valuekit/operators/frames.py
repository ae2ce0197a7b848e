"""Reshaping helpers used by the feature-wise operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.roles import require_columns


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns both sides have, where null meets null: a group without a name is a group too."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    met = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_right_{k}`")) for k in keys]
    return left.join(renamed, met, how).drop(*[f"_right_{k}" for k in keys])


def long_numeric(df: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(ids, feature, value): one row per numeric feature, NaN as null.

    Turns a loop over columns into one grouped job.
    """
    require_columns(df, [*ids, *features])
    narrow = df.selectExpr(*[f"`{c}`" for c in ids], *[f"nanvl(CAST(`{c}` AS DOUBLE), NULL) AS `{c}`" for c in features])
    return narrow.unpivot([*ids], [*features], "feature", "value")


def long_text(df: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(ids, feature, value): one row per categorical feature, values as strings."""
    require_columns(df, [*ids, *features])
    narrow = df.selectExpr(*[f"`{c}`" for c in ids], *[f"CAST(`{c}` AS STRING) AS `{c}`" for c in features])
    return narrow.unpivot([*ids], [*features], "feature", "value")
