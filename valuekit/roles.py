"""Column roles of a modelling frame and the checks that depend on them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The sample names every report knows, in report order.
SAMPLES = ("train", "valid", "test", "test2", "OOT", "OOT_psi")


class AbsentColumns(ValueError):
    """A required column is absent from the frame."""


@dataclass(frozen=True)
class Roles:
    id: tuple[str, ...]
    target: str
    sample: str = "sample"
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    drop: tuple[str, ...] = field(default=())

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return `df` unchanged, or raise when a required column is missing."""
    missed = sorted(set(columns) - set(df.columns))
    if missed:
        raise AbsentColumns(f"the frame lacks {missed}")
    return df


def categorical_columns(df: DataFrame, listed: Sequence[str] = (), excluded: Sequence[str] = ()) -> list[str]:
    """String columns plus the listed ones that exist, minus the excluded, sorted."""
    by_type = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return sorted((by_type | (set(listed) & set(df.columns))) - set(excluded))


def numeric_columns(df: DataFrame, excluded: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in set(excluded)]


def drop_roles(df: DataFrame, roles: Roles, keep_target: bool = False) -> DataFrame:
    """Remove garbage columns and, unless asked otherwise, the target."""
    gone = set(roles.drop) | (set() if keep_target else {roles.target})
    return df.drop(*[c for c in df.columns if c in gone])


def align_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """Give `df` the columns of `like`, in that order."""
    return require_columns(df, like.columns).select(*like.columns)


def drop_matching(columns: Sequence[str], tokens: Sequence[str], protected: Sequence[str] = ()) -> list[str]:
    """Names that contain one of `tokens` and none of `protected` (case-insensitive)."""

    def has(name: str, parts: Sequence[str]) -> bool:
        return any(p.lower() in name.lower() for p in parts)

    return [c for c in columns if has(c, tokens) and not has(c, protected)]


def promote_new(df: DataFrame, suffix: str = "_new") -> DataFrame:
    """Where both `x` and `x_new` exist, `x_new` replaces `x`; a lone `x_new` is renamed."""
    fresh = {c: c.removesuffix(suffix) for c in df.columns if c.endswith(suffix)}
    return df.drop(*fresh.values()).withColumnsRenamed(fresh)
