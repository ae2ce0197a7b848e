"""Column pruning, outlier trimming, type compaction and export clean-up.

Everything that looks at data does so in one aggregate over all columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.functions.columns import finite_or, known, null_text, whole_or_null
from valuekit.operators.frames import long_text
from valuekit.operators.ranks import pinned, quantiles

# Integer ranges and the type that holds them, narrowest first. Unsigned ranges have
# no Spark type of their own, so they take the next wider signed one.
INTEGER_RANGES = (
    ("uint8", 0, 2**8 - 1, "smallint"),
    ("uint16", 0, 2**16 - 1, "int"),
    ("uint32", 0, 2**32 - 1, "bigint"),
    ("uint64", 0, 2**64 - 1, "decimal(20,0)"),
    ("int8", -(2**7), 2**7 - 1, "tinyint"),
    ("int16", -(2**15), 2**15 - 1, "smallint"),
    ("int32", -(2**31), 2**31 - 1, "int"),
    ("int64", -(2**63), 2**63 - 1, "bigint"),
)


def _value(df: DataFrame, name: str) -> Column:
    """The column with NaN as null for floating types."""
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return known(F.col(name)) if floating else F.col(name)


def column_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, is_constant, null_share) for each column.

    A column is constant when it has fewer than two levels, null being a level. Comparing minimum
    and maximum answers that without counting distinct values.
    """
    parts = []
    for c in columns:
        v = _value(df, c)
        parts += [
            F.coalesce(F.min(v) == F.max(v), F.lit(True)).alias(f"{c}|same"),
            F.sum(v.isNull().cast("bigint")).alias(f"{c}|nulls"),
        ]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *parts)
    entry = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}|same`").alias("same"), F.col(f"`{c}|nulls`").alias("nulls")) for c in columns
    ])
    rows = wide.select("n", F.explode(entry).alias("e"))
    any_value, any_null = F.col("e.nulls") < F.col("n"), F.col("e.nulls") > 0
    return rows.select(
        F.col("e.column").alias("column"),
        (F.col("e.same") & ~(any_value & any_null)).alias("is_constant"),
        F.try_divide(F.col("e.nulls").cast("double"), F.col("n")).alias("null_share"),
    )


def drop_constant(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop columns with a single level. Runs one aggregate to learn the schema."""
    levels = column_levels(df, columns or df.columns).where("is_constant").collect()
    return df.drop(*[r["column"] for r in levels])


def drop_sparse(df: DataFrame, limit: float = 0.5, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop columns whose share of missing values exceeds `limit`."""
    levels = column_levels(df, columns or df.columns).where(F.col("null_share") > limit).collect()
    return df.drop(*[r["column"] for r in levels])


def trim_outliers(df: DataFrame, target: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Keep rows strictly between two percentiles of the target."""
    edges = quantiles(df, [], target, [low, high], name="edges").select("edges").scalar()
    return df.where((F.col(target) > edges[0]) & (F.col(target) < edges[1]))


def trim_eval_sets(df: DataFrame, target: str, sample: str = "sample", low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Trim train and valid, keep the other samples whole, add the trimmed test as `test2`."""
    edges = quantiles(df.where(F.col(sample).isin("train", "valid", "test")), [sample], target, [low, high], name="_edges")
    joined = df.join(pinned(edges.select(sample, "_edges")), sample, "left")
    inside = (F.col(target) > F.col("_edges")[0]) & (F.col(target) < F.col("_edges")[1])
    # A test row goes out once whole and, when inside, once more as test2.
    names = F.when(F.col(sample).isin("train", "valid"), F.when(inside, F.array(F.col(sample)))).when(
        (F.col(sample) == "test") & inside, F.array(F.col(sample), F.lit("test2"))
    ).otherwise(F.array(F.col(sample)))
    columns = [c for c in df.columns if c != sample]
    return joined.select(*columns, F.explode(names).alias(sample))


def number_like_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """String columns in which every non-null value parses as a number (all or nothing)."""
    bad = df.agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in columns
    ]).first()
    return [c for c in columns if bad[c] == 0]


def cast_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn number-like string columns into doubles, leave the others alone."""
    texts = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    return df.withColumns({c: F.col(c).try_cast("double") for c in number_like_columns(df, texts)})


def type_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, min, max, has_null, integerable, type): the narrowest type for each number column.

    A column can be an integer when it has no missing value and its fractional parts add up to
    less than 0.01.
    """
    parts = []
    for c in columns:
        v = _value(df, c).cast("double")
        parts += [
            F.min(v).alias(f"{c}|min"),
            F.max(v).alias(f"{c}|max"),
            F.max(v.isNull()).alias(f"{c}|null"),
            F.sum(F.abs(v - F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)))).alias(f"{c}|rest"),
        ]
    wide = df.agg(*parts)
    entry = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{k}`").alias(k) for k in ("min", "max", "null", "rest")]) for c in columns
    ])
    rows = wide.select(F.explode(entry).alias("e")).select("e.*")
    whole = ~F.col("null") & (F.col("rest") < 0.01)
    kind = F.lit("float32")
    for name, low, high, _ in reversed(INTEGER_RANGES):
        fits = whole & (F.col("min") >= float(low)) & (F.col("max") <= float(high))
        kind = F.when(fits, name).otherwise(kind)
    return rows.select(
        "column", "min", "max", F.col("null").alias("has_null"), F.coalesce(whole, F.lit(False)).alias("integerable"), kind.alias("type")
    )


def compact_types(df: DataFrame, columns: Sequence[str], replace_missing: bool = False) -> DataFrame:
    """Cast number columns to the narrowest type of their profile."""
    ready = df.withColumns({c: finite_or(F.col(c)) for c in columns}) if replace_missing else df
    types = {name: spark_type for name, _, _, spark_type in INTEGER_RANGES} | {"float32": "float"}
    chosen = {r["column"]: types[r["type"]] for r in type_profile(ready, columns).collect()}
    return ready.withColumns({c: F.col(c).cast(t) for c, t in chosen.items()})


def narrow_types(df: DataFrame) -> DataFrame:
    """Plain down-cast by type alone: bigint to int, double to float."""
    smaller = {T.LongType: "int", T.DoubleType: "float"}
    return df.withColumns({f.name: F.col(f.name).cast(smaller[type(f.dataType)]) for f in df.schema if type(f.dataType) in smaller})


def low_cardinality(df: DataFrame, columns: Sequence[str], share: float = 0.5) -> list[str]:
    """String columns whose distinct values stay under `share` of the rows. Values are counted exactly, null not at all."""
    values = long_text(df, [], columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    got = {r["feature"]: r for r in values.groupBy("feature").agg(F.count("value").alias("values"), F.sum("n").alias("n")).collect()}
    return [c for c in columns if c in got and got[c]["values"] < share * got[c]["n"]]


def mark_categories(df: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """Mark columns of codes 0..n-1 as categories in their metadata.

    The mark is the one that `pyspark.ml` reads: it stays through parquet and into feature vectors, so trees split the
    codes by sets. Other columns and all values are left as they are.
    """
    return df.withColumns({c: F.col(c).alias(c, metadata={"ml_attr": {"type": "nominal", "num_vals": n}}) for c, n in sizes.items()})


def null_flags(df: DataFrame, columns: Sequence[str], replace_missing: bool = True) -> DataFrame:
    """Add `<c>_null_flag`; with `replace_missing` null, NaN and infinity become 0 in `<c>`."""
    flags = {f"{c}_null_flag": _value(df, c).isNull() for c in columns}
    flagged = df.withColumns(flags)
    return flagged.withColumns({c: finite_or(F.col(c)) for c in columns}) if replace_missing else flagged


def export_clean(df: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """Whole floats as integers where the whole column allows it, the text 'null' as NULL."""
    whole = {}
    if numbers:
        fractions = df.agg(*[F.count_if(known(F.col(c)) % 1 != 0).alias(c) for c in numbers]).first()
        whole = {c: whole_or_null(F.col(c)) for c in numbers if fractions[c] == 0}
    return df.withColumns(whole | {c: null_text(F.col(c)) for c in texts})


def project(df: DataFrame, expressions: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Projection from a mapping table: SQL expressions, then renames."""
    return df.selectExpr(*expressions).withColumnsRenamed(dict(rename or {}))


def dates_to_timestamps(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema if isinstance(f.dataType, T.DateType)})
