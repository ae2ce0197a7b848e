"""Population stability (PSI) between samples.

All variants work the same way: bin edges come from the expected sample, then every sample is
counted per (feature, bin) in one pass with map-side combine, and the index is a sum over at most
a few dozen rows per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuekit.functions.columns import MISSING_NUMBER, status_boundary
from valuekit.operators.frames import long_numeric, long_text
from valuekit.operators.ranks import bin_of, broadcast_within, quantiles, unique_edges


# Floor for an empty bin (feature report), for an empty bin of an array comparison,
# default share of an absent bucket (validation report), and the limit that marks a shift there.
EMPTY_SHARE = 0.005
EMPTY_SHARE_ARRAY = 0.0001
ABSENT_SHARE = 0.001
SHIFT_LIMIT = 0.2


def _term(expected: Column, actual: Column) -> Column:
    return (expected - actual) * F.log(F.try_divide(expected, actual))


def _floored(share: Column, floor: float) -> Column:
    return F.when(share == 0, F.lit(floor)).otherwise(share)


def _edges(values: DataFrame, n_bins: int, bin_type: str) -> DataFrame:
    """(feature, edges) from the non-null values of the expected sample."""
    if bin_type == "quantiles":
        cut = quantiles(values, ["feature"], "value", [i / n_bins for i in range(n_bins + 1)], name="edges")
        return cut.select("feature", unique_edges(F.col("edges")).alias("edges"))
    if bin_type != "bins":
        raise ValueError(f"bin_type must be 'quantiles' or 'bins', not {bin_type!r}")
    span = values.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    points = ", ".join(f"low + {i}D * ((high - low) / {n_bins}D)" for i in range(n_bins))
    return span.select("feature", unique_edges(F.expr(f"array({points}, high)")).alias("edges"))


def _index(counts: DataFrame, floor: float) -> DataFrame:
    """PSI per feature from (feature, bin, expected, actual); a null bin only feeds the totals.

    A feature without any bin, because the expected sample has no value, has no PSI (null).
    """
    feature = Window.partitionBy("feature")
    shares = counts.select(
        "feature",
        "bin",
        (F.col("expected") / F.sum("expected").over(feature)).alias("e"),
        (F.col("actual") / F.sum("actual").over(feature)).alias("a"),
    )
    term = _term(_floored(F.col("e"), floor), _floored(F.col("a"), floor))
    return shares.groupBy("feature").agg(F.sum(F.when(F.col("bin").isNotNull(), term)).alias("psi"))


def _two_counts(expected: str, actual: str, sample: str) -> list[Column]:
    return [F.count_if(F.col(sample) == expected).alias("expected"), F.count_if(F.col(sample) == actual).alias("actual")]


def numeric_psi(
    df: DataFrame,
    features: Sequence[str],
    *,
    sample: str = "sample",
    expected: str = "train",
    actual: str = "OOT",
    n_bins: int = 20,
    bin_type: str = "quantiles",
    floor: float = EMPTY_SHARE,
) -> DataFrame:
    """PSI per numeric feature, (feature, psi).

    Edges are unique quantiles (or equal steps) of the expected sample; bins are closed on the
    left, the last on both sides. A missing value counts as -9999, so it normally falls outside
    the bins but stays in the denominator.
    """
    values = long_numeric(df.where(F.col(sample).isin(expected, actual)), [sample], features)
    known_expected = values.where((F.col(sample) == expected) & F.col("value").isNotNull())
    edges = broadcast_within(_edges(known_expected, n_bins, bin_type), rows=len(features))
    binned = values.withColumn("value", F.coalesce("value", F.lit(MISSING_NUMBER))).join(edges, "feature", "left")
    bins = bin_of("value", "edges", n_bins + 1, closed="left")
    return _index(binned.groupBy("feature", bins.alias("bin")).agg(*_two_counts(expected, actual, sample)), floor)


def array_psi(df: DataFrame, columns: Sequence[str], *, bin_type: str = "bins", buckets: int = 10, **samples) -> DataFrame:
    """PSI of plain number columns with 10 bins and the smaller floor."""
    return numeric_psi(df, columns, n_bins=buckets, bin_type=bin_type, floor=EMPTY_SHARE_ARRAY, **samples)


def categorical_psi(
    df: DataFrame,
    features: Sequence[str],
    *,
    sample: str = "sample",
    expected: str = "train",
    actual: str = "OOT",
    floor: float = EMPTY_SHARE,
) -> DataFrame:
    """PSI per categorical feature over its values; missing values are left out of the shares.

    Shares are aligned by value; a value absent on one side gets the floor there. Totals are one
    row per feature, so a feature with very many values never sits in one task.
    """
    rows = long_text(df.where(F.col(sample).isin(expected, actual)), [sample], features).where(F.col("value").isNotNull())
    counts = rows.groupBy("feature", "value").agg(*_two_counts(expected, actual, sample))
    totals = counts.groupBy("feature").agg(F.sum("expected").alias("all_e"), F.sum("actual").alias("all_a"))
    joined = counts.join(broadcast_within(totals, rows=len(features)), "feature")
    e = _floored(F.try_divide(F.col("expected"), F.col("all_e")), floor)
    a = _floored(F.try_divide(F.col("actual"), F.col("all_a")), floor)
    return joined.groupBy("feature").agg(F.sum(_term(e, a)).alias("psi"))


def psi_selection(scores: DataFrame, threshold: float) -> DataFrame:
    """Mark features below the threshold with 1, most stable first; one without a PSI is never chosen."""
    chosen = F.coalesce((F.col("psi") < threshold).cast("int"), F.lit(0))
    return scores.select("feature", "psi", chosen.alias("selected")).orderBy(F.col("psi").asc_nulls_last(), "feature")


def comparison_samples(present: Sequence[str]) -> list[str]:
    """Which samples a report compares with train: test (else valid), OOT, OOT_psi, test2."""
    first = ["test"] if "test" in present else ["valid"] if "valid" in present else []
    return first + [s for s in ("OOT", "OOT_psi", "test2") if s in present]


def _cells(values: DataFrame, sample: str, label: str | None, edges: DataFrame | None, n_edges: int) -> DataFrame:
    """(feature, data_part, bucket, sample, n, low, high) from long values.

    A row lies in a bucket of all rows and in one of its class. Rows are counted by that pair of
    buckets first, and only those few cells are taken apart into the data parts.
    """
    if edges is None:
        own = F.coalesce(F.col("value"), F.lit("MISSING"))
        placed = values.withColumns({"_all": own, "_class": own, "_number": F.lit(None).cast("double")})
    else:
        def bucket(name: str):
            return F.when(F.col("value").isNull(), "MISSING").otherwise(bin_of("value", name, n_edges, lowest=True).cast("string"))

        joined = values.join(edges, "feature", "left")
        if label is not None:
            joined = joined.withColumn("_edges", F.expr(f"IF(`{label}` = 1, events, nevents)"))
        placed = joined.withColumns({
            "_all": bucket("all"), "_class": bucket("_edges") if label is not None else F.lit(None).cast("string"), "_number": F.col("value")
        })
    y = F.lit(None).cast("int") if label is None else F.col(label).cast("int")
    counted = placed.groupBy("feature", sample, y.alias("_y"), "_all", "_class").agg(
        F.count(F.lit(1)).alias("n"), F.min("_number").alias("low"), F.max("_number").alias("high")
    )
    part = F.when(F.col("_y") == 1, "events").when(F.col("_y") == 0, "nevents")
    both = F.array(F.struct(F.lit("all").alias("data_part"), F.col("_all").alias("bucket")), F.struct(part.alias("data_part"), F.col("_class").alias("bucket")))
    rows = counted.select("feature", sample, "n", "low", "high", F.explode(both).alias("p")).select("feature", sample, "p.*", "n", "low", "high")
    return rows.where(F.col("data_part").isNotNull() & F.col("bucket").isNotNull())


def detailed_psi(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    *,
    sample: str = "sample",
    label: str | None = None,
    base: str = "train",
    against: Sequence[str] = ("test", "OOT"),
) -> DataFrame:
    """Bucket-level PSI of the validation report, long over the compared samples.

    Numeric buckets are unique deciles ("lower" kind) of the base sample per part; values outside
    them are not counted, missing values form their own bucket. Categories are their own buckets.
    """
    present = [base, *against]
    ids = [sample] if label is None else [sample, label]
    wanted = df.where(F.col(sample).isin(*present))
    n_parts = 1 if label is None else 3
    groups = ["data_part", "feature"]

    cells = None
    if numeric:
        values = long_numeric(wanted, ids, numeric)
        populations = {"all": F.count(F.lit(1))}
        if label is not None:
            populations |= {"events": F.count_if(F.col(label) == 1), "nevents": F.count_if(F.col(label) == 0)}
        known = values.where((F.col(sample) == base) & F.col("value").isNotNull())
        edges = quantiles(known, ["feature"], "value", [i / 10 for i in range(11)], kind="lower", counts=populations)
        edges = edges.select("feature", *[unique_edges(F.col(p)).alias(p) for p in populations])
        cells = _cells(values, sample, label, broadcast_within(edges, rows=len(numeric)), 11)
    if categorical:
        texts = _cells(long_text(wanted, ids, categorical), sample, label, None, 0)
        cells = texts if cells is None else cells.unionByName(texts)
    if cells is None:
        raise ValueError("detailed_psi needs at least one feature")

    wide = cells.groupBy(*groups, "bucket").agg(
        F.min(F.when(F.col(sample) == base, F.col("low"))).alias("min_value"),
        F.max(F.when(F.col(sample) == base, F.col("high"))).alias("max_value"),
        *[F.coalesce(F.sum(F.when(F.col(sample) == s, F.col("n"))), F.lit(0)).alias(f"n_{s}") for s in present],
    )
    totals = wide.groupBy(*groups).agg(*[F.sum(f"n_{s}").alias(f"all_{s}") for s in present])
    totals = broadcast_within(totals, rows=n_parts * (len(numeric) + len(categorical)))
    versus = F.array(*[
        F.struct(F.lit(s).alias("versus"), F.col(f"n_{s}").alias("n"), F.col(f"all_{s}").alias("all")) for s in against
    ])
    long = wide.join(totals, groups).select(
        *groups, "bucket", "min_value", "max_value", F.col(f"n_{base}").alias("base_count"), F.col(f"all_{base}").alias("_base_all"),
        F.explode(versus).alias("v"),
    )
    base_share = F.when(F.col("base_count") > 0, F.col("base_count") / F.col("_base_all")).otherwise(ABSENT_SHARE)
    diff_share = F.when(F.col("v.n") > 0, F.col("v.n") / F.col("v.all")).otherwise(ABSENT_SHARE)
    return long.where((F.col("base_count") > 0) | (F.col("v.n") > 0)).select(
        "feature",
        "bucket",
        "data_part",
        F.col("v.versus").alias("versus"),
        "min_value",
        "max_value",
        "base_count",
        base_share.alias("base_share"),
        F.col("v.n").alias("versus_count"),
        diff_share.alias("versus_share"),
        _term(diff_share, base_share).alias("psi"),
    )


def short_psi(detailed: DataFrame, against: Sequence[str], parts: Sequence[str] = ("all", "events", "nevents"), base: str = "train") -> DataFrame:
    """One row per feature with `PSI_train_vs_<sample>_<part>` columns and a red flag on shifts."""
    names = {f"PSI_{base}_vs_{s}_{p}": (s, p) for s in against for p in parts}
    table = detailed.groupBy("feature").agg(*[
        F.sum(F.when((F.col("versus") == s) & (F.col("data_part") == p), F.col("psi"))).alias(n) for n, (s, p) in names.items()
    ])
    return table.withColumn("status", status_boundary(F.greatest(*[F.coalesce(n, F.lit(0.0)) for n in names], F.lit(0.0)), SHIFT_LIMIT, "reverse"))


