"""Deterministic sampling and splitting.

Rows are ordered by a hash of their key, so a re-run gives the same parts. Exact part sizes come
from the hash value at the wanted rank, found without sorting the frame in one task; the rows
themselves are only filtered, never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuekit.functions.columns import hash_fraction
from valuekit.operators.frames import join_on
from valuekit.operators.ranks import cut_points, pinned, rank_cuts, running_totals
from valuekit.session import settle

_HASH = "_hash"
#: Bins of the histogram that narrows down a cut.
HASH_BINS = 1 << 16
#: Rows of a range in which the values of an ordered split are put in order.
ORDERED_ROWS = 200_000


def _bounds(shares: Mapping[str, float | int]) -> dict[str, float | int]:
    """Cumulative bounds of all parts but the last, which takes the rest."""
    names, total, out = list(shares), 0, {}
    for name in names[:-1]:
        total = round(total + shares[name], 12) if isinstance(shares[name], float) else total + shares[name]
        out[name] = total
    return out


def _label(bounds: Mapping[str, float | int], last: str, cut: Callable[[str], Column]) -> Column:
    label = F.lit(last)
    for name in reversed(list(bounds)):
        label = F.when(F.col(_HASH) <= cut(name), name).otherwise(label)
    return label


def hash_cuts(ranked: DataFrame, strata: Sequence[str], bounds: Mapping[str, float | int], bins: int = HASH_BINS) -> DataFrame:
    """(strata, _cut_<name>): the hash of the last row inside each bound; null where a bound holds no row.

    A histogram of the hashes, summed before the shuffle, tells the bin of each wanted rank; only the rows of those
    bins are put in order. The hashes and strata are written once, since both passes read them.
    """
    spot = F.floor(F.col(_HASH) * bins).cast("int").alias("_bin")
    rows = settle(ranked.select(*dict.fromkeys([*strata, _HASH]))).select("*", spot)
    inside = Window.partitionBy(*strata).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*strata, "_bin").agg(F.count(F.lit(1)).alias("_n")).select(
        "*", F.coalesce(F.sum("_n").over(inside), F.lit(0)).alias("_below"), F.sum("_n").over(Window.partitionBy(*strata)).alias("_all")
    )

    def size(bound: float | int) -> Column:
        return F.least(F.floor(F.lit(bound) * F.col("_all")) if isinstance(bound, float) else F.lit(bound), F.col("_all")).cast("bigint")

    sizes = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), size(b).alias("size")) for n, b in bounds.items()])).alias("_s")
    hit = counts.select(*strata, "_bin", "_n", "_below", sizes).where("_s.size > _below AND _s.size <= _below + _n")
    wanted = pinned(hit.select(*strata, "_bin", F.col("_s.name").alias("_name"), (F.col("_s.size") - F.col("_below")).alias("_rank")))
    ordered = join_on(rows, wanted, [*strata, "_bin"])
    place = F.row_number().over(Window.partitionBy(*strata, "_name").orderBy(_HASH))
    found = ordered.withColumn("_place", place).where("_place = _rank")
    return found.groupBy(*strata).agg(*[F.max(F.when(F.col("_name") == n, F.col(_HASH))).alias(f"_cut_{n}") for n in bounds])


def value_cuts(ranked: DataFrame, strata: Sequence[str], bounds: Mapping[str, float | int], rows_per_range: int = ORDERED_ROWS) -> DataFrame:
    """`hash_cuts` for values of any size, which are put in order in ranges of similar row counts.

    Rows without a value come first in the order, as Spark sorts them. The values are written once, since all passes
    read them.
    """
    rows = settle(ranked.select(*dict.fromkeys([*strata, _HASH])))
    totals = running_totals(rows, strata, _HASH, {"n": F.count(F.lit(1))}, totals=True, cuts=cut_points(rows, _HASH, rows_per_range))
    without = rows.groupBy(*strata).agg(F.count_if(F.col(_HASH).isNull()).alias("_without"))
    known = join_on(totals, pinned(without), [*strata]) if strata else totals.withColumn("_without", F.lit(without.first()[0]))

    def size(bound: float | int) -> Column:
        return F.floor(F.lit(bound) * (F.col("n_all") + F.col("_without"))) if isinstance(bound, float) else F.lit(bound)

    return known.groupBy(*strata).agg(*[F.max(F.when(F.col("n_below") + F.col("_without") < size(b), F.col(_HASH))).alias(f"_cut_{n}") for n, b in bounds.items()])


def _split(df: DataFrame, ranked: DataFrame, strata: Sequence[str], shares: Mapping[str, float | int], sample: str, find: Callable[..., DataFrame] = hash_cuts) -> DataFrame:
    """Cut values are one row per stratum; without strata they are literals of the plan."""
    bounds = _bounds(shares)
    columns, last = [c for c in df.columns if c != _HASH], list(shares)[-1]
    if not bounds:
        return df.select(*columns, F.lit(last).alias(sample))
    cuts = find(ranked, [*strata], bounds)
    if strata:
        # A stratum too small for any bound has no cuts: all of it is in the last part.
        joined = join_on(df, pinned(cuts), [*strata], "left")
        return joined.select(*columns, _label(bounds, last, lambda n: F.col(f"_cut_{n}")).alias(sample))
    row = cuts.first()
    return df.select(*columns, _label(bounds, last, lambda n: F.lit(row[f"_cut_{n}"])).alias(sample))


def split_rows(df: DataFrame, key: Sequence[str], shares: Mapping[str, float | int], *, strata: Sequence[str] = (), seed: int = 0, sample: str = "sample") -> DataFrame:
    """Label rows with a sample name; with `strata` each class is split in the same shares.

    Rows without a stratum (null) are a class of their own.

    Shares are fractions or row counts in order; the last part takes what is left.
    """
    hashed = df.withColumn(_HASH, hash_fraction(*[F.col(k) for k in key], seed=seed))
    return _split(hashed, hashed, strata, shares, sample)


def split_groups(df: DataFrame, column: str, shares: Mapping[str, float | int], *, seed: int = 0, sample: str = "sample") -> DataFrame:
    """Label rows so that all rows of one value of `column` share a sample; shares count values."""
    hashed = df.withColumn(_HASH, hash_fraction(F.col(column), seed=seed))
    return _split(hashed, hashed.select(column, _HASH).distinct(), (), shares, sample)


def split_target(df: DataFrame, key: Sequence[str], target: str, shares: Mapping[str, float | int], *, mode: str, group: str | None = None, seed: int = 0) -> DataFrame:
    """Split by an explicit mode: `stratified` (binary target), `group` or `random`."""
    if mode == "stratified":
        return split_rows(df, key, shares, strata=[target], seed=seed)
    if mode == "group":
        if group is None:
            raise ValueError("mode 'group' needs the group column")
        return split_groups(df, group, shares, seed=seed)
    if mode == "random":
        return split_rows(df, key, shares, seed=seed)
    raise ValueError(f"unknown split mode {mode!r}")


def split_ordered(df: DataFrame, order: str, shares: Mapping[str, float], *, sample: str = "sample", nested: bool = False) -> DataFrame:
    """Split along the values of a numeric column instead of a hash.

    `nested` reproduces the shares of a two-step split, where the second share applies to what the
    first left over (60/20/20 becomes 60/8/32).
    """
    names = list(shares)
    if nested:
        first, second = shares[names[0]], (1 - shares[names[0]]) * shares[names[1]]
        shares = dict(zip(names, (first, second, 1 - first - second), strict=True))
    hashed = df.withColumn(_HASH, F.col(order))
    return _split(hashed, hashed, (), shares, sample, value_cuts)


def sample_share(df: DataFrame, key: Sequence[str], share: float | Column, seed: int = 0) -> DataFrame:
    """Keep a share of the rows by hash: the same expected share in every stratum."""
    return df.where(hash_fraction(*[F.col(k) for k in key], seed=seed) < share)


def downsample(df: DataFrame, key: Sequence[str], label: str, max_rows: int, *, shares: tuple[float, float] = (0.6, 0.2), min_positives: tuple[int, int] = (1000, 100), seed: int = 0) -> DataFrame:
    """Reduce to about `max_rows`, unless too few positives would be left.

    The row and positive counts are scalar subqueries over the same scan, so the choice is made
    inside the plan.
    """
    h = hash_fraction(*[F.col(k) for k in key], seed=seed)
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    ratio = F.lit(float(max_rows)) / rows
    kept = df.where(h < ratio).agg(F.count_if(F.col(label) > 0).alias("n")).scalar()
    enough = (kept * shares[0] >= min_positives[0]) & (kept * shares[1] >= min_positives[1])
    return df.where(~enough | (h < ratio))


def psi_sample(df: DataFrame, choice: str = "OOT", key: Sequence[str] = ("id",), sample: str = "sample", seed: int = 0) -> DataFrame:
    """Choose the sample for stability checks.

    `valid` and `test` are used as they are; `OOT` is halved and the second half renamed
    `OOT_psi`, so that quality is still measured on unseen rows.
    """
    if choice in ("valid", "test"):
        return df
    if choice != "OOT":
        raise ValueError(f"choice must be 'valid', 'test' or 'OOT', not {choice!r}")
    second = hash_fraction(*[F.col(k) for k in key], seed=seed) >= 0.5
    return df.withColumn(sample, F.when((F.col(sample) == "OOT") & second, "OOT_psi").otherwise(F.col(sample)))


def cap_rows(df: DataFrame, key: Sequence[str], limit: int, seed: int = 0) -> DataFrame:
    """About `limit` rows (or all) with the smallest hash, an opt-in cap.

    Rows of one key have one hash and stay together, so with repeated keys it may be a few more.
    """
    hashed = df.withColumn(_HASH, hash_fraction(*[F.col(k) for k in key], seed=seed))
    cut = rank_cuts(hashed, [], _HASH, {"cut": limit}).select("cut").scalar()
    return hashed.where(F.col(_HASH) <= cut).drop(_HASH)


def hash_batches(df: DataFrame, key: Sequence[str], batches: int, seed: int = 0) -> DataFrame:
    """Add `batch` in 0..batches-1 for work in bounded pieces."""
    return df.withColumn("batch", F.floor(hash_fraction(*[F.col(k) for k in key], seed=seed) * batches).cast("int"))
