"""Model registry: one row per model, gates, feature usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.operators.binary import gini, wide_by_sample
from valuekit.operators.frames import join_on
from valuekit.operators.profile import sample_stats
from valuekit.roles import SAMPLES

# Fixed values of the gate: smallest Gini, largest test-train distance, and the name pattern of
# trailing-mean features.
MIN_GINI, MAX_GINI_DISTANCE = 0.3, 0.05
AGGREGATE_FEATURE = r"_\d+a$"
# Fixed values of the volume check: rows, and positives expected in train and valid.
LOW_ROWS, LOW_TRAIN_POSITIVES, LOW_VALID_POSITIVES = 500_000, 1000, 100


def volume_gate(df: DataFrame, keys: Sequence[str], label: str, shares: tuple[float, float] = (0.6, 0.2)) -> DataFrame:
    """Row and positive counts with flags for low volume and too few positives."""
    got = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(label) > 0).alias("n_positive"))
    few = (F.col("n_positive") * shares[0] < LOW_TRAIN_POSITIVES) | (F.col("n_positive") * shares[1] < LOW_VALID_POSITIVES)
    return got.withColumn("low_rows", F.col("n_rows") < LOW_ROWS).withColumn("few_positives", few)


def period_range(df: DataFrame, keys: Sequence[str], period: str = "T") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(period).cast("int").alias("t_min"), F.max(period).cast("int").alias("t_max"))


def model_registry(predictions: DataFrame, importance: DataFrame, *, label: str, score: str = "score", period: str = "T", samples: Sequence[str] = SAMPLES, forbidden: Sequence[str] = ()) -> DataFrame:
    """One row per model.

    `predictions` has (model, sample, label, score, T), `importance` (model, feature, importance).
    Gives Ginis by sample, train events and rates, T range, importance and place of the base
    product, feature count and list, and the forbidden features in use.
    """
    scores = wide_by_sample(gini(predictions, ["model", "sample"], score, label), ["model"], ["gini"], samples)
    rates = wide_by_sample(
        predictions.groupBy("model", "sample").agg(F.sum(label).cast("bigint").alias("events"), F.avg(label).alias("rate")),
        ["model"],
        ["events", "rate"],
        [s for s in ("train", "OOT") if s in samples],
    )
    spans = period_range(predictions, ["model"], period)
    # A model has few features, so its list is small.
    listed = importance.groupBy("model").agg(F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("order"), "feature"))).alias("_list"))
    names = F.transform("_list", lambda s: s["feature"])
    base = F.substring_index("model", "_", 1)
    usage = listed.select(
        "model", base.alias("bp"), F.substring_index("model", "_", -1).alias("sp"), names.alias("_names"), "_list"
    )
    place = F.array_position("_names", F.col("bp"))
    own = F.when(place > 0, -F.get("_list", (place - 1).cast("int"))["order"])
    usage = usage.select(
        "model",
        "bp",
        "sp",
        own.alias("bp_feature_importance"),
        F.when(own > 0, place).alias("bp_feature_importance_place"),
        F.size("_names").alias("used_features_qty"),
        F.concat_ws(",", "_names").alias("used_features"),
        F.concat_ws(",", F.array_sort(F.array_intersect("_names", F.lit(list(forbidden)) if forbidden else F.array().cast("array<string>")))).alias("forbidden_features"),
    )
    return usage.join(scores, "model", "left").join(rates, "model", "left").join(spans, "model", "left")


def problem_models(registry: DataFrame, card_bases: Sequence[str] = ("dc1", "dc2p"), card_sold: str = "dc") -> DataFrame:
    """Registry rows that must not go to production, with the reasons as columns."""
    own = (
        # The product codes in these defaults and rules.
        (F.col("bp").isin(*card_bases) & (F.col("sp") == card_sold))
        | (F.col("bp") == F.col("sp"))
        | (F.col("bp") == F.concat("sp", F.lit("2")))
        | (F.startswith("bp", F.lit("EL")) & (F.col("sp") == "pl"))
    )
    distance = F.abs(F.col("gini_test") - F.col("gini_train"))
    flags = {
        "forbidden_start": own & (F.col("t_min") == 0),
        "weak_gini": F.least("gini_train", "gini_valid", "gini_test") < MIN_GINI,
        "unstable_gini": distance > MAX_GINI_DISTANCE,
    }
    marked = registry.withColumn("gini_dif", distance).withColumns({n: F.coalesce(c, F.lit(False)) for n, c in flags.items()})
    return marked.where(F.col("forbidden_start") | F.col("weak_gini") | F.col("unstable_gini")).orderBy(F.desc("gini_dif"), "model")


def used_features(importance: DataFrame, models: Sequence[str]) -> DataFrame:
    """Feature by model matrix of 0 and 1."""
    used = importance.where(F.col("model").isin(*models))
    return used.groupBy("feature").agg(*[F.max((F.col("model") == m).cast("int")).alias(m) for m in models])


def aggregate_feature_models(importance: DataFrame) -> DataFrame:
    """Models that use trailing-mean features and so need a refit when those go away."""
    hits = importance.where(F.col("feature").rlike(AGGREGATE_FEATURE))
    return hits.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_aggregates"), F.concat_ws(",", F.array_sort(F.collect_set("feature"))).alias("aggregates")
    )


def feature_usage(importance: DataFrame) -> DataFrame:
    """How many models use each feature, and whether it is a trailing mean."""
    return importance.groupBy("feature").agg(F.count_distinct("model").alias("n_models")).withColumn(
        "is_aggregate", F.col("feature").rlike(AGGREGATE_FEATURE)
    )


def model_titles(predictions: DataFrame, label: str, score: str = "score") -> DataFrame:
    """Rows, mean target and Gini per sample, the numbers of a report's first page."""
    stats = sample_stats(predictions, label)
    return join_on(stats, gini(predictions, ["sample"], score, label).select("sample", "gini"), ["sample"])
