"""Whole runs: build and encode a mart, then score it, restartable at every stage."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.operators.encode import encode, pending_rows
from valuekit.operators.mart import mart_slice
from valuekit.operators.scoring import LAST_PERIOD, Window, score_pairs, uplift_all, uplift_curve
from valuekit.operators.split import hash_batches
from valuekit.operators.training import Fitted
from valuekit.sources.writers import output_complete, path_exists, write_parquet


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The finished files at `path`, built first when they are not complete."""
    if not output_complete(spark, path):
        write_parquet(build(), path)
    return spark.read.parquet(path)


def build_dataset(mart: DataFrame, dictionary: DataFrame, folder: str, slice_date: date, *, key: str, categorical: Sequence[str], **slice_options) -> DataFrame:
    """Slice and encoded slice under `folder`.

    Rows missing from an interrupted encoding are appended in one pass, whatever their number.
    """
    spark = mart.sparkSession
    raw = stage(spark, f"{folder}/slice_{slice_date}", lambda: mart_slice(mart, slice_date, key=key, **slice_options))
    path = f"{folder}/slice_{slice_date}_encoded"
    if not output_complete(spark, path):
        write_parquet(encode(raw, dictionary, categorical, normalise=True), path)
        return spark.read.parquet(path)
    done = spark.read.parquet(path)
    missing = pending_rows(raw, done, key)
    if missing.limit(1).count():
        write_parquet(encode(missing, dictionary, categorical, normalise=True), path, mode="append")
    return spark.read.parquet(path)


def score_dataset(df: DataFrame, models: Mapping[tuple[str, str], Fitted], windows: Mapping[tuple[str, str], Window], folder: str, *, key: str, date_text: str, default: Window = Window(0, LAST_PERIOD)) -> list[dict]:
    """One uplift table per pair under `folder`; finished pairs are skipped, failures reported.

    A pair without a window of its own gets the default one.
    """
    spark = df.sparkSession

    def scorer(frame: DataFrame, base: str, sold: str) -> DataFrame:
        return uplift_curve(frame, models[(base, sold)], base, sold, windows.get((base, sold), default), treatment=base)

    return score_pairs(
        df,
        key,
        list(models),
        scorer,
        lambda table, name: write_parquet(table, f"{folder}/{name}"),
        exists=lambda name: output_complete(spark, f"{folder}/{name}"),
        date=date_text,
    )


def score_all_pairs(df: DataFrame, models: Mapping[tuple[str, str], Fitted], windows: Mapping[tuple[str, str], Window], path: str, *, key: str, treatment: str | None = None) -> list[dict]:
    """Uplift arrays of all pairs in one table at `path`, a partition for each pair, from one pass over the rows.

    Only the partitions of the pairs in this run are replaced, so a run for the pairs that failed, or for a refitted
    one, leaves the others. Pairs that cannot be scored are reported and do not stop the rest.
    """
    table, failed = uplift_all(df, key, models, windows, treatment=treatment)
    if len(failed) < len(models):
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bp", "sp").parquet(path)
    return [{"bp": b, "sp": s, "status": "failed" if (b, s) in failed else "scored", "error": failed.get((b, s))} for b, s in models]


LEDGER = "batch int, n_rows bigint, content string"


def encode_in_batches(raw: DataFrame, dictionary: DataFrame, folder: str, *, key: str, categorical: Sequence[str], batches: int, stop_after: int | None = None) -> DataFrame:
    """Encode `raw` batch by batch under `folder`; a rerun does only the batches that have no row in the ledger.

    A batch is a share of the key's hash, so its rows are the same in every run, those without a key included. It is
    written as a partition of its own and then entered in the ledger with its rows and the sum of their hashes. A run
    that breaks in between leaves a partition without an entry, which the next run replaces. Returns the ledger;
    `stop_after` ends the run after so many batches.
    """
    spark = raw.sparkSession
    data, ledger = f"{folder}/data", f"{folder}/ledger"
    done = {r["batch"] for r in read_ledger(spark, folder).collect()}
    numbered = hash_batches(raw, [key], batches)
    coded = encode(numbered, dictionary, categorical, normalise=True)
    content = F.coalesce(F.sum(F.xxhash64(*raw.columns).cast("decimal(38,0)")), F.lit(0)).cast("string")
    for batch in [b for b in range(batches) if b not in done][:stop_after]:
        coded.where(F.col("batch") == batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(data)
        written = spark.read.schema(coded.drop("batch").schema).parquet(f"{data}/batch={batch}") if path_exists(spark, f"{data}/batch={batch}") else coded.drop("batch").limit(0)
        entry = written.agg(F.lit(batch).alias("batch"), F.count(F.lit(1)).alias("n_rows"), content.alias("content"))
        entry.select("batch", "n_rows", "content").coalesce(1).write.mode("append").parquet(ledger)
    return read_ledger(spark, folder)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The finished batches of a run."""
    path = f"{folder}/ledger"
    return spark.read.schema(LEDGER).parquet(path) if output_complete(spark, path) else spark.createDataFrame([], LEDGER)


def encoded_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the batches in the ledger; a batch that broke while it was written is not among them."""
    rows = spark.read.parquet(f"{folder}/data")
    return rows.join(F.broadcast(read_ledger(spark, folder).select("batch")), "batch", "left_semi")
