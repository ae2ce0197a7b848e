"""The corpus pipeline: five stages, each over all that the one before it kept.

    quality            drops documents that the quality classifier rejects
    line_dedup         removes lines that repeat or nearly repeat an earlier one
    near_duplicates    keeps one document of each group of near copies
    decontamination    drops documents that hold a benchmark item
    bpe                encodes and decodes what is left

A stage takes (spark, docs, sf_dir) and returns a DataFrame, written as parquet and read again as the next
one's docs. All but the last return the columns of `documents`. Null texts count as empty, rows that share a
doc_id are judged as their operator states, extra columns are kept by all stages but the last, and empty tables
pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm import bench_simhash, bpe_trees, kernel_quality, line_join, ngram_join
from valuekit.llm.shared import settled, table


def _set_apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with other columns than doc_id and text under names of their own, and what gives them their names back.

    So no column of the documents can meet one of an operator, whatever it is called.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    renamed = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"pipeline_{i}") for i, c in enumerate(others)])

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[c if c in ("doc_id", "text") else F.col(f"pipeline_{others.index(c)}").alias(c) for c in docs.columns])

    return renamed, back


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this stage's input, does not reject."""
    apart, back = _set_apart(docs)
    scored = kernel_quality.score_quality(apart, table(spark, sf_dir, "labels"), keep=tuple(apart.columns))
    return back(scored.where("predicted = 1"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; n_chars follows the text."""
    apart, back = _set_apart(docs)
    kept = back(line_join.dedup_lines(apart))
    return kept.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group."""
    apart, back = _set_apart(docs)
    return back(ngram_join.keep_first(apart))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    apart, back = _set_apart(docs)
    return back(bench_simhash.decontaminate(apart, table(spark, sf_dir, "benchmark")))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document left."""
    return bpe_trees.encoded_digests(docs, public_tokenizers.path(bpe_trees.VOCABULARY))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", bpe),
]
#: Fitted scores and BPE ids are beyond SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
