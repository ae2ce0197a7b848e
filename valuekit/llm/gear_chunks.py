"""Substring deduplication by content-defined chunks (operator 9).

A gear hash rolls over the code points of a text: each character adds its random value to the doubled sum. The
values have their top WINDOW of 32 bits only, so the sum depends on the last WINDOW characters. A chunk ends where
it falls below 2^32 / AVERAGE, which is decided by content alone: inside a repeated passage the cuts are the same,
whatever stands before it. A passage loses WINDOW characters and part of a chunk at its start and part of one at
its end; the rest must reach RUN.
Chunks are compared by a 64-bit digest. A chunk repeats if a document with a smaller doc_id has it. Runs of
neighbouring repeated chunks of at least RUN characters are removed; shorter ones, which clean prose shares by
chance, stay.

Defined cases: null texts count as empty and come back empty; documents with a null doc_id are not compared and
keep their text; rows that share a doc_id are one document, so they do not repeat each other; repeats inside
one document stay; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.shared import map_batches, settled, table

#: Mean characters of a chunk, and the characters in a run from which repeated text is removed.
AVERAGE = 24
RUN = 4 * AVERAGE
WINDOW = 12
SEED = 41_017


@functools.lru_cache(maxsize=1)
def _gear() -> tuple[np.ndarray, np.ndarray]:
    """Random values of the low byte and of the rest of a code point."""
    picks = np.random.default_rng(SEED)
    top = np.uint32(2**32 - 2 ** (32 - WINDOW))
    return picks.integers(0, 2**32, 256, dtype=np.uint32) & top, picks.integers(0, 2**32, 0x1100, dtype=np.uint32) & top


def chunk_ends(text: str) -> list[int]:
    """Where the chunks of a text end, as numbers of characters."""
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    low, high = _gear()
    sums = low[codes & 0xFF] ^ high[codes >> 8]
    step = 1
    while step < WINDOW:
        sums[step:] += sums[:-step] << np.uint32(step)
        step *= 2
    cuts = np.flatnonzero(sums < 2**32 // AVERAGE) + 1
    cuts = cuts[cuts >= WINDOW]
    ends = cuts.tolist()
    return ends if ends and ends[-1] == len(text) else [*ends, len(text)]


def chunk_digests(text: str, ends: list[int]) -> list[int]:
    """Signed 64-bit digests of the chunks."""
    raw = [xxhash.xxh64_intdigest(text[a:b].encode("utf-8", "surrogatepass")) for a, b in zip([0, *ends], ends)]
    return np.array(raw, dtype=np.uint64).view(np.int64).tolist()


def repeated_spans(ends: list[int], flagged: list[int], run: int = RUN) -> list[tuple[int, int]]:
    """Spans of the runs of flagged chunks that are long enough."""
    spans: list[list[int]] = []
    for k in sorted(flagged):
        a, b = (ends[k - 1] if k else 0), ends[k]
        if spans and spans[-1][1] == a:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    return [(a, b) for a, b in spans if b - a >= run]


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Documents with repeated chunks: doc_id, row (a hash of the text) and the chunk numbers."""
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("row"), "text")

    def cut(batch: dict[str, list]) -> dict[str, list]:
        return {"doc_id": batch["doc_id"], "row": batch["row"], "digests": [chunk_digests(t, chunk_ends(t)) for t in batch["text"]]}

    chunked = settled(map_batches(named, cut, "doc_id bigint, row bigint, digests array<bigint>"), "gear-chunks")
    chunks = chunked.select("doc_id", "row", F.posexplode("digests").alias("number", "digest"))
    # The largest doc_id would tell which digests repeat, but costs more in the shuffle than it saves in the join.
    owners = chunks.groupBy("digest").agg(F.min("doc_id").alias("first"))
    later = chunks.join(owners, "digest").where("doc_id > first")
    return later.groupBy("doc_id", "row").agg(F.collect_set("number").alias("numbers"))


def dedup_substrings(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, text without repeated passages, n_chars of it, n_removed characters and the removed spans."""
    found = repeated_chunks(docs).select(F.col("doc_id").alias("__doc"), F.col("row").alias("__row"), "numbers")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(found, (F.col("doc_id") == F.col("__doc")) & (F.xxhash64("text") == F.col("__row")), "left").select("doc_id", "text", "numbers")

    def remove(batch: dict[str, list]) -> dict[str, list]:
        spans = [repeated_spans(chunk_ends(t), n, run) if n else [] for t, n in zip(batch["text"], batch["numbers"])]
        kept = ["".join(t[a:b] for a, b in zip([0, *(e for _, e in s)], [*(b for b, _ in s), len(t)])) for t, s in zip(batch["text"], spans)]
        removed = [sum(b - a for a, b in s) for s in spans]
        return {"doc_id": batch["doc_id"], "text": kept, "n_chars": [len(t) for t in kept], "n_removed": removed, "spans": [[{"start": a, "end": b} for a, b in s] for s in spans]}

    return map_batches(joined, remove, "doc_id bigint, text string, n_chars bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>")


def op9_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages that an earlier document has."""
    return dedup_substrings(table(spark, sf_dir, "documents"))


QUERIES = {"op9_gear_chunks": op9_gear_chunks}
ORACLE: dict[str, str] = {}
