"""Document fingerprints by locally consistent parsing (operator 4).

A text is parsed level by level. Runs of equal symbols become one. Deterministic coin tossing gives each symbol
the place and value of the lowest bit in which it differs from the one before; four rounds leave labels below
six, and a phrase begins where a label exceeds its neighbours'. A phrase's name is a hash of its symbols and is a
symbol of the next level. Whether a phrase begins somewhere depends on a few symbols around it only, so equal
substrings get equal names inside, whatever their offset. The names of LEVELS make the set of a text; its SIZE
smallest hashes are the fingerprint. Likeness is the Jaccard similarity that two such samples estimate.

The query compares each text with the next document in descending doc_id and with an edited text. Documents
are sorted in ranges of doc_id; each task pairs its rows in passing, and only the last row of one range and the
first of the next are joined afterwards.

Defined cases: a null text counts as empty, with an empty fingerprint; two empty fingerprints are alike (1), an
empty and another are not (0); rows with one doc_id follow each other by a hash of the text; a null doc_id comes
last; a single document is its own next; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuekit.llm.shared import map_batches, pa_schema, settled, small_batches, table

LEVELS = (2, 3)
SIZE = 64
#: Characters parsed together, so that the arrays stay in the cache.
TOGETHER = 150_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_LOWEST = np.array([8] + [(b & -b).bit_length() - 1 for b in range(1, 256)], dtype=np.uint8)
_POWERS = np.array([pow(_BASE, k, 2**64) for k in range(4096)], dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _ODD
    return values ^ (values >> np.uint64(29))


def _starts(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases begin. first: whether a symbol is its text's first. Neighbours differ inside a text."""
    before = np.empty_like(symbols)
    before[1:] = symbols[:-1]
    before[first] = symbols[first] ^ np.uint64(1)
    differ = symbols ^ before
    place = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1))
    labels = (2 * place + ((symbols >> place.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(3):
        before = np.empty_like(labels)
        before[1:] = labels[:-1]
        before[first] = labels[first] ^ 1
        place = _LOWEST[labels ^ before] & 7
        labels = 2 * place + ((labels >> place) & 1)
    rises = np.empty(len(labels), dtype=bool)
    rises[1:] = labels[1:] > labels[:-1]
    rises[0] = True
    falls = np.empty(len(labels), dtype=bool)
    falls[:-1] = labels[:-1] > labels[1:]
    falls[-1] = True
    falls[np.flatnonzero(first)[1:] - 1] = True
    return (rises & falls) | first


def _named(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Names of the phrases that begin at `starts` (positions)."""
    lengths = np.diff(np.append(starts, len(symbols)))
    offsets = np.arange(len(symbols)) - np.repeat(starts, lengths)
    return _mixed(np.add.reduceat(symbols * _POWERS[offsets % len(_POWERS)], starts) + lengths.astype(np.uint64))


def phrase_names(texts: list[str]) -> list[np.ndarray]:
    """The names of LEVELS of each text, as distinct 32-bit hashes in ascending order."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    filled = [i for i, t in enumerate(texts) if t]
    if not filled:
        return [np.zeros(0, np.uint32) for _ in texts]
    codes = np.frombuffer("".join(texts[i] for i in filled).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    symbols = _mixed(codes.astype(np.uint64) + np.uint64(1))
    sizes = np.array([len(texts[i]) for i in filled])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for level in range(1, max(LEVELS) + 1):
        first = np.zeros(len(symbols), dtype=bool)
        first[begins] = True
        change = first.copy()
        change[1:] |= symbols[1:] != symbols[:-1]
        if not change.all():
            runs = np.flatnonzero(change)
            lengths = np.diff(np.append(runs, len(symbols))).astype(np.uint64)
            symbols = np.where(lengths > 1, _mixed(symbols[runs] + lengths * _ODD), symbols[runs])
            begins = np.searchsorted(runs, begins)
            first = first[runs]
        starts = np.flatnonzero(_starts(symbols, first))
        symbols = _named(symbols, starts)
        begins = np.searchsorted(starts, begins)
        if level in LEVELS:
            hashes = (_mixed(symbols + np.uint64(level)) >> np.uint64(32)).astype(np.uint32)
            for i, part in zip(filled, np.split(hashes, begins[1:])):
                found[i].append(part)
    return [np.unique(np.concatenate(f)) if f else np.zeros(0, np.uint32) for f in found]


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """The SIZE smallest name hashes of each text."""
    out: list[np.ndarray] = []
    group: list[str] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= TOGETHER:
            out += phrase_names(group)
            group, size = [], 0
    out += phrase_names(group) if group else []
    return [names[:SIZE] for names in out]


def packed(print_: np.ndarray) -> bytes:
    """A fingerprint as bytes; its text form is their hexadecimal digits."""
    return print_.astype(">u4").tobytes()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the sets two fingerprints sample."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    least = np.union1d(a, b)
    if len(a) == SIZE or len(b) == SIZE:
        least = least[:SIZE]
    return float((np.isin(least, a) & np.isin(least, b)).mean())


def edited(text: str, next_text: str) -> str:
    """`text` with its last third replaced by as many first characters of `next_text`."""
    third = len(text) // 3
    return text[: len(text) - third] + next_text[:third]


_RESULT = "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_TEXTS = ("edited_sha256", "fingerprint", "edited_fingerprint")


def _compared(keys: list, texts: list[str], prints: list[np.ndarray], next_texts: list[str], next_prints: list[np.ndarray]) -> dict[str, list]:
    changed = [edited(a, b) for a, b in zip(texts, next_texts)]
    changed_prints = fingerprints(changed)
    return {
        "doc_id": keys, "n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in changed],
        "fingerprint": [packed(p) for p in prints], "edited_fingerprint": [packed(p) for p in changed_prints],
        "near_edited": [likeness(a, b) for a, b in zip(prints, changed_prints)], "near_next": [likeness(a, b) for a, b in zip(prints, next_prints)],
    }


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text of `docs` (doc_id, text), of its edited text, and likeness to that and to the next."""
    small_batches(docs.sparkSession)
    ddl = _RESULT + ", part int, edge string, text string"
    schema = pa_schema(docs.sparkSession, ddl)

    def batch_of(columns: dict[str, list], part: int, edge: str | None, text: str | None) -> pa.RecordBatch:
        n = len(columns["doc_id"])
        columns = columns | {"part": [part] * n, "edge": [edge] * n, "text": [text] * n}
        return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), type=f.type) for f in schema], schema=schema)

    def pass_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        keys: list = []
        texts: list[str] = []
        prints: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if not keys:
                yield batch_of({"doc_id": batch.column("doc_id").to_pylist()[:1]}, part, "head", batch.column("text")[0].as_py())
            own = batch.column("text").to_pylist()
            keys, texts, prints = keys + batch.column("doc_id").to_pylist(), texts + own, prints + fingerprints(own)
            yield batch_of(_compared(keys[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:]), part, None, None)
            keys, texts, prints = keys[-1:], texts[-1:], prints[-1:]
        if keys:
            yield batch_of({"doc_id": keys}, part, "tail", texts[0])

    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    passed = settled(rows.repartitionByRange(order[0]).sortWithinPartitions(*order).mapInArrow(pass_by, ddl), "phrase-prints")
    # Two edge rows a task of the job above; the window sees their task numbers only, the texts are joined to it.
    parts = passed.where("edge = 'head'").select("part")
    after = Window.orderBy("part")
    next_part = parts.select("part", F.lead("part").over(after).alias("next")).select("part", F.coalesce("next", F.min("part").over(Window.partitionBy(F.lit(1)))).alias("next"))
    heads = passed.where("edge = 'head'").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    open_ = passed.where("edge = 'tail'").select("doc_id", "text", "part").join(next_part, "part").join(heads, "next").select("doc_id", "text", "next_text")

    def close(batch: dict[str, list]) -> dict[str, list]:
        return _compared(batch["doc_id"], batch["text"], fingerprints(batch["text"]), batch["next_text"], fingerprints(batch["next_text"]))

    names = pa_schema(docs.sparkSession, _RESULT).names
    both = passed.where("edge IS NULL").select(*names).unionByName(map_batches(open_, close, _RESULT))
    return both.withColumns({c: F.lower(F.hex(c)) for c in _TEXTS})


def op4_phrase_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole document and its edited text."""
    return compare_with_next(table(spark, sf_dir, "documents"))


QUERIES = {"op4_phrase_prints": op4_phrase_prints}
ORACLE: dict[str, str] = {}
