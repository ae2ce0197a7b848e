"""BPE encoding and decoding by tree concatenation (operator 1).

Texts up to SPAN characters are encoded where they are read. Longer ones are cut into parts, which are
dealt over all tasks: at spaces where there are any, else by the splitting pattern, and a match of that
pattern longer than `byte_bpe.LEAF` into halves of halves. The parts of a text meet again by its row
number, where neighbouring leaves are joined level by level with growing windows.

Defined cases: a null text counts as empty and has no ids; repeated rows each give their own row; ties in
doc_id never mix, as parts meet by row and not by id; extra columns are left out unless named in `keep`;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.byte_bpe import ByteBpe, byte_bpe, halves
from valuekit.llm.shared import map_batches, small_batches, table

#: Texts of more characters are cut and dealt out.
SPAN = 32_768
VOCABULARY = "byte_bpe_50k.json"


def text_parts(coder: ByteBpe, text: str, span: int) -> Iterator[tuple[str, int]]:
    """Parts of a text and the number of the long match they are leaves of (-1: encoded on its own)."""
    start, match = 0, 0
    while start < len(text):
        end = start + span
        if end >= len(text):
            end = len(text)
        else:
            cut = end
            while (cut := text.rfind(" ", start + 1, cut + 1)) > 0 and text[cut - 1].isspace():
                cut -= 1
            if cut > start:
                end = cut
            else:
                while (end := text.find(" ", end)) >= 0 and text[end - 1].isspace():
                    end += 1
                end = len(text) if end < 0 else end
        stretch = text[start:end]
        start = end
        if len(stretch) <= span:
            yield stretch, -1
            continue
        for part, long in coder.stretch_parts(stretch):
            if not long:
                yield part, -1
                continue
            for leaf in halves(part):
                yield leaf, match
            match += 1


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), span: int = SPAN) -> DataFrame:
    """One row per row of `docs`: the columns in `keep`, `ids` (little-endian unsigned 32-bit) and `n_tokens`."""
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    kinds = {c: docs.schema[c].dataType.simpleString() for c in keep}
    kept = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    schema = kept + "ids binary, n_tokens bigint"

    def encode(batch: dict[str, list]) -> dict[str, list]:
        ids = byte_bpe(vocabulary).encode(batch["__text"])
        return {c: batch[c] for c in keep} | {"ids": ids, "n_tokens": [len(x) // 4 for x in ids]}

    short = map_batches(rows.where(F.length("__text") <= span), encode, schema)

    def cut(batch: dict[str, list]) -> dict[str, list]:
        coder, out = byte_bpe(vocabulary), {c: [] for c in (*keep, "__row", "__seq", "__match", "__text")}
        for i, whole in enumerate(batch["__text"]):
            for seq, (part, match) in enumerate(text_parts(coder, whole, span)):
                for c in (*keep, "__row"):
                    out[c].append(batch[c][i])
                out["__seq"].append(seq)
                out["__match"].append(match)
                out["__text"].append(part)
        return out

    def encode_part(batch: dict[str, list]) -> dict[str, list]:
        coder = byte_bpe(vocabulary)
        whole = iter(coder.encode([t for t, m in zip(batch["__text"], batch["__match"]) if m < 0]))
        ids = [next(whole) if m < 0 else coder.raw(t.encode()).tobytes() for t, m in zip(batch["__text"], batch["__match"])]
        return {c: batch[c] for c in (*keep, "__row", "__seq", "__match")} | {"ids": ids}

    def meet(parts: pa.Table) -> pa.Table:
        coder = byte_bpe(vocabulary)
        parts = parts.sort_by("__seq")
        done: list[np.ndarray] = []
        leaves: list[np.ndarray] = []
        last = -1
        for match, data in zip(parts["__match"].to_pylist(), parts["ids"].to_pylist()):
            if leaves and match != last:
                done.append(coder.join_all(leaves))
                leaves = []
            (done if match < 0 else leaves).append(np.frombuffer(data, dtype="<u4"))
            last = match
        ids = np.concatenate([*done, coder.join_all(leaves)] if leaves else done)
        first = parts.slice(0, 1)
        return pa.table([*(first[c] for c in keep), pa.array([ids.tobytes()], pa.binary()), pa.array([len(ids)], pa.int64())], names=[*keep, "ids", "n_tokens"])

    numbered = rows.withColumn("__row", F.monotonically_increasing_id()).where(F.length("__text") > span)
    parts = map_batches(numbered, cut, kept + "__row bigint, __seq int, __match int, __text string")
    encoded = map_batches(parts.repartition("__row", "__seq"), encode_part, kept + "__row bigint, __seq int, __match int, ids binary")
    return short.unionByName(encoded.groupBy("__row").applyInArrow(meet, schema))


def bpe_decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`encoded` with the text of its ids; special tokens appear as their own text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != into) + f", `{into}` string"

    def decode(batch: dict[str, list]) -> dict[str, list]:
        coder = byte_bpe(vocabulary)
        return batch | {into: [None if x is None else coder.decode(x) for x in batch[ids]]}

    return map_batches(encoded, decode, schema)


def encoded_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    decoded = bpe_decode(bpe_encode(docs, vocabulary), vocabulary)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op1_bpe_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded again."""
    return encoded_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES = {"op1_bpe_trees": op1_bpe_trees}
ORACLE: dict[str, str] = {}
