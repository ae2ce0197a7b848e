"""Token ids in files of byte planes (operator 5).

Documents are dealt into shards by ranges of doc_id and sorted there. A shard's ids form blocks of BLOCK
ids; the four bytes of the ids are transposed into planes and each plane is compressed with zstandard.
Files are parquet, written and committed by Spark, one row a block:

    shard, block    place of the block; shards ascend with doc_id
    n_ids           ids in the block: BLOCK, but for a shard's last
    planes          compressed planes, lowest byte first
    doc_ids, at     documents that start in the block and their offsets in it
    open_id, open_at  document that began in an earlier block and its offset in the shard, else null
    closed          whether a document ends at the block's end

Beside them lies the chunk index: shard, block, first id of the block in the whole corpus, n_ids, bytes.

Defined cases: a null text counts as empty, so it has the end id only; a null doc_id comes first; rows that
share a doc_id follow each other ordered by text, one entry each; extra columns are not read; an empty table
gives no blocks and no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuekit.llm.byte_bpe import byte_bpe
from valuekit.llm.shared import pa_schema, shared_folder, small_batches, table

BLOCK = 65_536
END_ID = 2
#: Encoded words that a worker keeps, about 200 bytes each (memory only).
CACHED = 1_000_000
VOCABULARY = "byte_bpe_50k.json"
BLOCKS = "shard int, block int, n_ids int, planes array<binary>, doc_ids array<bigint>, at array<int>, open_id bigint, open_at bigint, closed boolean"


def planes_of(ids: bytes) -> list[bytes]:
    """The byte planes of little-endian 32-bit ids, compressed."""
    packer = zstandard.ZstdCompressor(level=3)
    return [packer.compress(p.tobytes()) for p in np.frombuffer(ids, np.uint8).reshape(-1, 4).T]


def ids_of(planes: list[bytes], n_ids: int) -> bytes:
    """The ids of compressed planes."""
    unpack = zstandard.ZstdDecompressor().decompress
    return np.stack([np.frombuffer(unpack(p, max_output_size=max(n_ids, 1)), np.uint8) for p in planes], axis=1).tobytes()


def write_planes(docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID, block: int = BLOCK) -> None:
    """Encode the texts of `docs` (doc_id, text) and write blocks and their index below `folder`."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = pa_schema(spark, BLOCKS)
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = byte_bpe(vocabulary, CACHED), TaskContext.get().partitionId()
        held, number, done = bytearray(), 0, 0
        doc_ids: list = []
        at: list[int] = []
        open_id, open_at = None, None
        last_id, last_at = None, None

        def row(size: int) -> pa.RecordBatch:
            nonlocal held, number, done, doc_ids, at, open_id, open_at
            data, full = bytes(held[: 4 * size]), len(held) == 4 * size
            values = (shard, number, size, planes_of(data), doc_ids, at, open_id, open_at, full)
            held, number, done = held[4 * size :], number + 1, done + size
            open_id, open_at = (None, None) if full else (last_id, last_at)
            doc_ids, at = [], []
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for key, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("text").to_pylist())):
                last_id, last_at = key, done + len(held) // 4
                doc_ids.append(key)
                at.append(len(held) // 4)
                held += ids + end
                while len(held) > 4 * block:
                    yield row(block)
                if len(held) == 4 * block:
                    yield row(block)
        if held:
            yield row(len(held) // 4)

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sorted_rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    sorted_rows.mapInArrow(pack, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    size = F.aggregate("planes", F.lit(0), lambda s, p: s + F.octet_length(p))
    starts = _shard_starts(blocks)
    index = blocks.join(starts, "shard").select("shard", "block", (F.col("shard_start") + F.col("block").cast("long") * block).alias("first_id"), "n_ids", size.alias("bytes"))
    index.write.parquet(f"{folder}/index")


def _shard_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each shard. One row a shard, so the running sum is over as many rows as there were tasks."""
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))


def read_planes(spark: SparkSession, folder: str, block: int = BLOCK) -> DataFrame:
    """Documents of written files: doc_id, start (ids of all documents before it), n_tokens, ids.

    A document inside one block comes straight from it. The parts of one that spans blocks meet by its place.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    index = spark.read.schema("shard int, block int, first_id bigint, n_ids int, bytes int").parquet(f"{folder}/index")
    starts = index.groupBy("shard").agg(F.min("first_id").alias("shard_start"))
    parts = "shard int, doc_id bigint, at bigint, block int, ids binary"
    schema = pa_schema(spark, parts)

    def unpack(inside: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                cuts = [*r["at"], r["n_ids"]]
                spans = list(zip(r["doc_ids"], [r["first"] + a for a in r["at"]], cuts, cuts[1:], [True] * len(r["at"])))
                if spans and not r["closed"]:
                    spans[-1] = (*spans[-1][:4], False)
                if r["open_at"] is not None:
                    spans.insert(0, (r["open_id"], r["open_at"], 0, cuts[0], False))
                spans = [s for s in spans if s[4] == inside]
                if not spans:
                    continue
                data = ids_of(r["planes"], r["n_ids"])
                columns = [[r["shard"]] * len(spans), [s[0] for s in spans], [s[1] for s in spans], [r["block"]] * len(spans), [data[4 * s[2] : 4 * s[3]] for s in spans]]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    small_batches(spark)
    placed = blocks.withColumn("first", F.col("block").cast("long") * block)
    whole = placed.mapInArrow(lambda b: unpack(True, b), parts)
    split = placed.mapInArrow(lambda b: unpack(False, b), parts)
    ordered = F.array_sort(F.collect_list(F.struct("block", "ids")))
    joined = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda done, part: F.concat(done, part["ids"]))
    met = split.groupBy("shard", "doc_id", "at").agg(joined.alias("ids"))
    # One row a shard, and a shard is a task of the writing job: small enough to broadcast at any size.
    both = whole.select("shard", "doc_id", "at", "ids").unionByName(met).join(F.broadcast(starts), "shard")
    return both.select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def op5_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written to plane files and read back."""
    folder = f"{shared_folder(spark)}/id-planes-{uuid.uuid4().hex}"
    write_planes(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), folder)
    return read_planes(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op5_id_planes": op5_id_planes}
ORACLE: dict[str, str] = {}
