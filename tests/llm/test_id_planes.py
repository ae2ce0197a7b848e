"""Ids written to plane files and read back, against the library."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from valuekit.llm import id_planes
from valuekit.llm.shared import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(rows):
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_planes_round_trip():
    picks = np.random.default_rng(1)
    for n in (1, 7, 1000):
        ids = picks.integers(0, 2**32, n, dtype=np.uint32).astype("<u4").tobytes()
        assert id_planes.ids_of(id_planes.planes_of(ids), n) == ids


def test_query_rows(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = id_planes.op5_id_planes(spark, sf).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected(rows)


def test_small_blocks_and_cases(spark, tmp_path):
    picks = random.Random(3)
    rows = [(i, " ".join(picks.choice(["the", "of", "ing", "é"]) for _ in range(picks.randrange(60)))) for i in range(80)]
    rows += [(7, None), (7, rows[7][1]), (None, "x"), (200, "word " * 300)]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, start string")
    for block in (16, 64):
        id_planes.write_planes(docs, PATH, f"{tmp_path}/{block}", block=block)
        got = id_planes.read_planes(spark, f"{tmp_path}/{block}", block=block).collect()
        found = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in sorted(got, key=lambda r: r.start)]
        assert found == expected(rows)
        index = spark.read.parquet(f"{tmp_path}/{block}/index").orderBy("first_id").collect()
        assert [r.first_id for r in index] == np.cumsum([0, *(r.n_ids for r in index)])[:-1].tolist()


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    id_planes.write_planes(docs, PATH, f"{tmp_path}/none")
    assert id_planes.read_planes(spark, f"{tmp_path}/none").count() == 0
