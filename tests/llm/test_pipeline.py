"""The pipeline, stage by stage, against brute-force versions of the stages."""

import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_bench_simhash, test_line_join, test_ngram_join
from valuekit.llm import kernel_quality, line_join, ngram_join
from valuekit.llm.shared import settled, table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, sf), "test-pipeline")
        if name == "quality":
            kept = {r.doc_id for r in kernel_quality.op3_kernel_quality(spark, sf).collect() if r.predicted}
            texts = {k: t for k, t in texts.items() if k in kept}
        elif name == "line_dedup":
            texts = test_line_join.brute(list(texts.items()))
        elif name == "near_duplicates":
            kept = {int(k) for k, c, _ in test_ngram_join.brute(list(texts.items())) if k == c}
            texts = {k: t for k, t in texts.items() if k in kept}
        elif name == "decontamination":
            leaks = {k for k, _ in test_bench_simhash.brute(list(texts.items()), items)}
            texts = {k: t for k, t in texts.items() if k not in leaks}
        if name != "bpe":
            assert docs.columns == columns
            assert {r.doc_id: r.text for r in docs.collect()} == texts, name
            assert all(r.n_chars == len(r.text) for r in docs.collect())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in docs.collect():
        ids = np.array(library.encode(texts[r.doc_id], add_special_tokens=False).ids, "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert docs.count() == len(texts) > 0
    assert corpus_pipeline.run(spark, sf).count() == len(texts)


def test_odd_rows_and_empty_tables(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("labels", "benchmark"):
        table(spark, source, name).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = table(spark, source, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (5000, None, "en", "s", 0), (5001, "", None, "s", 0), (5002, "ok " * 60_000, "en", None, None), (5003, "twice a row", "en", "s", 11), (5003, "twice a row", "en", "s", 11)], docs.schema)
    mixed = docs.union(odd)
    for name, stage in corpus_pipeline.STAGES[1:]:
        mixed = settled(stage(spark, mixed, str(tmp_path)), "test-odd")
    assert mixed.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


CLASHING = ["__row", "__drops", "__doc", "__hash", "score", "predicted", "held_out", "Features", "n_lines", "n_removed", "row", "line", "k1", "node", "tokens", "label", "pipeline_0", "odd name"]


def test_clashing_names_come_back_as_they_were(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("labels", "benchmark"):
        table(spark, source, name).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = table(spark, source, "documents").where("doc_id < 60")
    wide = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = {r.doc_id: r.text for r in stage(spark, docs, str(tmp_path)).collect()}
        got = stage(spark, wide, str(tmp_path))
        assert got.columns == wide.columns, name
        rows = got.collect()
        assert {r.doc_id: r.text for r in rows} == plain, name
        assert all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASHING), name
    assert corpus_pipeline.STAGES[-1][1](spark, wide, str(tmp_path)).count() == 60


def test_operators_keep_clashing_columns(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").where("doc_id < 60").select("doc_id", "text")
    wide = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in ("__row", "__drops", "__doc", "__hash", "features")])
    for made in (line_join.dedup_lines(wide), ngram_join.keep_first(wide)):
        assert all(r[c] == f"{c}-{r.doc_id}" for r in made.collect() for c in wide.columns[2:])
    scored = kernel_quality.score_quality(wide.withColumn("score", F.lit("x")), table(spark, "/root/testdata/sf0.001", "labels"), keep=("doc_id", "features", "score", "__row"))
    assert scored.columns == ["doc_id", "__row", "held_out", "score", "predicted"] and scored.count() == docs.count()
