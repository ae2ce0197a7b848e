"""Transducer counts against the library."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from valuekit.llm import piece_counts
from valuekit.llm.piece_counts import MARK, piece_counter
from valuekit.llm.shared import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def library_count(text):
    return len(LIBRARY.encode(text))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aelsthernouig  \n\t.,é▁ß你🙂0<s>")), max_size=60))
def test_counts_agree(text):
    assert piece_counter(PATH).count(text) == library_count(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aelsthernouig ▁é你")), min_size=1, max_size=60), st.integers(1, 20))
def test_chunk_maps_compose(text, size):
    counter = piece_counter(PATH)
    marked = MARK + text.replace(" ", MARK)
    maps = [counter.chunk_map(marked[i : i + size]) for i in range(0, len(marked), size)]
    assert counter.composed(maps)["total"] == library_count(text)


@pytest.mark.parametrize("alphabet", ["ab", "theinon", " ", "你好é", "the of "])
def test_long_texts(alphabet):
    picks = random.Random(alphabet)
    text = "".join(picks.choice(alphabet) for _ in range(20_011))
    counter = piece_counter(PATH)
    marked = MARK + text.replace(" ", MARK)
    assert counter.count(text) == library_count(text)
    assert counter.composed([counter.chunk_map(marked[i : i + 900]) for i in range(0, len(marked), 900)])["total"] == library_count(text)


def test_query_rows(spark, sf):
    got = {r.doc_id: r for r in piece_counts.op6_piece_counts(spark, sf).collect()}
    rows = table(spark, sf, "documents").collect()
    assert len(got) == len(rows)
    for r in rows:
        n = library_count(r.text or "")
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len((r.text or "").encode()), n, n > 4096)


def test_defined_cases(spark):
    picks = random.Random(2)
    long = " ".join("".join(picks.choice("theon,é") for _ in range(picks.randrange(0, 40))) for _ in range(900))
    rows = [(1, None, "x"), (1, "", "x"), (2, "same one", "x"), (2, "same one", "x"), (None, long, None), (3, "q" * 5000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = piece_counts.count_tokens(docs, PATH, chunk=700).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted((str(k), len((t or "").encode()), library_count(t or "")) for k, t, _ in rows)
    assert piece_counts.count_tokens(docs.limit(0), PATH).count() == 0
