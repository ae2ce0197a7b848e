"""BPE encoding against the library, whole texts, long unsplit ones included."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from valuekit.llm import bpe_trees
from valuekit.llm.byte_bpe import ByteBpe, byte_bpe
from valuekit.llm.shared import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def own_ids(text):
    return np.frombuffer(byte_bpe(PATH).encode([text])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aelst'rd19 \n\t.,!é你<|>\x00ñ🙂  ")), max_size=80))
def test_units_agree(text):
    assert own_ids(text) == library_ids(text)
    assert byte_bpe(PATH).decode(byte_bpe(PATH).encode([text])[0]) == text


@pytest.mark.parametrize("text", ["", " ", "a\n b  c ", "x <|endoftext|> y<|endoftext|>", "it's  \n\n  we'll ", "  a"])
def test_special_cases(text):
    assert own_ids(text) == library_ids(text)


@pytest.mark.parametrize("alphabet", ["ab", "theinon", "0123456789", " ", "!?*-", "你好é", "the1!'s"])
def test_long_unsplit(alphabet):
    picks = random.Random(alphabet)
    text = "".join(picks.choice(alphabet) for _ in range(30_011))
    assert own_ids(text) == library_ids(text)


def test_words_are_learned_once():
    """Marks, line starts and a full cache do not send a word to the library again."""
    coder, asked = ByteBpe(PATH, cached=60), []
    word = coder._word
    coder._word = lambda text, before: asked.append(before + text) or word(text, before)
    texts = ["alpha beta\nalpha (x) beta... gamma$$$\nalpha!", "ñandú alpha\n\nbeta \n gamma", "beta\nalpha gamma''\n"]
    for k in range(40):
        more = [*texts, f"alpha w{'abcdefghij'[k % 10] * (1 + k // 10)} beta\nalpha"]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in coder.encode(more)] == [library_ids(t) for t in more]
    assert max(Counter(asked).values()) == 1 and coder.older


def test_query_rows(spark, sf):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    got = {r.doc_id: r for r in bpe_trees.op1_bpe_trees(spark, sf).collect()}
    assert set(got) == set(texts)
    for key, text in texts.items():
        ids = np.array(library_ids(text), dtype="<u4")
        assert got[key].n_tokens == len(ids)
        assert got[key].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[key].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids.tolist(), skip_special_tokens=False).encode()).hexdigest()


def test_defined_cases(spark):
    picks = random.Random(5)
    long = " ".join("".join(picks.choice("thein,") for _ in range(picks.randrange(1, 9000))) for _ in range(40))
    rows = [(1, None, "x"), (1, "", "y"), (2, "same", "z"), (2, "same", "z"), (3, long, None), (None, "a  b", "c"), (4, "q" * 90_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe_trees.bpe_encode(docs, PATH, span=5000).collect()
    expected = sorted((str(k), len(library_ids(t or "")), np.array(library_ids(t or ""), "<u4").tobytes()) for k, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.ids)) for r in got) == expected
    assert bpe_trees.encoded_digests(docs.limit(0), PATH).count() == 0
