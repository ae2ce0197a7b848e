"""N-gram Jaccard join against its SQL twin and brute force."""

import random

import numpy as np

from tests.llm.twins import same_as_twin
from valuekit.llm import ngram_join


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w)} if len(w) <= 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """Sorted (doc_id, class_id, n_links) of rows, by position."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    link = [[i != j and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in range(n) if link[i][j])]) for i in range(n)]
    least = {c: min((rows[i][0] for i in range(n) if label[i] == c and rows[i][0] is not None), default=None) for c in set(label)}
    return sorted((str(rows[i][0]), str(least[label[i]]), sum(link[i])) for i in range(n))


def test_twin(spark):
    same_as_twin(spark, "/root/testdata/sf0.001", "op8_ngram_join")


def test_brute_force_with_copies_ties_and_nulls(spark):
    picks = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    base = [[picks.choice(words) for _ in range(picks.randrange(3, 160))] for _ in range(12)]
    rows = [(None, "alone and without a name"), (500, None), (501, ""), (502, " \n"), (7, "same id"), (7, "same id"), (None, "same id")]
    for key in range(110):
        text = list(picks.choice(base))
        for _ in range(picks.randrange(0, 4)):
            text[picks.randrange(len(text))] = picks.choice(words)
        rows.append((key + 10, " ".join(text)))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, k1 string, node int")
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in ngram_join.near_duplicates(docs).collect())
    assert got == brute(rows)
    kept = [r.doc_id for r in ngram_join.keep_first(docs).collect() if r.doc_id not in (None, 7)]
    assert sorted(kept) == sorted({int(c) for k, c, _ in brute(rows) if k == c and c not in ("None", "7")})


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.label for r in ngram_join.components(links).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}


def test_short_forms_and_thresholds():
    picks = np.random.default_rng(0)
    tokens = picks.integers(-(2**62), 2**62, 4000)
    a, b = tokens[:3600], tokens[400:]
    values = np.vstack([ngram_join.signatures(t, np.array([0])) for t in (a, b)])
    assert abs((values[0] == values[1]).mean() - 3200 / 4000) < 0.15
    assert ngram_join.fewest_matches(32) < ngram_join.fewest_matches(64) < ngram_join.fewest_matches(128) < 110


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.near_duplicates(docs).count() == 0


def test_one_row_of_a_group_stays(spark):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(60))
    a, b, c, d = (text(k) for k in range(4))
    rows = [(5, a), (9, a), (9, b), (7, c), (7, c), (None, c + " end"), (None, d), (None, d), (None, d + " end"), (None, None), (11, "")]
    got = ngram_join.keep_first(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, k1 string")).collect()
    kept = sorted((str(r.doc_id), r.text) for r in got)
    either = [(str(k), t) for k, t in [(5, a), (9, b), (7, c), (11, "")]]
    assert kept in (sorted([*either, ("None", d)]), sorted([*either, ("None", d + " end")]))
