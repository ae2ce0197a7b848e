"""Phrase collocations against the SQL twin and a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.twins import same_as_twin
from valuekit.llm import phrase_graph

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        yield re.findall("[^\x20\x09]+", piece)


def plain(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = {}
    often = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    inside = {}
    for (lang, w), v in often.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(v, inside.get((lang, w[i : i + k]), 0))
    for (lang, w), a in often.items():
        if inside.get((lang, w), 0) < a:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right, n[lang]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, m, -s) for lang, all_ in found.items() for i, (s, a, p, left, right, m) in enumerate(sorted(all_)[:top]))


def mined(spark, rows, least, top):
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "text string, lang string, id long, phrase string")
    return sorted(tuple(r) for r in phrase_graph.mine_phrases(docs, least, top).collect())


def test_twin(spark):
    same_as_twin(spark, "/root/testdata/sf0.01", "op11_phrase_graph")


def test_plain_count(spark):
    picks = random.Random(11)
    words = ["The", "the", "of", "a", "Ünder", "ünder", "x\x1cy", "x\u00a0y", "漢字", "q-9", "\x85", "no\x00ne"]
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, "en"), ("", None), (" \t ", "en"), (".,;", None), (passage, "en"), ("the " * 50, "de")]
    for _ in range(120):
        text = "".join(picks.choice(words) + picks.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", "\x0b", "\r\n", ": "]) for _ in range(picks.randrange(40)))
        rows.append((text + (passage if picks.random() < 0.2 else ""), picks.choice(["en", "en", "de", None, "und"])))
    for least, top in ((4, 2000), (9, 7), (1, 2000)):
        assert mined(spark, rows, least, top) == plain(rows, least, top)


def test_empty_and_rare(spark):
    assert mined(spark, [], 2, 10) == []
    assert mined(spark, [("a b c", "en"), (None, None)], 2, 10) == []


def test_windows_cover_each_word_once():
    picks = random.Random(5)
    texts = [" ".join(picks.choice("a b c d , ; e".split()) for _ in range(picks.randrange(300))) for _ in range(20)] + ["", "one"]
    for size in (1, 3, 50, 10_000):
        batch = pa.RecordBatch.from_pydict({"text": [t.encode() for t in texts], "lang": ["x", "y"] * 11})
        got = {k: Counter() for k in "xy"}
        for lang, words, starts in phrase_graph.windows(iter([batch]), size):
            for i in range(starts):
                end = next((j for j in range(i, min(i + 5, len(words))) if words[j] == b"\xff"), min(i + 5, len(words)))
                got[lang].update([tuple(words[i:end])] if end > i else [])
        for k, lang in enumerate("xy"):
            expected = Counter(tuple(x.encode() for x in w[i : i + 5]) for t in texts[k::2] for w in pieces(t) for i in range(len(w)))
            assert got[lang] == expected


def test_paths_keep_every_edge(spark):
    rows = [("a b c d e f g h i j", 3), ("x b c d e f g z", 2), ("r s t u v w r s t u v w k", 4)]
    edges, ends = Counter(), Counter()
    for text, n in rows:
        w = text.split()
        for i in range(len(w)):
            (edges if i + 5 <= len(w) else ends)[" ".join(w[i : i + 5])] += n
    table = [(i, "en", p, len(p.split()), n) for i, (p, n) in enumerate([*edges.items(), *ends.items()])]
    frame = spark.createDataFrame(table, "id long, lang string, phrase string, words int, n long")
    for piece in (1024, 2):
        paths = phrase_graph.unary_paths(frame, piece).collect()
        got = Counter()
        for r in paths:
            w = r.path.split()
            got.update({" ".join(w[i : i + 5]): r.n for i in range(len(w) - 4)})
        assert got == edges
        assert len(paths) < len(edges)
    long = [(i, "en", " ".join(f"w{j}" for j in range(i, i + 5)), 5, 7) for i in range(300)] + [(900, "en", "w300 w301 w302 w303", 4, 7)]
    assert phrase_graph.unary_paths(spark.createDataFrame(long, frame.schema)).count() == 1


def test_edges_of_a_window():
    ids = np.array([1, 2, 3, 0, 1, 2, 3, 4, 1, 2])
    got = Counter()
    for columns, n in phrase_graph.edges_of(ids, 7, np.array([3, 2, 1, 0, 5, 5, 2, 0, 2, 1])):
        got.update(dict(zip(zip(*(c.tolist() for c in columns)), n.tolist())))
    assert got == {(1, 2, 3): 1, (2, 3): 1, (3,): 1, (1, 2, 3, 4, 1): 1, (2, 3, 4, 1, 2): 1, (3, 4): 1}


def test_slot_tables_come_back():
    picks = np.random.default_rng(0)
    for share in (0.001, 0.2, 0.9):
        sums = np.where(picks.random(1 << 18) < share, picks.integers(1, 101, 1 << 18), 0).astype(np.uint8)
        back = np.zeros_like(sums).reshape(4, -1)
        for row, data in phrase_graph.packed_rows(sums):
            back[row] = phrase_graph.unpacked_row(data, 1 << 16)
        assert (back.ravel() == sums).all()
