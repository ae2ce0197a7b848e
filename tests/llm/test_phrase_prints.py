"""Fingerprints: parsing against a plain version, shift resistance, and the query against brute force."""

import hashlib
import random

import numpy as np

from valuekit.llm import phrase_prints as pp
from valuekit.llm.shared import table

MASK = 2**64 - 1


def mixed(v):
    v = ((v ^ (v >> 32)) * 0x9E3779B97F4A7C15) & MASK
    return v ^ (v >> 29)


def plain_names(text):
    symbols, out = [mixed(ord(c) + 1) for c in text], set()
    for level in range(1, max(pp.LEVELS) + 1):
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        symbols = [mixed((s + n * 0x9E3779B97F4A7C15) & MASK) if n > 1 else s for s, n in runs]
        labels = symbols
        for _ in range(4):
            fresh = []
            for i, x in enumerate(labels):
                d = x ^ (labels[i - 1] if i else x ^ 1)
                low = (d & -d).bit_length() - 1 if d else 0
                fresh.append(2 * low + ((x >> low) & 1))
            labels = fresh
        n = len(labels)
        starts = [i for i in range(n) if i == 0 or (labels[i] > labels[i - 1] and (i == n - 1 or labels[i] > labels[i + 1]))]
        symbols = [mixed((sum(s * pow(pp._BASE, k, 2**64) for k, s in enumerate(symbols[a:b])) + b - a) & MASK) for a, b in zip(starts, [*starts[1:], n])]
        if level in pp.LEVELS:
            out |= {mixed((s + level) & MASK) >> 32 for s in symbols}
    return sorted(out)


def test_parsing_is_that_of_the_plain_version():
    picks = random.Random(4)
    texts = ["", "a", "aaaa", "ab"] + ["".join(picks.choice("abé🙂 the") for _ in range(picks.randrange(1, 900))) for _ in range(30)]
    assert [n.tolist() for n in pp.phrase_names(texts)] == [plain_names(t) if t else [] for t in texts]


def test_shifted_and_unlike_texts():
    picks = random.Random(5)
    say = lambda n: " ".join("".join(picks.choice("theinaors") for _ in range(picks.randrange(2, 9))) for _ in range(n))
    a, b = say(400), say(400)
    names, shifted, other = pp.phrase_names([a, "x" + a[:50] + "inserted" + a[50:], b])
    assert len(np.intersect1d(names, shifted)) / len(np.union1d(names, shifted)) > 0.9
    assert len(np.intersect1d(names, other)) / len(np.union1d(names, other)) < 0.1


def brute(rows):
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (key, text), (_, after) in zip(ordered, [*ordered[1:], ordered[0]]):
        k = len(text) // 3
        changed = text[: len(text) - k] + after[:k]
        a, b, c = pp.fingerprints([text, changed, after])
        out[key] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), pp.packed(a).hex(), pp.packed(b).hex(), pp.likeness(a, b), pp.likeness(a, c))
    return out


def test_query_rows(spark, sf):
    rows = [(r.doc_id, r.text or "") for r in table(spark, sf, "documents").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in pp.op4_phrase_prints(spark, sf).collect()}
    assert got == brute(rows)
    values = list(got.values())
    assert np.mean([v[4] for v in values]) > 0.35 and np.mean([v[5] for v in values]) < 0.1


def test_defined_cases(spark):
    docs = spark.createDataFrame([(3, None, 1), (2, "", 1), (1, "only some text " * 9000, 1), (1, "x", 1), (None, "nameless", 1)], "doc_id long, text string, fingerprint int")
    got = pp.compare_with_next(docs).collect()
    assert len(got) == 5 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    empty = next(r for r in got if r.doc_id == 3)
    assert (empty.fingerprint, empty.near_edited, empty.near_next) == ("", 1.0, 1.0)
    single = pp.compare_with_next(docs.where("doc_id = 3 OR doc_id = 2").limit(1)).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
    assert pp.compare_with_next(docs.limit(0)).count() == 0
