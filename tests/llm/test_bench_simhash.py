"""Decontamination against its SQL twin and brute force."""

import random
from collections import Counter

from tests.llm.twins import same_as_twin
from valuekit.llm import bench_simhash


def counts(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(docs, items):
    """Pairs with a window of the item's size, at any place, that reaches the threshold."""
    out = set()
    for key, text in docs:
        w = (text or "").lower().split()
        there = counts(w).keys()
        for item, passage in items:
            p = (passage or "").lower().split()
            if key is None or len(p) < 5:
                continue
            own = counts(p)
            if own.keys().isdisjoint(there):
                continue
            for i in range(max(len(w) - len(p), 0) + 1):
                c = counts(w[i : i + len(p)])
                if 5 * (c & own).total() >= 4 * (c | own).total() > 0:
                    out.add((key, item))
    return out


def test_twin(spark):
    same_as_twin(spark, "/root/testdata/sf0.001", "op10_bench_simhash")


def test_brute_force_and_cases(spark):
    picks = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    say = lambda n: [picks.choice(words) for _ in range(n)]
    items = [(i, " ".join(say(picks.randrange(12, 50)))) for i in range(15)] + [(90, "too short item"), (91, None), (92, ""), (93, "five words are just enough"), (94, "five words are just enough")]
    docs = [(None, items[0][1]), (1, None), (2, ""), (3, "a b"), (4, "Five  words\nare just ENOUGH"), (5, items[1][1]), (5, items[2][1]), (6, items[3][1] + " " + items[4][1])]
    for key in range(10, 70):
        passage = picks.choice(items[:15])[1].split()
        for _ in range(picks.randrange(0, 3)):
            passage[picks.randrange(len(passage))] = picks.choice(words)
        docs.append((key, " ".join(say(picks.randrange(0, 80)) + passage + say(picks.randrange(0, 80)))))
    docs.append((99, " ".join(say(20_000)) + " " + items[7][1]))
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    found = {(r.doc_id, r.item_id) for r in bench_simhash.find_leaks(d, b).collect()}
    assert found == brute(docs, items)
    kept = [r.doc_id for r in bench_simhash.decontaminate(d, b).collect()]
    assert sorted(map(str, kept)) == sorted(str(k) for k, _ in docs if k not in {x for x, _ in found})
    assert bench_simhash.find_leaks(d.limit(0), b).count() == 0
    assert bench_simhash.find_leaks(d, b.limit(0)).count() == 0
