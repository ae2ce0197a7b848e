"""Source divergence against the SQL twin and plain sums over all terms."""

import random
import re
from collections import Counter, defaultdict

from tests.llm.twins import same_as_twin
from valuekit.llm import source_bitmaps

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
        groups[lang].add(source)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        p = {}
        for s in [*sources, None]:
            c = counts[lang, s] if s is not None else sum((counts[lang, x] for x in sources), Counter())
            total = sum(c[t] for t in kept)
            p[s] = {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(p[s][t], p[None][t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > p[None][t]]
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", o.decode(), -v, i + 1) for i, (v, o) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def test_twin(spark):
    same_as_twin(spark, "/root/testdata/sf0.01", "op12_source_bitmaps")


def test_plain_sums(spark):
    picks = random.Random(12)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)] + ["Ärger", "ärger", "don't", "漢字", "a\u00a0b", "x9y"]
    rows = [(None, None, None), ("", "en", "silent"), ("123 456", "xx", "one"), (None, "xx", "two"), ("alone", "yy", "only")]
    for i in range(260):
        text = " ".join(picks.choice(words[: picks.choice([5, 40, 306])]) for _ in range(picks.randrange(60)))
        rows.append((text.upper() if i % 7 == 0 else text, picks.choice(["en", "en", "de", None]), picks.choice(["a", "b", "ß", "z", None, ""])))
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "text string, lang string, source string, n long, term string")
    for min_docs, top in ((3, 10), (10, 2), (1, 50), (1000, 5)):
        got = sorted(tuple(r) for r in source_bitmaps.divergence(docs, min_docs, top).collect())
        assert got == plain(rows, min_docs, top)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert source_bitmaps.divergence(docs).collect() == []


def test_large_counts_stay_exact(spark):
    n, total, v = 7_000_000_000_000, 9_000_000_000_000, 1_000_003
    row = spark.createDataFrame([(n, total, v)], "n long, n_all long, v long").select(source_bitmaps.share(source_bitmaps.F.col("n"), "n_all")).first()
    assert row[0] == 1 + 10**9 * (n + 2) // (total + 2 * v)
