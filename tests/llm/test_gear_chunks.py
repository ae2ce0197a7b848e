"""Content-defined chunks against plain versions."""

import random

from valuekit.llm import gear_chunks as gc
from valuekit.llm.shared import table


def plain_ends(text):
    low, high = gc._gear()
    sums, out = 0, []
    for i, c in enumerate(text):
        sums = ((sums << 1) + int(low[ord(c) & 0xFF] ^ high[ord(c) >> 8])) % 2**32
        if i + 1 >= gc.WINDOW and sums < 2**32 // gc.AVERAGE:
            out.append(i + 1)
    return out if not text or (out and out[-1] == len(text)) else [*out, len(text)]


def brute(rows):
    """doc_id to kept text, for distinct ids."""
    first = {}
    cut = {}
    for key, text in rows:
        ends = plain_ends(text or "")
        cut[key] = [(text or "")[a:b] for a, b in zip([0, *ends], ends)]
        for c in cut[key]:
            first[c] = min(first.get(c, key), key)
    out = {}
    for key, chunks in cut.items():
        kept, run = [], []
        for c in [*chunks, None]:
            if c is not None and first[c] < key:
                run.append(c)
                continue
            held = "".join(run)
            kept += [held if len(held) < gc.RUN else "", c or ""]
            run = []
        out[key] = "".join(kept)
    return out


def test_ends_are_those_of_the_rolling_hash():
    picks = random.Random(1)
    for n in (0, 1, 31, 32, 33, 500, 5000):
        text = "".join(picks.choice("abcde fghé你🙂") for _ in range(n))
        assert gc.chunk_ends(text) == plain_ends(text)


def test_insertions_do_not_move_later_cuts():
    picks = random.Random(2)
    text = "".join(picks.choice("abcdefgh ") for _ in range(4000))
    moved = {e - 7 for e in gc.chunk_ends("0123456" + text)}
    assert {e for e in gc.chunk_ends(text) if e > 2 * gc.WINDOW} <= moved


def test_query_rows(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = gc.op9_gear_chunks(spark, sf).collect()
    assert {r.doc_id: r.text for r in got} == brute(rows) and len(got) == len(rows)
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        assert r.n_chars == len(r.text) and r.n_removed == len(text) - len(r.text) == sum(s.end - s.start for s in r.spans)


def test_planted_passages_and_cases(spark):
    picks = random.Random(3)
    word = lambda: "".join(picks.choice("theinaorsd") for _ in range(picks.randrange(2, 9)))
    say = lambda n: " ".join(word() for _ in range(n))
    passage = say(60)
    rows = [(i, say(80) + " " + passage + " " + say(40)) for i in range(1, 30)] + [(i, say(150)) for i in range(30, 60)]
    rows += [(None, passage), (70, None), (71, ""), (72, "x" * 50_000), (73, "x" * 50_000)]
    docs = spark.createDataFrame([*[(*r, "e") for r in rows], (1, rows[0][1], "e")], "doc_id long, text string, row string")
    got = gc.dedup_substrings(docs).collect()
    assert len(got) == len(rows) + 1
    by_id = {r.doc_id: r for r in got}
    assert all(r.n_removed == 0 for r in got if r.doc_id is None or r.doc_id == 1 or 30 <= r.doc_id < 60)
    assert all(by_id[i].n_removed > 0 for i in range(2, 30)) and by_id[73].text == "" and by_id[70].text == ""
    assert gc.dedup_substrings(docs.limit(0)).count() == 0


def test_nearly_every_passage_of_50_words_is_found(spark):
    picks = random.Random(4)
    word = lambda: "".join(picks.choice("etaoinshrdlu") for _ in range(picks.randrange(3, 8)))
    say = lambda n: " ".join(word() for _ in range(n))
    passages = [say(picks.randrange(50, 61)) for _ in range(400)]
    rows = [(2 * i + k, f"{say(60)} {p} {say(60)}") for i, p in enumerate(passages) for k in range(2)]
    got = gc.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id % 2 = 1").collect()
    shares = [r.n_removed / len(passages[r.doc_id // 2]) for r in got]
    assert len(got) == 400 and sum(s > 0 for s in shares) >= 396
    assert sum(shares) / 400 > 0.75
