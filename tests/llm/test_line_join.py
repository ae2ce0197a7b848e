"""Line deduplication against its SQL twin and a brute-force version."""

import random
import time

from pyspark.sql import functions as F

from tests.llm.twins import same_as_twin
from valuekit.llm import line_join


def tokens(line):
    words = [w for w in line.split(" ") if w]
    return {tuple(words)} if len(words) <= 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Rows of (doc_id, text) with distinct ids, in order of id."""
    seen, out = [], {}
    for key, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            if not line.strip(" "):
                kept.append(line)
                continue
            own = tokens(line)
            alike = any(5 * len(own & s) >= 4 * len(own | s) for s in seen)
            seen.append(own)
            if not alike:
                kept.append(line)
        out[key] = "\n".join(kept)
    return out


def test_twin(spark):
    same_as_twin(spark, "/root/testdata/sf0.001", "op7_line_join")


def test_brute_force(spark):
    picks = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    base = [[picks.choice(words) for _ in range(picks.randrange(1, 70))] for _ in range(30)]
    rows = []
    for key in range(60):
        lines = []
        for _ in range(picks.randrange(0, 6)):
            line = list(picks.choice(base))
            for _ in range(picks.randrange(0, 3)):
                line[picks.randrange(len(line))] = picks.choice(words)
            lines.append(" ".join(line))
        rows.append((key, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_join.dedup_lines(docs).collect()}
    assert got == brute(rows)


def test_defined_cases(spark):
    long = "\n".join(f"line {i} of a long text that says {i * i} and {i * 7} things" for i in range(3000))
    rows = [(None, "a\na", 1), (1, None, 2), (2, "", 3), (3, "a\n\n \na", 4), (3, "a\n\n \na", 5), (4, "a", 6), (5, long, 7), (6, long, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_removed int").withColumn("row", docs_row())
    got = sorted((str(r.doc_id), r.text, r.n_removed) for r in line_join.dedup_lines(docs).collect())
    assert [(k, t, n) for k, t, n in got if k not in "56"] == [("1", None, 0), ("2", "", 0), ("3", "a\n\n ", 1), ("3", "a\n\n ", 1), ("4", "", 1), ("None", "a\na", 0)]
    assert dict((k, t) for k, t, _ in got)["5"] == brute([(5, long)])[5]
    assert dict((k, t) for k, t, _ in got)["6"] == ""
    assert line_join.dedup_lines(docs.limit(0)).count() == 0


def docs_row():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_ranks_count_every_shingle(spark):
    lines = spark.createDataFrame([("a b c d e  a b c d e a b c d e f",), ("x y",), ("x y",), ("x y z",)], "line string")
    held = line_join._ranks(lines)
    rank = lambda tokens: F.get(held, line_join._bucket(F.element_at(tokens, 1)))
    got = {r.line: r.rank for r in line_join.with_tokens(lines).select("line", rank("tokens").alias("rank")).collect()}
    assert got == {"a b c d e  a b c d e a b c d e f": 1, "x y": 1, "x y z": 0}


def test_buckets_are_counted_in_wide_rows(spark):
    """Every bucket has its own count, in rows of COUNTERS buckets."""
    assert line_join.BUCKETS % line_join.COUNTERS == 0
    lines = spark.createDataFrame([(f"word{i % 3000}",) for i in range(9000)] + [(f"word{i}",) for i in range(0, 3000, 3)], "line string")
    held = line_join._ranks(lines)
    tokens = line_join.with_tokens(lines).select(line_join._bucket(F.element_at("tokens", 1)).alias("b"))
    counts = tokens.groupBy("b").agg(F.floor(F.log2(F.count(F.lit(1)))).cast("int").alias("power"))
    rows = counts.select("power", F.get(held, "b").alias("rank")).collect()
    assert len(rows) > 2900 and all(r.power == r.rank for r in rows) and {r.rank for r in rows} >= {1, 2}


def spread(spark, sets):
    """Prefixes (k1, n, i, code) of sets of numbers, in the order of the numbers."""
    rows = [(k, len(s), i, c) for k, s in enumerate(sets) for i, c in enumerate(sorted(s)[: len(s) - -(-4 * len(s) // 5) + 1])]
    return spark.createDataFrame(rows, "k1 long, n int, i int, code long")


def test_no_similar_pair_is_left_out(spark):
    """Sets around the threshold, of equal and of unequal size, with the differences anywhere in the order."""
    picks = random.Random(4)
    sets = []
    for size in (1, 2, 4, 5, 9, 10, 18, 45, 90):
        for _ in range(4):
            base = picks.sample(range(10_000), size)
            for gone, new in ((0, 0), (size // 9, size // 9), (size // 9 + 1, size // 9 + 1), (size // 5, 0), (0, size // 4), (size // 10, size // 10)):
                sets.append({*picks.sample(base, max(1, size - gone)), *picks.sample(range(10_000, 20_000), new)})
    got = {(r.ka, r.kb) for r in line_join._candidates(spread(spark, sets)).collect()}
    alike = {(a, b) for b in range(len(sets)) for a in range(b) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert len(alike) > 100 and alike <= got


def test_a_common_phrase_makes_no_pairs(spark, monkeypatch):
    """With buckets as full as those of a large table, which tell nothing of rarity."""
    monkeypatch.setattr(line_join, "_ranks", lambda lines: F.array_repeat(F.lit(0), line_join.BUCKETS))
    kept = {}
    written = line_join.settled
    monkeypatch.setattr(line_join, "settled", lambda df, name: kept.setdefault(name, written(df, name)))
    lines = [" ".join([*[f"a{i}w{k}" for k in range(20)], *[f"p{i // 4}w{k}" for k in range(6)], *[f"b{i}w{k}" for k in range(20)]]) for i in range(120)]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_join.dedup_lines(docs).collect()} == dict(enumerate(lines))
    assert kept["line-join-pairs"].count() == 0


def test_steps_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {b for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    docs = spark.createDataFrame([(i, f"line {i % 7} of a short text\nline {i} that is no other one") for i in range(50)], "doc_id long, text string")
    result = line_join.dedup_lines(docs)
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(key, None) == was
    assert result.count() == 50 and result.count() == 50
