"""Line deduplication by an exact set-similarity join, in DataFrame functions only (operator 7).

The tokens of a line are its five-word shingles (a line of up to five words is one token), as 64-bit hashes.
A later line goes when an earlier one, by (doc_id, row, line number), has the same text or a Jaccard
similarity of THRESHOLD or more.

1. Lines of equal text become one class, known by its earliest line.
2. Tokens are ordered by rarity: counts of all tokens in BUCKETS buckets, as powers of two, then the hash. Any
   order gives the same result; rare tokens first keep the lists of common tokens short.
3. Two similar lines share a token among the first n - ceil(t n) + 1 of each (prefix filter). Classes meet by
   such tokens if their sizes allow the similarity (length filter) and so do the tokens left after the
   shared one (positional filter). Where the sizes need several shared ones among those tokens, up to SHARED of them
   are asked for (count filter), so lines with one common phrase do not become a pair.
4. The pairs fetch their lines and the exact similarity decides.

Each step ends in files or on the driver, and its shuffle files go before the next one begins.

Defined cases: documents with a null doc_id or null text come back as they are and are not compared; lines
without words always stay; rows that share doc_id and text are one row for the comparison and each comes back
with the same lines; rows that share doc_id only are ordered by a hash of the text; extra columns are
kept, whatever their names, but for `n_lines` and `n_removed`, which are counted anew; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.shared import free_names, membership, settled, shuffles_freed, table

WORDS = 5
#: The similarity from which lines count as the same, as numerator and denominator.
THRESHOLD = (4, 5)
#: Size of the table of token counts that orders tokens; the order decides speed only.
BUCKETS = 1 << 18
SEGMENT = 1024
#: Shared tokens that the count filter asks for at most; it decides speed only.
SHARED = 3
#: Buckets that are counted in one row: so few rows that Spark's fast hash map holds them all.
COUNTERS = 16
#: Size of the bitmaps that sort out lines and documents before they are joined; it decides speed only.
BITMAP = 1 << 20
_CODE_BITS = 58
# Generators of computed arrays are outer ones: for the others the optimizer adds a filter on the array's size
# below, which repeats the whole computation. The arrays are never empty, so the rows are the same.


def _words(line: str) -> Column:
    """Hashes of the words of a line."""
    return F.transform(F.array_remove(F.split(line, " "), ""), lambda w: F.xxhash64(w))


def _token(i: Column) -> Column:
    """The shingle that begins at a word of a longer line."""
    return F.xxhash64(*[F.get("words", i + k) for k in range(WORDS)])


def with_tokens(lines: DataFrame, line: str = "line") -> DataFrame:
    """`lines` with `tokens`, the distinct shingle hashes of each line."""
    hashed = lines.withColumn("words", _words(line))
    many = F.transform(F.sequence(F.lit(0), F.size("words") - WORDS), _token)
    tokens = F.when(F.size("words") > WORDS, many).otherwise(F.array(F.xxhash64("words")))
    return hashed.withColumn("tokens", F.array_distinct(tokens)).drop("words")


def exploded(docs: DataFrame) -> DataFrame:
    """Lines that hold a word: doc_id, row, line_no, line."""
    lines = docs.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where(F.trim("line") != "")


def _bucket(token: Column) -> Column:
    return token.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _ranks(lines: DataFrame) -> Column:
    """An array with the power of two of the token count of each bucket.

    Shingles become rows without an array of them, which Spark compiles; one that repeats in its line counts each time.
    Spark joins the powers of SEGMENT buckets to one text, so the driver gets BUCKETS / SEGMENT short rows.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - WORDS, F.lit(0)))
    placed = lines.select(_words("line").alias("words")).select("words", F.explode_outer(starts).alias("i"))
    token = F.when(F.size("words") > WORDS, _token(F.col("i"))).otherwise(F.xxhash64("words"))
    bucket = placed.select(_bucket(token).alias("b")).select(F.expr(f"b div {COUNTERS}").cast("int").alias("row"), (F.col("b") % COUNTERS).alias("at"))
    rows = bucket.groupBy("row").agg(*[F.count(F.when(F.col("at") == k, 1)).alias(f"n{k}") for k in range(COUNTERS)])
    each = F.posexplode(F.array(*[f"n{k}" for k in range(COUNTERS)])).alias("at", "count")
    counts = rows.select("row", each).select((F.col("row") * COUNTERS + F.col("at")).alias("b"), "count")
    one = F.concat_ws(":", F.col("b") % SEGMENT, F.floor(F.log2("count")).cast("int"))
    held = counts.where("count > 1").groupBy(F.expr(f"b div {SEGMENT}").alias("part")).agg(F.array_join(F.collect_list(one), ",").alias("text"))
    powers = ["0"] * BUCKETS
    for r in held.collect():
        for at, power in (pair.split(":") for pair in r.text.split(",")):
            powers[r.part * SEGMENT + int(at)] = power
    return F.split(F.lit(",".join(powers)), ",").cast("array<int>")


def _codes(ranks: Column) -> Column:
    """Tokens as longs whose order is rarity first, sorted."""
    code = lambda t: F.shiftleft(F.get(ranks, _bucket(t)).cast("bigint"), _CODE_BITS).bitwiseOR(F.shiftrightunsigned(t, 64 - _CODE_BITS))
    return F.sort_array(F.transform("tokens", code))


def _keyed(lines: DataFrame) -> DataFrame:
    """`lines` with the two hashes of their text that name its class."""
    return lines.withColumns({"k1": F.xxhash64("line"), "k2": F.xxhash64("line", F.lit(1))})


def _behind(n: Column) -> Column:
    """How many of n tokens stand behind the prefix."""
    num, den = THRESHOLD
    return F.floor((num * n + den - 1) / den) - 1


def _candidates(rows: DataFrame) -> DataFrame:
    """Pairs (ka < kb) of classes that may be similar, from the prefixes (k1, n, i, code).

    Similar classes share at least `enough` tokens. Of those, all but the ones behind one of the two prefixes are in both,
    so they meet `enough` - `_behind` times or more, first at their earliest shared tokens. At the j-th of these, no more
    than j - 1 + `left` can be shared: the first has `enough` left, the first SHARED have `enough` - SHARED + 1.
    """
    num, den = THRESHOLD
    a, b = rows.alias("a"), rows.alias("b")
    small, large = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    left = F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i"))
    enough = F.ceil(num * (small + large) / (num + den))
    fits = (F.col("a.k1") < F.col("b.k1")) & (den * small >= num * large) & (left >= enough - (SHARED - 1))
    asked = F.least(F.lit(SHARED), enough - _behind(large)).cast("int")
    met = a.join(b, (F.col("a.code") == F.col("b.code")) & fits).select(F.col("a.k1").alias("ka"), F.col("b.k1").alias("kb"), asked.alias("asked"), (left >= enough).alias("first"))
    pairs = met.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("met"), F.min("asked").alias("asked"), F.bool_or("first").alias("first"))
    return pairs.where("first AND met >= asked").select("ka", "kb")


def similar_later(docs: DataFrame) -> DataFrame:
    """Keys (k1, k2) of the classes of lines that have an earlier similar class."""
    num, den = THRESHOLD
    lines = exploded(docs)
    n = F.size("codes")
    prefix = F.slice("codes", F.lit(1), (n - _behind(n)).cast("int"))
    coded = with_tokens(_keyed(lines)).withColumn("codes", _codes(_ranks(lines))).select("k1", "k2", n.alias("n"), prefix.alias("prefix"))
    rows = coded.groupBy("k1", "k2").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix")).select("k1", "n", F.posexplode_outer("prefix").alias("i", "code"))
    pairs = settled(_candidates(rows), "line-join-pairs")
    sides = pairs.select(F.explode(F.array("ka", "kb")).alias("k1")).distinct()
    wanted = _keyed(lines).where(membership(sides, BITMAP)(F.xxhash64("line"))).join(sides, "k1", "left_semi")
    classes = wanted.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "row", "line_no")).alias("at"), F.first("line").alias("line"))
    met = settled(with_tokens(classes).drop("line"), "line-join-met")
    own = lambda s: met.select(F.col("k1").alias(f"k{s}"), F.struct("k1", "k2").alias(f"key_{s}"), F.col("at").alias(f"at_{s}"), F.col("tokens").alias(f"tokens_{s}"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    alike = den * both >= num * (F.size("tokens_a") + F.size("tokens_b") - both)
    later = F.when(F.col("at_a") > F.col("at_b"), F.col("key_a")).otherwise(F.col("key_b"))
    removed = pairs.join(own("a"), "ka").join(own("b"), "kb").where(alike).select(later.alias("key")).select("key.*").distinct()
    return settled(removed, "line-join-removed")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text, any others) with `text` less its removed lines, and `n_lines` and `n_removed`."""
    row = F.xxhash64("text")
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", row.alias("row"), "text")
    doc_key, row_key, numbers = free_names(docs, "__doc", "__row", "__drops")
    with shuffles_freed(docs.sparkSession):
        keyed = _keyed(exploded(named)).drop("line")
        classes = keyed.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "row", "line_no")).alias("first"))
        gone = classes.join(similar_later(named).withColumn("gone", F.lit(True)), ["k1", "k2"], "left")
        placed = keyed.join(gone, ["k1", "k2"])
        dropped = placed.where(F.col("gone") | (F.col("first") != F.struct("doc_id", "row", "line_no")))
        drops = settled(dropped.groupBy(F.col("doc_id").alias(doc_key), F.col("row").alias(row_key)).agg(F.collect_set("line_no").alias(numbers)), "line-join-drops")
        maybe = F.coalesce(membership(drops.select(row_key), BITMAP)(row), F.lit(False))
    others = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    lines = F.split("text", "\n")
    same = docs.where(~maybe).select(*others, F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.lit(0).alias("n_removed"))
    joined = docs.where(maybe).select(*others).join(drops, (F.col("doc_id") == F.col(doc_key)) & (row == F.col(row_key)), "left")
    kept = F.filter(lines, lambda _, i: ~F.array_contains(numbers, i))
    text = F.when(F.col(numbers).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    counts = [F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.coalesce(F.size(numbers), F.lit(0)).alias("n_removed")]
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in others], *counts).unionByName(same)


def op7_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that repeat or nearly repeat an earlier one."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


_SQL = """
WITH raw AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
), numbered AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM raw
), spoken AS (
  SELECT * FROM numbered WHERE trim(line, ' ') <> ''
), classes AS (
  SELECT line, min(doc_id * 1000000 + line_no) AS place FROM spoken GROUP BY line
), worded AS (
  SELECT line, place, [w FOR w IN string_split(line, ' ') IF w <> ''] AS words FROM classes
), shingled AS (
  SELECT line, place, CASE WHEN len(words) <= 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]) END AS tokens FROM worded
), listed AS (
  SELECT place, len(tokens) AS n, unnest(tokens) AS token FROM shingled
), shared AS (
  SELECT a.place AS first_at, b.place AS later_at, a.n AS na, b.n AS nb, count(*) AS common
  FROM listed a JOIN listed b ON a.token = b.token AND a.place < b.place GROUP BY ALL
), removed AS (
  SELECT DISTINCT later_at FROM shared WHERE 5 * common >= 4 * (na + nb - common)
), judged AS (
  SELECT s.doc_id, s.line_no, c.place = s.doc_id * 1000000 + s.line_no AND c.place NOT IN (SELECT later_at FROM removed) AS stays
  FROM spoken s JOIN classes c USING (line)
), flagged AS (
  SELECT n.doc_id, n.line_no, n.line, coalesce(j.stays, true) AS stays FROM numbered n LEFT JOIN judged j USING (doc_id, line_no)
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (stays), '') AS text, CAST(count(*) AS INT) AS n_lines, CAST(count(*) FILTER (NOT stays) AS INT) AS n_removed
FROM flagged GROUP BY doc_id
"""

QUERIES = {"op7_line_join": op7_line_join}
ORACLE = {"op7_line_join": _SQL}
