"""Benchmark decontamination by SimHash windows, in DataFrame functions only (operator 10).

Words are the parts of the lower-case text between white space, shingles are five of them in a row.

1. A window of an item's size is laid in a document wherever a shingle of the item sits as it does in the
   item. Other windows share no shingle with any item, so their similarity is 0. A fixed bitmap of item
   shingles sorts out most places before anything is joined; its size decides speed only.
2. Windows and items get 64-bit SimHash fingerprints of their words.
3. Fingerprints are cut in RADIUS + 1 blocks. Two within RADIUS bits agree in at least one block, so meeting
   by blocks finds all of them.
4. The exact weighted Jaccard similarity of the shingle counts decides, at THRESHOLD or more.

Defined cases: null texts and documents or items of fewer than five words never match; a window that
would leave the document is cut at its end; rows that share a doc_id are judged together; a null doc_id is never
matched; equal items all match; extra columns are kept; empty tables give no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.shared import settled, table

WORDS = 5
THRESHOLD = (4, 5)
RADIUS = 15
#: Bits of the bitmap of item shingles.
BITMAP = 1 << 18
_BLOCK_BITS = 64 // (RADIUS + 1)
_SPACES = "\n\t\r\f\x0b\xa0  　"


def _hashed(rows: DataFrame) -> DataFrame:
    """`rows` with `h`, the hashes of the words of `text`."""
    plain = F.translate(F.lower("text"), _SPACES, " " * len(_SPACES))
    return rows.withColumn("h", F.transform(F.filter(F.split(plain, " "), lambda w: w != ""), lambda w: F.xxhash64(w)))


def _shingles(words: str, first: Column, count: Column) -> Column:
    """Hashes of `count` shingles from word number `first` on; an empty array for none."""
    at = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)])
    return F.when(count > 0, F.transform(F.sequence(first, first + count - 1), at)).otherwise(F.array().cast("array<bigint>"))


def _fingerprint(words: Column) -> Column:
    """SimHash: each bit is that of most words."""
    ones = lambda b: F.aggregate(words, F.lit(0).cast("bigint"), lambda n, h: n + _bit(h, b))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(F.when(2 * ones(b) > F.size(words), _power(b)).otherwise(F.lit(0).cast("bigint"))))


def _bit(h: Column, b: Column) -> Column:
    return F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1).cast("bigint"))


def _power(b: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), b)


def _items(benchmark: DataFrame) -> DataFrame:
    """Items of at least five words: item_id, size, words and tokens."""
    hashed = _hashed(benchmark.select("item_id", "text").where("text IS NOT NULL"))
    cut = hashed.select("item_id", F.size("h").alias("size"), F.col("h").alias("words"), _shingles("h", F.lit(0), F.size("h") - WORDS + 1).alias("tokens"))
    return settled(cut, "bench-items").where(F.col("size") >= WORDS)


def _bitmap(items: DataFrame) -> Column:
    """An array of longs with a bit set for each item shingle."""
    place = items.select(F.explode("tokens").alias("t")).select(F.pmod("t", F.lit(BITMAP)).cast("int").alias("p"))
    found = place.groupBy(F.shiftright("p", 6).alias("slot")).agg(F.bit_or(_power(F.col("p").bitwiseAND(F.lit(63)))).alias("bits")).collect()
    slots = {r.slot: r.bits for r in found}
    return F.split(F.lit(",".join(str(slots.get(i, 0)) for i in range(BITMAP // 64))), ",").cast("array<bigint>")


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Windows worth comparing: doc_id, row, first word, words and tokens."""
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("row"), "text")
    hashed = _hashed(named)
    tokens = hashed.select("doc_id", "row", F.size("h").alias("n"), _shingles("h", F.lit(0), F.size("h") - WORDS + 1).alias("tokens"))
    bitmap = _bitmap(items)

    def listed(t: Column) -> Column:
        p = F.pmod(t, F.lit(BITMAP)).cast("int")
        return F.call_function("shiftrightunsigned", F.get(bitmap, F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1

    marked = F.filter(F.transform("tokens", lambda t, i: F.when(listed(t), F.struct(t.alias("token"), i.alias("pos")))), lambda s: s.isNotNull())
    # An outer generator: the optimizer would otherwise repeat the computation in a filter on the array's size.
    hits = tokens.select("doc_id", "row", "n", F.explode_outer(marked).alias("hit")).where("hit IS NOT NULL").select("doc_id", "row", "n", "hit.*")
    places = items.select(F.posexplode("tokens").alias("offset", "token"), "size").distinct()
    start = F.col("pos") - F.col("offset")
    laid = hits.join(places, "token").select("doc_id", "row", F.greatest(start, F.lit(0)).alias("start"), F.least(start + F.col("size"), F.col("n")).alias("end")).distinct()
    by_doc = laid.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = _hashed(named.dropDuplicates(["doc_id", "row"]).join(by_doc, ["doc_id", "row"]))
    each = joined.select("doc_id", "row", "h", F.explode_outer("spans").alias("s"))
    size = F.col("s.end") - F.col("s.start")
    return each.select("doc_id", "row", F.col("s.start").alias("start"), F.slice("h", F.col("s.start") + 1, size).alias("words"), _shingles("h", F.col("s.start"), size - WORDS + 1).alias("tokens"))


def _blocks(rows: DataFrame) -> DataFrame:
    """A row for each block of the fingerprint."""
    value = lambda b: F.call_function("shiftrightunsigned", F.col("print"), b * _BLOCK_BITS).bitwiseAND(F.lit(2**_BLOCK_BITS - 1))
    return rows.select("*", F.explode(F.transform(F.sequence(F.lit(0), F.lit(RADIUS)), lambda b: F.struct(b.alias("block"), value(b).alias("value")))).alias("key"))


def _weighted(a: str, b: str) -> tuple[Column, Column]:
    """Sums of the smaller and of the larger count of each shingle."""
    count = lambda tokens, t: F.size(F.filter(tokens, lambda x: x == t))
    shared = F.aggregate(F.array_distinct(a), F.lit(0), lambda n, t: n + F.least(count(a, t), count(b, t)))
    return shared, F.size(a) + F.size(b) - shared


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and an item in it: doc_id, item_id, similarity of the best window, number of windows."""
    items = _items(benchmark)
    windows = settled(_windows(docs, items), "bench-windows").withColumn("print", _fingerprint(F.col("words")))
    window_blocks = _blocks(windows.select("doc_id", "row", "start", "tokens", "print"))
    item_blocks = _blocks(items.select("item_id", F.col("tokens").alias("item_tokens"), _fingerprint(F.col("words")).alias("print")))
    a, b = window_blocks.alias("a"), item_blocks.alias("b")
    near = F.bit_count(F.col("a.print").bitwiseXOR(F.col("b.print"))) <= RADIUS
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & near).select("doc_id", "row", "start", "item_id", "tokens", "item_tokens")
    pairs = met.dropDuplicates(["doc_id", "row", "start", "item_id", "tokens"])
    shared, all_ = _weighted("tokens", "item_tokens")
    num, den = THRESHOLD
    judged = pairs.select("doc_id", "row", "start", "item_id", shared.alias("shared"), all_.alias("all")).where(den * F.col("shared") >= num * F.col("all"))
    return judged.groupBy("doc_id", "item_id").agg(F.max(F.col("shared") / F.col("all")).alias("similarity"), F.count_distinct("row", "start").alias("n_windows"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no item of the benchmark."""
    return docs.join(find_leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def op10_bench_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in any document."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL = """
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\\s\\x{a0}]+'), lambda w: w <> '') AS w FROM documents
), item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\\s\\x{a0}]+'), lambda w: w <> '') AS w FROM benchmark
), doc_shingles AS (
  SELECT doc_id, len(w) AS n, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS token, unnest(range(len(w) - 4)) AS pos
  FROM doc_words WHERE len(w) >= 5
), items AS (
  SELECT item_id, len(w) AS size, [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] AS tokens FROM item_words WHERE len(w) >= 5
), places AS (
  SELECT DISTINCT size, unnest(tokens) AS token, unnest(range(len(tokens))) AS off FROM items
), spans AS (
  SELECT DISTINCT d.doc_id, greatest(d.pos - p.off, 0) AS first, least(d.pos - p.off + p.size, d.n) AS past FROM doc_shingles d JOIN places p USING (token)
), windows AS (
  SELECT s.doc_id, s.first, s.past, [array_to_string(d.w[i:i + 4], ' ') FOR i IN range(s.first + 1, s.past - 3)] AS tokens FROM spans s JOIN doc_words d USING (doc_id)
), window_counts AS (
  SELECT doc_id, first, past, len(tokens) AS total, token, count(*) AS c FROM (SELECT doc_id, first, past, tokens, unnest(tokens) AS token FROM windows) GROUP BY ALL
), item_counts AS (
  SELECT item_id, len(tokens) AS total, token, count(*) AS c FROM (SELECT item_id, tokens, unnest(tokens) AS token FROM items) GROUP BY ALL
), shared AS (
  SELECT w.doc_id, w.first, w.past, i.item_id, w.total + i.total AS totals, sum(least(w.c, i.c)) AS common
  FROM window_counts w JOIN item_counts i USING (token) GROUP BY ALL
)
SELECT doc_id, item_id, CAST(max(CAST(common AS DOUBLE) / CAST(totals - common AS DOUBLE)) AS DOUBLE) AS similarity, count(DISTINCT first) AS n_windows
FROM shared WHERE 5 * common >= 4 * (totals - common) GROUP BY doc_id, item_id
"""

QUERIES = {"op10_bench_simhash": op10_bench_simhash}
ORACLE = {"op10_bench_simhash": _SQL}
