"""Source divergence audit with count-level bitmaps (operator 12).

How far the words of one source lie from those of another of the same language. A term has p = 1 + floor(10^9 *
(count + 2) / (N + 2 V)) in a group, and two values differ by f = floor((p - q)^2 / (p + q)).

Tasks count the terms of their documents by (lang, source) and hand on sums. Terms of a language in fewer than
MIN_DOCS documents go. The rest are dealt into blocks of terms with similar totals, where a term is one bit, and a
source has one bitset for each count that its terms in the block have. Sources are compared by these bitsets: AND
and the number of bits give the number of terms with count c here and d there, which is multiplied by f(c, d). Terms
that one side lacks are never listed: the value of a pair is
    V f(0,0) + sum over c of n(c) (f(c,0) - f(0,0)) + the same of the other side
    + sum over cells of n(c,d) (f(c,d) - f(c,0) - f(0,d) + f(0,0)),
so what a cell counts comes off the terms with a zero. Rare terms have few counts, so a block of them is few bitsets;
frequent ones nearly all differ, so their blocks are small. All of it is integer arithmetic; shares are divided as
decimals, since 10^9 * count can pass 64 bits.

Defined cases: null text, lang and source count as ''; rows that share a doc_id are documents of their own; a group
without terms is compared like any other; a language without kept terms has value 0 in its pairs; ties of a value go
by UTF-8 bytes; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuekit.llm.shared import pa_schema, settled, small_batches, table
from valuekit.operators.ranks import pinned

#: Documents of its language that a term must be in, and ranks of the `term` part.
MIN_DOCS = 10
TOP_TERMS = 10
#: Entries of a task's table of counts before it is handed on: a bound on memory only.
HELD_TERMS = 400_000
#: Terms of a block: by the power of two of their total.
BLOCK_TERMS, FREQUENT_BLOCK_TERMS, FREQUENT_POWER = 512, 64, 8
#: Pairs of bitsets compared at once in a task.
CELLS_AT_ONCE = 2_000_000
#: Parts that a small table of groups is dealt to, where a join has few keys.
SALTS = 16

#: A-Z become a-z, other ASCII characters that are no letters become spaces, bytes of longer characters stay.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text."""
    return text.translate(_BYTES).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, and a row with a null term per group for its documents."""
    small_batches(docs.sparkSession)
    out = pa_schema(docs.sparkSession, _COUNTS)
    held = HELD_TERMS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], list] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs_of, total) in groups.items():
                terms = list(n)
                made = [pa.array([lang] * (len(terms) + 1)), pa.array([source] * (len(terms) + 1))]
                made += [pa.array([*terms, None], pa.binary()).cast(pa.string()), pa.array([*n.values(), 0], pa.int64())]
                yield pa.RecordBatch.from_arrays([*made, pa.array([*(docs_of[t] for t in terms), total], pa.int64())], schema=out)
            groups.clear()

        for batch in batches:
            for text, lang, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
                group = groups.setdefault((lang, source), [Counter(), Counter(), 0])
                terms = terms_of(text)
                group[0].update(terms)
                group[1].update(set(terms))
                group[2] += 1
            if sum(len(g[0]) for g in groups.values()) > held:
                yield from rows()
        yield from rows()

    blank = F.lit("")
    named = docs.select(F.coalesce("text", blank).cast("binary").alias("text"), F.coalesce("lang", blank).alias("lang"), F.coalesce("source", blank).alias("source"))
    parts = named.mapInArrow(count, _COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Counts of the kept terms: also `total` of the language, and `lead` in one row of each term."""
    of_term = Window.partitionBy("lang", "term")
    known = term_counts(docs).select(
        "lang",
        "source",
        "term",
        "n",
        F.sum("docs").over(of_term).alias("docs"),
        F.sum("n").over(of_term).alias("total"),
        (F.col("source") == F.min("source").over(of_term)).alias("lead"),
    )
    return known.where(F.col("term").isNull() | (F.col("docs") >= min_docs)).drop("docs")


def groups_of(counts: DataFrame) -> DataFrame:
    """One row per (lang, source): its sum, the language's sum and number of terms, and p of a missing term."""
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_all"), F.count(F.when(F.col("term").isNotNull() & F.col("lead"), 1)).alias("leads"))
    of_lang = Window.partitionBy("lang")
    full = sums.select("lang", "source", "n_all", F.sum("n_all").over(of_lang).alias("lang_all"), F.sum("leads").over(of_lang).alias("v"))
    return full.withColumn("p_none", share(F.lit(0), "n_all"))


def share(count: Column, n_all: str) -> Column:
    """p of a count in a group; null where the language has no terms."""
    wide = (count.cast("decimal(19,0)") + F.lit(2)) * F.lit(1_000_000_000).cast("decimal(10,0)")
    under = F.col(n_all).cast("decimal(19,0)") + F.lit(2) * F.col("v").cast("decimal(18,0)")
    return F.when(F.col("v") > 0, F.lit(1) + F.call_function("div", wide.cast("decimal(31,0)"), under.cast("decimal(21,0)"))).cast("bigint")


def distance(p: Column, q: Column) -> Column:
    """f of two shares; both are at most 10^9 + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def level_bitsets(counts: DataFrame) -> DataFrame:
    """One row per block, source, count and 64 terms: `bits` of the terms that have this count."""
    terms = counts.where("term IS NOT NULL").withColumn("power", F.floor(F.log2("total")).cast("int"))
    per_block = F.when(F.col("power") < FREQUENT_POWER, BLOCK_TERMS).otherwise(FREQUENT_BLOCK_TERMS)
    # At most 64 powers a language, so one small row for each.
    sizes = terms.where("lead").groupBy("lang", "power").agg(F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias("blocks"))
    dealt = terms.join(pinned(sizes), ["lang", "power"]).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    place = F.dense_rank().over(Window.partitionBy("lang", "power", "block").orderBy("term")) - 1
    spots = dealt.select("lang", "power", "block", "source", "n", place.alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("place", F.lit(64)))
    return spots.groupBy("lang", "power", "block", "source", "n", F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def joint_cells(source: np.ndarray, p: np.ndarray, p_none: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, value) of the cells of each pair of sources with a < b; one row per bitset (source, count) of a block."""
    strip = max(1, CELLS_AT_ONCE // max(1, len(source)))
    for start in range(0, len(source), strip):
        rows = slice(start, start + strip)
        cells = np.zeros((len(source[rows]), len(source)), np.int64)
        for word in range(bits.shape[1]):
            cells += np.bitwise_count(bits[rows, word, None] & bits[None, :, word])
        cells[source[rows, None] >= source[None, :]] = 0
        i, j = np.nonzero(cells)
        n, i = cells[i, j], i + start
        gain = _f(p[i], p[j]) - _f(p[i], p_none[j]) - _f(p_none[i], p[j]) + _f(p_none[i], p_none[j])
        yield source[i], source[j], n * gain


def cell_sums(levels: DataFrame) -> DataFrame:
    """(lang, a, b, value): what the cells of each pair of sources add, by block. `levels` has p and p_none."""
    schema = "lang string, a string, b string, value bigint"
    out = pa_schema(levels.sparkSession, schema)

    def compare(block: pa.Table) -> pa.Table:
        names, source = np.unique(np.array(block["source"].to_pylist(), dtype=object), return_inverse=True)
        word, n = (block[c].to_numpy() for c in ("word", "n"))
        # One row per (source, count), one column per 64 terms.
        keys, row = np.unique(np.stack([source, n], 1), axis=0, return_inverse=True)
        bits = np.zeros((len(keys), int(word.max()) + 1), np.uint64)
        bits[row, word] = block["bits"].to_numpy().view(np.uint64)
        p, p_none = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        p[row], p_none[row] = block["p"].to_numpy(), block["p_none"].to_numpy()
        sums: Counter = Counter()
        for a, b, value in joint_cells(keys[:, 0], p, p_none, bits):
            pairs, at = np.unique(a * len(names) + b, return_inverse=True)
            added = np.zeros(len(pairs), np.int64)
            np.add.at(added, at, value)
            sums.update(dict(zip(pairs.tolist(), added.tolist())))
        lang = block["lang"][0].as_py()
        rows = [(lang, names[k // len(names)], names[k % len(names)], v) for k, v in sums.items()]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(out)], schema=out)

    return levels.groupBy("lang", "power", "block").applyInArrow(compare, schema)


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language."""
    shares = groups.select("lang", "source", "n_all", "v", "p_none")
    levels = level_bitsets(counts).join(shares, ["lang", "source"]).withColumn("p", share(F.col("n"), "n_all"))
    levels = settled(levels.select("lang", "power", "block", "source", "n", "word", "bits", "p", "p_none"), "source-levels")
    cells = cell_sums(levels)
    # Terms by count, whatever the other side has: n(c) of each source, against p_none of each other source.
    counted = levels.groupBy("lang", "source", "n").agg(F.sum(F.bit_count("bits")).alias("terms"), F.first("p").alias("p"), F.first("p_none").alias("own_none"))
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("source", "n"), F.lit(SALTS)).cast("int"))
    others = groups.select("lang", F.col("source").alias("item"), "p_none", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = salted.join(others, ["lang", "salt"]).where("source <> item")
    zeros = met.groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * (distance(F.col("p"), F.col("p_none")) - distance(F.col("own_none"), F.col("p_none")))).alias("value"))
    left = groups.select("lang", "source", "v", F.col("p_none").alias("own_none"))
    every = left.join(groups.select("lang", F.col("source").alias("item"), "p_none"), "lang").where("source <> item")
    base = every.select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * distance(F.col("own_none"), F.col("p_none"))).otherwise(0).alias("value"))
    # A side without a term adds the same to both directions of a pair, and so does a cell.
    halves = zeros.unionByName(cells.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"))
    directions = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    both = halves.select("lang", F.explode(directions).alias("d"), "value").select("lang", "d.source", "d.item", "value")
    whole = base.unionByName(both)
    return whole.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))


def term_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every kept term that a source has more often than its language."""
    shares = groups.select("lang", "source", "n_all", "lang_all", "v")
    known = counts.where("term IS NOT NULL AND n > 0").join(shares, ["lang", "source"])
    priced = known.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), "n_all").alias("p"), share(F.col("total"), "lang_all").alias("q"))
    return priced.where("p > q").select("lang", "source", "item", distance(F.col("p"), F.col("q")).alias("value"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of sources, and the first terms of each source."""
    counts = settled(kept_counts(docs, min_docs), "source-counts")
    groups = pinned(groups_of(counts))
    ranks = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(counts, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranks.alias("rank"))
    terms = term_values(counts, groups).select("lang", "source", F.lit("term").alias("part"), "item", "value", ranks.alias("rank"))
    return pairs.unionByName(terms.where(F.col("rank") <= top_terms))


def op12_source_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources of all languages of the documents."""
    return divergence(table(spark, sf_dir, "documents"))


_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), vocabulary AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS lang_all FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), sums AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n_all FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n,
    1 + (1000000000 * (coalesce(n, 0)::HUGEINT + 2)) // (n_all + 2 * v) AS p, 1 + (1000000000 * (total::HUGEINT + 2)) // (lang_all + 2 * v) AS q
  FROM sums s JOIN kept k USING (lang) JOIN vocabulary USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
), terms AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT FROM terms
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 10
"""

QUERIES = {"op12_source_bitmaps": op12_source_bitmaps}
ORACLE = {"op12_source_bitmaps": _SQL}
