"""Jaccard join of documents on word shingles with Bayesian candidate pruning (operator 8).

1. A document is the set of its five-word shingles (lower case, white space parts words; up to five words make
   one shingle). Documents with equal shingle lists form a class; only classes are compared.
2. A class gets HASHES MinHash values. BANDS bands of ROWS values bring classes together: a pair at the
   threshold misses all bands with a chance of 5e-5.
3. Pairs in a band compare short forms of their values, 32, then 64, then 128 of them. After each step the pair
   is dropped if the posterior probability (uniform prior) that it reaches THRESHOLD is below TOLERANCE. A
   pair counts in its first common band only. This happens in the join condition, so no dropped pair is a row.
4. What is left is verified exactly on the shingle hashes.

`near_duplicates` gives each document the smallest doc_id it is connected with as class_id and the
number of other documents at or above the threshold. Copies are counted through their class.

Defined cases: null texts count as empty; all texts without words are equal; a null doc_id takes part and is
never a class_id unless its class has no other; repeated rows count as documents of their own; extra columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.line_join import with_tokens
from valuekit.llm.shared import free_names, pa_schema, settled, small_batches, table

THRESHOLD = (4, 5)
HASHES = 128
BANDS = 25
ROWS = 5
TOLERANCE = 1e-6
#: Values compared before each pruning decision.
STEPS = (32, 64, 128)
#: Bits of the short form of a MinHash value; unequal values agree in it with a chance of 2 ** -BITS.
BITS = 4
SEED = 77_003
_SPACES = "\n\t\r\f\x0b\xa0  　"


def shingled(docs: DataFrame) -> DataFrame:
    """`docs` (text, others) with `tokens`, the distinct shingle hashes, and their two hashes k1 and k2."""
    plain = F.translate(F.lower(F.coalesce("text", F.lit(""))), _SPACES, " " * len(_SPACES))
    return with_tokens(docs.withColumn("text", plain), "text").withColumns({"k1": F.xxhash64("tokens"), "k2": F.xxhash64("tokens", F.lit(1))})


def signatures(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values, one row a document: tokens of all documents and where each begins."""
    picks = np.random.default_rng(SEED)
    factors = picks.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = picks.integers(0, 2**63, HASHES, dtype=np.uint64)
    values = tokens.view(np.uint64)
    return np.stack([np.minimum.reduceat((values ^ m) * f, starts) for f, m in zip(factors, masks)], axis=1)


def short_forms(values: np.ndarray) -> np.ndarray:
    """BITS bits of each value, 16 values packed in a long."""
    mixed = (values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    packed = mixed.reshape(len(values), -1, 64 // BITS) << np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(packed, axis=2).view(np.int64)


def band_keys(values: np.ndarray) -> np.ndarray:
    """One long for each band."""
    odd = np.random.default_rng(SEED + 1).integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    bands = values[:, : BANDS * ROWS].reshape(len(values), BANDS, ROWS)
    summed = ((bands ^ (bands >> np.uint64(29))) * odd).sum(axis=2, dtype=np.uint64)
    return (summed ^ (summed >> np.uint64(32))).view(np.int64)


def fewest_matches(n: int) -> int:
    """Matches among n short forms below which the posterior of reaching THRESHOLD is under TOLERANCE."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    equal = grid + (1 - grid) / 2**BITS
    high = grid >= THRESHOLD[0] / THRESHOLD[1]
    for m in range(n + 1):
        log = m * np.log(equal) + (n - m) * np.log1p(-equal)
        weight = np.exp(log - log.max())
        if weight[high].sum() / weight.sum() >= TOLERANCE:
            return m
    return n


def _signed(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, row (a hash of the text), k1, k2, short forms and band keys."""
    small_batches(docs.sparkSession)
    ddl = "doc_id bigint, row bigint, k1 bigint, k2 bigint, short array<bigint>, bands array<bigint>"
    schema = pa_schema(docs.sparkSession, ddl)

    def sign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("tokens")
            starts = lists.offsets.to_numpy()
            tokens = lists.values.to_numpy(zero_copy_only=False)[starts[0] : starts[-1]]
            values = signatures(tokens, (starts[:-1] - starts[0]).astype(np.int64))
            columns = [batch.column(c) for c in ("doc_id", "row", "k1", "k2")]
            columns += [pa.array(list(x), type=f.type) for x, f in zip((short_forms(values), band_keys(values)), list(schema)[4:])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return shingled(docs.select("doc_id", "text", F.xxhash64("text").alias("row"))).select("doc_id", "row", "k1", "k2", "tokens").mapInArrow(sign, ddl)


def _equal_forms(a: Column, b: Column) -> Column:
    """How many of the 16 short forms in two longs differ not."""
    x = a.bitwiseXOR(b)
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    return 16 - F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))


def _candidates(classes: DataFrame) -> DataFrame:
    """Pairs (a < b) of nodes that survive the pruning, each once."""
    thin = classes.select("node", F.posexplode("bands").alias("band", "key"))
    # Most keys have one class. Only the others are worth the short forms, which are many bytes a row.
    met = thin.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "key")
    forms = classes.select("node", "short", F.transform("bands", lambda b: F.shiftright(b, 32).cast("int")).alias("low"))
    rows = thin.join(met, ["band", "key"], "left_semi").join(forms, "node")
    a, b = rows.alias("a"), rows.alias("b")
    equal = [_equal_forms(F.get("a.short", F.lit(i)), F.get("b.short", F.lit(i))) for i in range(HASHES * BITS // 64)]
    enough = [reduce(Column.__add__, equal[: n * BITS // 64]) >= fewest_matches(n) for n in STEPS]
    before = F.slice(F.zip_with("a.low", "b.low", lambda x, y: x == y), F.lit(1), F.col("a.band"))
    fits = reduce(Column.__and__, [F.col("a.node") < F.col("b.node"), *enough, ~F.array_contains(before, True)])
    return a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.key") == F.col("b.key")) & fits).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def similar_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, row, k1, k2), classes (node, k1, k2, copies, doc_id) and links (a, b) between classes."""
    signed = settled(_signed(docs), "ngram-signed")
    own = signed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id"), F.first("short").alias("short"), F.first("bands").alias("bands"))
    classes = settled(own.withColumn("node", F.monotonically_increasing_id()), "ngram-classes")
    pairs = settled(_candidates(classes), "ngram-pairs")
    sides = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = classes.join(sides, "node", "left_semi").select("node", F.col("doc_id").alias("w_id"), F.col("k1").alias("w1"), F.col("k2").alias("w2"))
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")))
    # Not a filter: the optimizer would move it below the tokens and compute them there once more.
    own_tokens = F.when((F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")), F.col("tokens"))
    sets = shingled(texts).groupBy("node").agg(F.first(own_tokens, ignorenulls=True).alias("tokens"))
    num, den = THRESHOLD
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    alike = den * both >= num * (F.size("tokens_a") + F.size("tokens_b") - both)
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b")), "b")
    links = settled(joined.where(alike).select("a", "b"), "ngram-links")
    return signed.select("doc_id", "row", "k1", "k2"), classes.select("node", "k1", "k2", "copies", "doc_id"), links


def components(links: DataFrame) -> DataFrame:
    """Connected components: node and label, the smallest node reached. Labels halve their way by jumping."""
    edges = settled(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other"), "ngram-edges")
    labels = settled(edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "ngram-labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        jump = lower.select(F.col("node").alias("to"), F.col("to").alias("further"))
        moved = settled(lower.join(jump, "to").select("node", F.least("to", "further").alias("label"), "was"), "ngram-labels")
        labels = moved.select("node", "label")
        if moved.where("label <> was").isEmpty():
            return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and n_links of every row of `docs` (doc_id, text)."""
    members, classes, links = similar_classes(docs)
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    copies = classes.select(F.col("node").alias("other"), "copies")
    degree = ends.join(copies, "other").groupBy("node").agg(F.sum("copies").alias("linked"))
    labelled = classes.join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    full = labelled.join(least, "label").join(degree, "node", "left")
    info = full.select("k1", "k2", "class_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    return members.join(info, ["k1", "k2"]).select("doc_id", "class_id", "n_links")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of `docs` of each group: that of the smallest doc_id, rows without one last, then by the hash of the text.

    Of rows that share doc_id and text any one stays.
    """
    members, classes, links = similar_classes(docs)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    labels = classes.join(components(links), "node", "left").select("k1", "k2", F.coalesce("label", "node").alias("label"))
    ends = members.groupBy("k1", "k2").agg(F.min(place).alias("first")).join(labels, ["k1", "k2"])
    least = ends.groupBy("label").agg(F.min("first").alias("first"))
    firsts = ends.select("k1", "k2", "label").join(least, "label").select("k1", "k2", "first")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))
    judged = members.join(firsts, ["k1", "k2"]).groupBy("doc_id", "row").agg(F.max(kept).alias("kept"), F.count(F.lit(1)).alias("n"))
    doc_key, row_key, row = free_names(docs, "__doc", "__hash", "__row")
    judged = settled(judged.select(F.col("doc_id").alias(doc_key), F.col("row").alias(row_key), "kept", "n"), "ngram-kept")
    tagged = docs.withColumn(row, F.xxhash64("text"))
    met = F.col("doc_id").eqNullSafe(F.col(doc_key)) & (F.col(row) == F.col(row_key))
    once = tagged.join(judged.where("NOT kept OR n > 1").select(doc_key, row_key), met, "left_anti").drop(row)
    repeated = judged.where("kept AND n > 1").select(doc_key, row_key)
    if repeated.isEmpty():  # a second shuffle of all texts only where it is needed
        return once
    return once.union(tagged.join(repeated, met, "left_semi").dropDuplicates(["doc_id", row]).drop(row))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\s\\x{a0}]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) <= 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words
), listed AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM listed a JOIN listed b ON a.token = b.token AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id AS root, doc_id AS node FROM documents
  UNION
  SELECT r.root, l.b FROM reached r JOIN links l ON l.a = r.node
), classes AS (
  SELECT root AS doc_id, min(node) AS class_id FROM reached GROUP BY root
)
SELECT c.doc_id, c.class_id, count(l.b) AS n_links FROM classes c LEFT JOIN links l ON l.a = c.doc_id GROUP BY c.doc_id, c.class_id
"""

QUERIES = {"op8_ngram_join": op8_ngram_join}
ORACLE = {"op8_ngram_join": _SQL}
