"""Phrase collocations from a weighted de Bruijn graph of words (operator 11).

Texts are cut at punctuation and line ends into pieces of words. The graph has an edge for each phrase of LONGEST
words, from the node of its first words to that of its last words, weighted with its occurrences; where a piece ends
before LONGEST words are read, the shorter rest is a piece end. So each occurrence of a word starts one edge or one end,
and only these are counted. Nodes passed by one way only are joined to paths, so that a passage that many documents
share is one row with one weight. The occurrences of a shorter phrase are the flow out of its nodes, the sum of the
edges that begin with it, and the piece ends that begin with it.

Only phrases of `least` occurrences or more count, so most of the graph need not be built. Two first passes add up
phrases in tables of hashed slots (sums stop at `least`, which is all that matters): words and pairs, then the longer
phrases that consist of heavy ones. A phrase in a lighter slot is rarer than that, and so is each that begins with it, so
an edge that reaches it is cut there and becomes an end. A word in no heavy pair starts nothing. Slots that several phrases share only leave a cut out. The
number of slots follows the size of the texts up to 2^MOST_SLOTS; past that more is built and the result is the same.

Tasks merge equal edges before the shuffle, with tables of bounded size; texts are read in windows of words that
overlap, so neither a long text nor a long piece is held as a graph at once. Hot parts of phrases (a word that begins
a tenth of them) are salted in the join that looks up their counts. All arithmetic is on integers and decimals.

Defined cases: null text is empty, null lang is `und`; every row counts, repeated ones too; only A-Z are lower-cased;
ties of a cut go to the shorter first part, ties of the report to UTF-8 order; extra columns are not read; an empty
table, or one without frequent phrases, gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuekit.llm.shared import pa_schema, settled, small_batches, table

LONGEST, LEAST, TOP = 5, 100, 2000
#: Powers of two of the number of slots, and of the slots in one row; bytes of text for each slot.
FEWEST_SLOTS, MOST_SLOTS, ROW_SLOTS, BYTES_A_SLOT = 20, 26, 16, 32
#: Words of a window, distinct words and distinct edges that a task holds: bounds on memory only.
WINDOW, HELD_WORDS, HELD_EDGES = 1_000_000, 1_000_000, 400_000
#: Edges of one row of a path: longer paths take several rows.
PATH_EDGES = 1024

#: A-Z become a-z, piece ends a line feed, tabs a space.
_BYTES = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Stands for a piece end among the words; no UTF-8 text has this byte.
_END = b"\xff"
_EDGES = "lang string, phrase string, words int, n bigint"


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with _END between pieces."""
    return text.translate(_BYTES).replace(b"\n", b" \xff ").split()


class _Words:
    """Numbers of the words of one language in a task, with a hash of each; number 0 is the piece end."""

    def __init__(self, lang: str) -> None:
        self.seed = xxhash.xxh64_intdigest(lang.encode())
        self.number: dict[bytes, int] = {_END: 0}
        self.words: list[bytes] = [_END]
        self._hash = np.zeros(1024, np.uint64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        for word in set(words).difference(self.number):
            k = len(self.words)
            self.number[word] = k
            self.words.append(word)
            if k == len(self._hash):
                self._hash = np.concatenate([self._hash, np.zeros(k, np.uint64)])
            self._hash[k] = xxhash.xxh64_intdigest(word, self.seed)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def slots(self, ids: np.ndarray, power: int) -> list[np.ndarray]:
        """Slots of the phrases of 1, 2, ... LONGEST words that begin at each position; the last positions begin fewer."""
        h = self._hash[ids]
        mixed, out = h, []
        for k in range(LONGEST):
            if k:
                mixed = (mixed[: len(h) - k] * np.uint64(0x9E3779B97F4A7C15) ^ (h[k:] >> np.uint64(7))) * np.uint64(0xD6E8FEB86659FD93)
            out.append((mixed >> np.uint64(64 - power)).astype(np.int64))
        return out


def windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[bytes], int]]:
    """(lang, words, number of them that start something here): the words after those are only looked ahead at.

    Texts of a language follow each other, with piece ends between them. What a window leaves open, at most LONGEST - 1
    words of a piece, comes again at the start of the next one.
    """
    held: dict[str, list[bytes]] = {}

    def full(lang: str, last: bool) -> tuple[str, list[bytes], int]:
        words, ahead = held[lang], 0
        if not last:
            while ahead < LONGEST - 1 and ahead < len(words) and words[-1 - ahead] != _END:
                ahead += 1
        held[lang] = words[len(words) - ahead :]
        return lang, words, len(words) - ahead

    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            start = 0
            while start < len(text):
                # A long text is read in parts that end before a space.
                stop = start + 8 * size
                stop = len(text) if stop >= len(text) else text.find(b" ", stop)
                stop = len(text) if stop < 0 else stop
                held.setdefault(lang, []).extend(words_of(text[start:stop]))
                start = stop
                if len(held[lang]) >= size and start < len(text):
                    yield full(lang, False)
            held.setdefault(lang, []).append(_END)
            if len(held[lang]) >= size:
                yield full(lang, True)
    for lang in held:
        if held[lang]:
            yield full(lang, True)


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))


def slot_power(docs: DataFrame) -> int:
    """Power of two of the number of slots for texts of this size."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    return max(FEWEST_SLOTS, min(MOST_SLOTS, math.ceil(math.log2(size / BYTES_A_SLOT + 1))))


def packed_rows(sums: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(row, bytes) of the rows of a slot table that hold anything.

    Few slots are listed with their sums, many are written as they are, so that the size follows what is held.
    """
    for row, part in enumerate(sums.reshape(-1, min(1 << ROW_SLOTS, len(sums)))):
        used = np.flatnonzero(part)
        if 3 * len(used) < len(part):
            if len(used):
                yield row, b"L" + used.astype("<u2").tobytes() + part[used].tobytes()
        else:
            yield row, b"A" + part.tobytes()


def unpacked_row(data: bytes, width: int) -> np.ndarray:
    """The sums of one row."""
    if data[:1] == b"A":
        return np.frombuffer(data, np.uint8, offset=1)
    out, n = np.zeros(width, np.uint8), (len(data) - 1) // 3
    out[np.frombuffer(data, "<u2", n, 1)] = np.frombuffer(data, np.uint8, n, 1 + 2 * n)
    return out


def heavy_slots(docs: DataFrame, least: int, power: int, shorter: np.ndarray | None = None) -> np.ndarray:
    """Bitmap (packed, 2^power bits) of the slots whose phrases occur `least` times or more together.

    Words and pairs at first; with the bitmap of those as `shorter` the longer phrases that consist of heavy ones, and
    the words of heavy pairs.
    """
    if not 0 < least < 256:
        raise ValueError("least must be from 1 to 255")
    width = min(1 << ROW_SLOTS, 1 << power)
    context = docs.sparkSession.sparkContext
    shipped = None if shorter is None else context.broadcast(shorter.tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << power, np.uint8)
        bits = None if shipped is None else np.frombuffer(shipped.value, np.uint8)
        known: dict[str, _Words] = {}
        for lang, words, starts in windows(batches, WINDOW):
            names = known.setdefault(lang, _Words(lang))
            ids = names.numbers(words)
            slots = names.slots(ids, power)
            if bits is None:
                wanted = [ids > 0, (ids[:-1] > 0) & (ids[1:] > 0)]
                hit = np.concatenate([s[:starts][w[:starts]] for s, w in zip(slots, wanted)])
            else:
                reach = lengths(ids, slots, bits, None)
                # Words in a heavy pair are marked; the others are part of no wanted phrase.
                first = np.flatnonzero(reach > 1)
                sums[slots[0][first]] = sums[slots[0][first + 1]] = least
                hit = np.concatenate([s[:starts][(reach[: len(s)] >= k)[:starts]] for k, s in enumerate(slots[2:], 3)])
            found, n = np.unique(hit, return_counts=True)
            sums[found] = np.minimum(least, n + sums[found])
            if len(names.words) > HELD_WORDS:
                del known[lang]
        for row, data in packed_rows(sums):
            yield pa.RecordBatch.from_pydict({"row": pa.array([row], pa.int32()), "sums": pa.array([data], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = unpacked_row(data, width)
                total[row] = np.minimum(least, total[row].astype(np.uint16) + more).astype(np.uint8) if row in total else more
        made = [(k, np.packbits(v >= least).tobytes()) for k, v in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int32()), pa.array([m[1] for m in made], pa.binary())], ["row", "bits"])

    sums = _texts(docs).mapInArrow(count, "row int, sums binary").repartition("row")
    out = np.zeros(((1 << power) + 7) // 8, np.uint8)
    # 2^power bits in all, 8 MB at most.
    for r in sums.mapInArrow(add, "row int, bits binary").toLocalIterator():
        out[r.row * width // 8 : (r.row + 1) * width // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def _held(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1


def lengths(ids: np.ndarray, slots: list[np.ndarray], short: np.ndarray, long: np.ndarray | None) -> np.ndarray:
    """How many words the longest phrase has that begins at each position and whose beginnings may all be frequent.

    `short` decides words and pairs, `long` the longer ones; without it they are as long as their pairs allow. A word
    that goes on nowhere and is in no heavy pair begins nothing.
    """
    word = (ids > 0) & _held(short, slots[0])
    pair = word[:-1] & word[1:] & _held(short, slots[1])
    reach = word.astype(np.int8)
    goes_on = pair
    for k in range(2, LONGEST + 1):
        if k > 2:
            goes_on = goes_on[: len(ids) - k + 1] & pair[k - 2 :]
            if long is not None:
                goes_on = goes_on & _held(long, slots[k - 1])
        reach[: len(goes_on)] += goes_on
    if long is not None:
        reach[(reach == 1) & ~_held(long, slots[0])] = 0
    return reach


def edges_of(ids: np.ndarray, starts: int, reach: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(columns of word numbers, counts) of the distinct edges and ends of a window, one item for each number of words.

    The first `starts` positions begin one phrase each, of as many words as `reach` says.
    """
    at = np.flatnonzero(reach[:starts])
    code, wide = ids[at], int(ids.max()) + 1
    names = [np.arange(wide)]
    for k in range(1, LONGEST + 1):
        goes_on = reach[at] > k
        done, n = np.unique(code[~goes_on], return_counts=True)
        yield [column[done] for column in names], n
        at, code = at[goes_on], code[goes_on]
        if not len(at):
            return
        # Exact names of the phrases that are one word longer: their number among (phrase, next word).
        both, code = np.unique(code * wide + ids[at + k], return_inverse=True)
        names = [*(column[both // wide] for column in names), both % wide]


def graph_edges(docs: DataFrame, short: np.ndarray, long: np.ndarray, power: int) -> DataFrame:
    """(lang, phrase, words, n): edges, piece ends, and with 0 words the number of all words of a language."""
    spark = docs.sparkSession
    out = pa_schema(spark, _EDGES)
    shipped = spark.sparkContext.broadcast((short.tobytes(), long.tobytes()))
    held = HELD_EDGES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = [np.frombuffer(b, np.uint8) for b in shipped.value]
        known: dict[str, _Words] = {}
        sums: dict[str, Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, found in sums.items():
                texts = [b" ".join(k) for k in found]
                made = [pa.array([lang] * len(found), pa.string()), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*made, pa.array([len(k) for k in found], pa.int32()), pa.array(found.values(), pa.int64())], schema=out)
            sums.clear()

        for lang, words, starts in windows(batches, WINDOW):
            names = known.setdefault(lang, _Words(lang))
            ids = names.numbers(words)
            reach = lengths(ids, names.slots(ids, power), *heavy)
            found = sums.setdefault(lang, Counter())
            found[()] += int((ids[:starts] > 0).sum())
            text = names.words
            for columns, n in edges_of(ids, starts, reach):
                for *phrase, m in zip(*(c.tolist() for c in columns), n.tolist()):
                    found[tuple([text[i] for i in phrase])] += m
            if sum(map(len, sums.values())) > held:
                yield from rows()
            if len(names.words) > HELD_WORDS:
                del known[lang]
        yield from rows()

    return _texts(docs).mapInArrow(count, _EDGES).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def _words_of(phrase: str, k: Column | int) -> Column:
    """The first k words of a phrase, or the last -k."""
    return F.call_function("substring_index", F.col(phrase), F.lit(" "), k if isinstance(k, Column) else F.lit(k))


def unary_paths(edges: DataFrame, piece: int = PATH_EDGES) -> DataFrame:
    """(lang, path, n): paths over nodes that have one way in, one way out and no piece that starts or ends there.

    `edges` has id (distinct), lang, phrase of `words` words, n; those of LONGEST words are edges, those of LONGEST - 1
    ends at a node. Every edge is in one path. Heads are found by doubling: after k rounds a pointer has passed 2^k edges.
    """
    whole = edges.where(F.col("words") == LONGEST)
    source, target = _words_of("phrase", LONGEST - 1), _words_of("phrase", 1 - LONGEST)
    out = whole.groupBy("lang", source.alias("node")).agg(F.count(F.lit(1)).alias("ways"), F.min("id").alias("next"), F.sum("n").alias("flow"))
    into = whole.groupBy("lang", target.alias("node")).agg(F.count(F.lit(1)).alias("ways_in"), F.min("id").alias("id"), F.sum("n").alias("flow_in"))
    ends = edges.where(F.col("words") == LONGEST - 1).select("lang", F.col("phrase").alias("node"))
    # Equal flows and no piece end: no piece starts there either.
    passed = out.where("ways = 1").join(into.where("ways_in = 1"), ["lang", "node"]).where("flow = flow_in AND id <> next")
    passed = passed.join(ends, ["lang", "node"], "left_anti")
    links = settled(passed.select(F.col("next").alias("id"), F.col("id").alias("head"), F.lit(1).cast("bigint").alias("steps")), "phrase-links")
    while True:
        earlier = links.select(F.col("id").alias("head"), F.col("head").alias("farther"), F.col("steps").alias("more"))
        moved = settled(
            links.join(earlier, "head", "left").select("id", F.coalesce("farther", "head").alias("head"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("farther").isNotNull().alias("moved")),
            "phrase-links",
        )
        links = moved.select("id", "head", "steps")
        if moved.where("moved").isEmpty():
            break
    placed = whole.join(links, "id", "left").select("lang", "phrase", "n", F.coalesce("head", "id").alias("head"), F.coalesce("steps", F.lit(0)).alias("steps"))
    step = F.struct("steps", _words_of("phrase", -1).alias("word"), F.when(F.col("steps") % piece == 0, F.col("phrase")).alias("begin"))
    parts = placed.groupBy("lang", "head", F.floor(F.col("steps") / piece).alias("part")).agg(F.array_sort(F.collect_list(step)).alias("steps"), F.first("n").alias("n"))
    path = F.concat(F.get("steps", F.lit(0))["begin"], F.array_join(F.transform(F.slice("steps", 2, piece), lambda s: F.concat(F.lit(" "), s["word"])), ""))
    return parts.select("lang", path.alias("path"), "n")


def phrase_counts(paths: DataFrame, ends: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, f): phrases of 1 to LONGEST words with `least` occurrences or more that were built.

    Flow out of each node, from the edges of the paths, and what ends there.
    """
    words = F.split("path", " ")
    edges = paths.select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size(words) - LONGEST + 1), lambda i: F.slice(words, i, LONGEST))).alias("edge"))
    begun = edges.unionByName(ends.select("lang", "n", F.split("phrase", " ").alias("edge")))
    prefixes = F.explode(F.transform(F.sequence(F.lit(1), F.size("edge")), lambda k: F.struct(k.alias("words"), F.array_join(F.slice("edge", F.lit(1), k), " ").alias("phrase")))).alias("p")
    flows = begun.select("lang", "n", prefixes).groupBy("lang", "p.phrase", "p.words").agg(F.sum("n").alias("f"))
    return flows.where(F.col("f") >= least).select("lang", "phrase", "words", "f")


def collocations(counts: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first `top` phrases. `totals` has lang and n."""
    several = counts.where("words > 1")
    longer = several.where("words > 2")
    inner = [_words_of("phrase", F.col("words") - 1), _words_of("phrase", 1 - F.col("words"))]
    # A phrase inside a longer one is also inside one that is one word longer, which is at least as frequent.
    around = longer.select("lang", F.explode(F.array(*inner)).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    candidates = several.join(around, ["lang", "phrase"], "left").where("around IS NULL OR around < f")
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), F.col("words"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    # Words and pairs may be part of very many phrases, so they are looked up in copies.
    copies = F.when(F.col("words") == 1, 32).when(F.col("words") == 2, 8).otherwise(1)
    known = counts.select("lang", F.col("phrase").alias("part"), "f", F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"))

    def look_up(rows: DataFrame, part: Column, size: Column, name: str) -> DataFrame:
        spread = F.pmod(F.xxhash64("phrase"), F.when(size == 1, 32).when(size == 2, 8).otherwise(1)).cast("int")
        return rows.withColumn("part", part).withColumn("salt", spread).join(known.withColumnRenamed("f", name), ["lang", "part", "salt"]).drop("part", "salt")

    k, rest = F.col("k"), F.col("words") - F.col("k")
    split = look_up(cut, _words_of("phrase", k), k, "l")
    split = look_up(split, _words_of("phrase", -rest), rest, "r")
    priced = split.join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    score = F.call_function("div", (wide["a"] * wide["n"]).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)"), wide["l"] * wide["r"])
    lowest = priced.select("lang", "phrase", "a", "n", F.struct(score.cast("bigint").alias("score"), "k", "l", "r").alias("cut"))
    scored = lowest.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The first `top` of each share of the phrases, then of those: no task sees all phrases of a language.
    shares = F.pmod(F.xxhash64("phrase"), F.lit(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    flat = scored.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r", shares.alias("share"))
    some = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine_phrases(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The `top` collocations of each language among phrases of 2 to LONGEST words with `least` occurrences."""
    power = slot_power(docs)
    short = heavy_slots(docs, least, power)
    edges = graph_edges(docs, short, heavy_slots(docs, least, power, short), power)
    edges = settled(edges.withColumn("id", F.monotonically_increasing_id()), "phrase-edges")
    paths = settled(unary_paths(edges), "phrase-paths")
    ends = edges.where((F.col("words") > 0) & (F.col("words") < LONGEST))
    counts = settled(phrase_counts(paths, ends, least), "phrase-counts")
    return collocations(counts, edges.where("words = 0").select("lang", "n"), top)


def op11_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of all documents."""
    return mine_phrases(table(spark, sf_dir, "documents"))


_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
), counts AS (
  SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY lang, phrase, k HAVING count(*) >= 100
), candidates AS (
  SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w FROM counts WHERE k > 1
), kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates d WHERE d.lang = c.lang AND d.k > c.k AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.f >= 100 * c.f)
), cuts AS (
  SELECT lang, phrase, f AS a, unnest(range(1, k)) AS cut, w FROM kept
), scored AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, n, ((1000 * c.a::HUGEINT * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ') JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

QUERIES = {"op11_phrase_graph": op11_phrase_graph}
ORACLE = {"op11_phrase_graph": _SQL}
