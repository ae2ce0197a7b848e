"""URL filters by gradient-boosted trees on lexical features (operator 13).

A url is judged by the rule that fits, and where none does by trees that learned from labelled urls. Rules have a
host and a start of the path; a rule fits its host and all subdomains, the longest one wins. Urls with a rule are the
labelled ones: the trees (`pyspark.ml`) learn block or allow from what the text of a url shows, which is the
length of url, host, path and query, depth and labels, shares of digits, letters and marks, entropy of the characters,
numbers of parameters, and statistics of the suffix (the last label and the last two of the host): how many labelled
urls have it, and which share of them is blocked. A url that is learned from gets the shares from the other half of
the labelled ones, so it does not see its own label.

All expressions are built-in functions, so scoring is one narrow stage: a url is read, judged and written in one pass.
Trees and suffix statistics are fitted on all labelled urls, unless a caller asks for fewer; all urls are judged. The
statistics are broadcast up to HELD_SUFFIXES rows and joined beyond that.

Defined cases: a null url and one without `://` have an empty host and path and are judged by the trees like any
other; a host is taken as written, with port and user; repeated urls get the same verdict; where all labelled urls
have one label, or there are none, all others get that label, or `allow`; extra columns are left out; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.shared import settled, table

BLOCK, ALLOW = "block", "allow"


class Rule(NamedTuple):
    """A rule of the configuration: what to do with urls of a host and its subdomains below a path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)
#: The most suffixes whose statistics are broadcast.
HELD_SUFFIXES = 100_000
TREES, DEPTH, STEP, SEED = 20, 4, 0.2, 1301
#: Labelled urls that a suffix counts as having besides its own, half of them blocked.
PRIOR = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MARKS = "-._~/?#&=%+:"
FEATURES = (
    *("url_chars", "host_chars", "path_chars", "query_chars", "depth", "labels", "digit_share", "upper_share", "mark_share"),
    *("host_digit_share", "host_hyphens", "entropy", "parameters", "parameter_chars", "has_fragment", "secure"),
    *("top_n", "top_share", "site_n", "site_share"),
)


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty for null and without `://`."""
    rest = F.expr(f"IF(instr(`{url}`, '://') > 0, substring(`{url}`, instr(`{url}`, '://') + 3), '')")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The text of the longest rule that fits, else null. Rules are configuration: each is a branch of the expression."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        below = (host == rule.host) | host.endswith("." + rule.host)
        found = F.when(below & path.startswith(rule.path), F.lit(rule.text)).otherwise(found)
    return found


def _less(column: str, character: str) -> Column:
    """How many times one character is in a string column."""
    return F.length(column) - F.length(F.translate(column, character, ""))


def entropy(column: str) -> Column:
    """Entropy in bits of the characters of a lower-cased string, all but letters, digits and common marks as one."""
    known = _LOWER + "0123456789" + _MARKS
    size = F.greatest(F.length(column), F.lit(1)).cast("double")
    other = F.length(F.translate(column, known, ""))
    total = F.lit(0.0)
    for n in (*[_less(column, c) for c in known], other):
        total = total + F.when(n > 0, n * F.log2(n / size)).otherwise(0.0)
    return -total / size


def lexical(pages: DataFrame, key: Sequence[str]) -> DataFrame:
    """`key` columns, url, host, path and the features that the text alone gives."""
    host, path = host_and_path("url")
    parts = pages.select(*key, F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    tail = F.regexp_extract("url", r"\?([^#]*)", 1)
    parts = parts.withColumn("__query", tail).withColumn("__low", F.lower("url")).withColumn("__site", F.substring_index("host", ".", -2))
    parts = parts.withColumn("__top", F.substring_index("host", ".", -1))
    size = F.greatest(F.length("url"), F.lit(1))
    digits = {c: F.length(c) - F.length(F.translate(c, "0123456789", "")) for c in ("url", "host")}
    made = {
        "url_chars": F.length("url"),
        "host_chars": F.length("host"),
        "path_chars": F.length("path"),
        "query_chars": F.length("__query"),
        "depth": F.size(F.array_remove(F.split("path", "/"), "")),
        "labels": F.size(F.split("host", r"\.")),
        "digit_share": digits["url"] / size,
        "upper_share": (F.length("url") - F.length(F.translate("url", _UPPER, ""))) / size,
        "mark_share": (F.length("url") - F.length(F.translate("url", _MARKS, ""))) / size,
        "host_digit_share": digits["host"] / F.greatest(F.length("host"), F.lit(1)),
        "host_hyphens": _less("host", "-"),
        "entropy": entropy("__low"),
        "parameters": F.size(F.array_remove(F.split("__query", "&"), "")),
        "parameter_chars": F.length("__query") / F.greatest(F.size(F.array_remove(F.split("__query", "&"), "")), F.lit(1)),
        "has_fragment": F.col("url").contains("#"),
        "secure": F.col("url").startswith("https://"),
    }
    return parts.select(*key, "url", "host", "path", "__top", "__site", *[c.cast("double").alias(n) for n, c in made.items()])


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(level, suffix, n0, b0, n1, b1): labelled and blocked urls of each suffix, by half."""
    levels = F.explode(F.create_map(F.lit("top"), F.col("__top"), F.lit("site"), F.col("__site"))).alias("level", "suffix")
    counts = [c for h in (0, 1) for c in (F.count(F.when(F.col("__half") == h, 1)).alias(f"n{h}"), F.sum(F.when(F.col("__half") == h, F.col("label")).otherwise(0)).alias(f"b{h}"))]
    return labelled.select("__half", "label", levels).groupBy("level", "suffix").agg(*counts)


def with_suffixes(rows: DataFrame, counts: DataFrame, own_half: Column | None) -> DataFrame:
    """Adds number and blocked share of both suffixes; of the other half only where `own_half` is given."""
    held = counts.count() <= HELD_SUFFIXES
    for level in ("top", "site"):
        n0, b0, n1, b1 = (F.coalesce(f"__{c}", F.lit(0)) for c in ("n0", "b0", "n1", "b1"))
        part = counts.where(F.col("level") == level).select(F.col("suffix").alias(f"__{level}"), *[F.col(c).alias(f"__{c}") for c in ("n0", "b0", "n1", "b1")])
        joined = rows.join(F.broadcast(part) if held else part, f"__{level}", "left")
        # Half of the labelled urls stand for all of them while learning, so their number counts twice.
        n = n0 + n1 if own_half is None else F.when(own_half == 0, n1).otherwise(n0) * 2
        b = b0 + b1 if own_half is None else F.when(own_half == 0, b1).otherwise(b0) * 2
        rows = joined.withColumn(f"{level}_n", F.log1p(n.cast("double"))).withColumn(f"{level}_share", (b + PRIOR / 2) / (n + PRIOR)).drop("__n0", "__b0", "__n1", "__b1")
    return rows


class UrlModel(NamedTuple):
    """What was learned: suffix counts and trees, or one label for all where there was nothing to tell apart."""

    counts: DataFrame | None
    trees: object | None
    only: str


def fit_urls(labelled: DataFrame, fit_rows: int | None = None) -> UrlModel:
    """Trees from rows of (url, label), label 1 for block and 0 for allow: all of them, or about `fit_rows` by a hash of the url."""
    seen = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked")).first()
    blocked = int(seen.blocked or 0)
    if blocked in (0, seen.n):
        return UrlModel(None, None, BLOCK if blocked else ALLOW)
    every = 1 if fit_rows is None else -(-seen.n // fit_rows)
    number = F.xxhash64("url")
    picked = labelled.where(F.pmod(number, F.lit(every)) == 0).withColumn("__half", F.pmod(F.shiftright(number, 20), F.lit(2)))
    # Written once, so that all passes of the fit see the same rows in the same order.
    rows = settled(lexical(picked, ("label", "__half")), "url-fit")
    counts = settled(suffix_counts(rows), "url-suffixes")
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_suffixes(rows, counts, F.col("__half")))
    if ready.select("label").distinct().count() < 2:
        return UrlModel(None, None, BLOCK if blocked * 2 > seen.n else ALLOW)
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED)
    return UrlModel(counts, trees.fit(ready.select("label", "features")), "")


def judge_urls(pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = RULES, key: str = "page_id") -> DataFrame:
    """`key`, host, path, rule, verdict and score (what the trees give for block) of every row."""
    rows = lexical(pages.select(key, "url"), (key,))
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(float(model.only == BLOCK)))
    else:
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(with_suffixes(rows, model.counts, None))
        trees = model.trees.copy({model.trees.featuresCol: "__features", model.trees.probabilityCol: "__p", model.trees.rawPredictionCol: "__r", model.trees.predictionCol: "__l"})
        scored = trees.transform(ready).withColumn("score", F.get(vector_to_array("__p"), 1))
    ruled = scored.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW)
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.text, rule.verdict).otherwise(verdict)
    return ruled.select(key, "host", "path", "rule", verdict.alias("verdict"), "score")


def labelled_by_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(url, label) of the urls that a rule decides."""
    host, path = host_and_path("url")
    ruled = pages.select("url", rule_of(host, path, rules).alias("rule")).where("rule IS NOT NULL")
    blocked = F.col("rule").isin([r.text for r in rules if r.verdict == BLOCK])
    return ruled.select("url", blocked.cast("double").alias("label"))


def op13_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all pages, learned from the pages that a rule decides."""
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, fit_urls(labelled_by_rules(pages)))


QUERIES = {"op13_url_trees": op13_url_trees}
ORACLE: dict[str, str] = {}
