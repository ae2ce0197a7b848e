"""Quality classifier: kernel ridge on random Fourier features, isotonic calibration (operator 3).

Every document becomes a vector of statistics of its whole text (`FEATURES`). Standardised vectors go
through FOURIER random cosines, which approximate a Gaussian kernel. Each task sums the normal equations of
its rows; the sums of all tasks meet row by row of the matrix, so the driver gets one FOURIER x FOURIER
matrix and solves for the ridge weights. Raw scores of the fitted rows, counted in BINS bins, give the
isotonic curve that turns a raw score into a probability. Fitting uses all labelled rows outside the held-out
fold. Labels, doc_id, language and source are no inputs of a score.

Defined cases: null and empty texts have the statistics of an empty text and get a score; labels that are
null, or whose document is missing, are left out of the fit; several labels of one document count each;
repeated documents each get a row; without any label every score is 0.5; extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.shared import map_batches, pa_schema, settled, small_batches, table

FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "digits", "spaces", "prose_marks", "shouts", "odd_marks",
    "other_letters", "distinct_words", "repeated_neighbours", "top_word", "bare_words", "marked_words", "log_line", "distinct_lines", "other_chars",
)
FOURIER = 256
RIDGE = 1e-4
#: Added to the counts that shares are taken of, so that a short text is no outlier.
SMOOTH_CHARS = 40
SMOOTH_WORDS = 6
BINS = 2048
THRESHOLD = 0.7
SEED = 20_240_131
_KINDS = 9  # lower, upper, digit, space, prose mark, shout, odd mark, other letter, anything else


def _kind(code: int) -> int:
    char = chr(code)
    if char.isspace():
        return 3
    if char.isdigit():
        return 2
    if char.isupper():
        return 1
    if char.islower():
        return 0
    if char.isalpha():
        return 7
    if char in ".,;:'\"()-?«»¿¡“”’":
        return 4
    return 5 if char == "!" else 6 if 32 < code < 127 else 8


_TABLE = np.array([_kind(c) for c in range(0x3000)] + [7], dtype=np.uint8)


def text_statistics(text: str | None) -> list[float]:
    """The FEATURES of a text."""
    text = text or ""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.bincount(_TABLE[np.minimum(codes, 0x3000)], minlength=_KINDS).tolist()
    words = text.split()
    counts = Counter(words)
    lines = text.split("\n")
    n, n_words = len(text) + SMOOTH_CHARS, len(words) + SMOOTH_WORDS
    letters = kinds[0] + kinds[1] + kinds[7] + SMOOTH_CHARS
    bare = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    marked = sum(c for w, c in counts.items() if len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum())
    return [
        math.log(n), math.log(n_words), (len(text) - kinds[3]) / n_words, kinds[1] / letters, kinds[2] / n, kinds[3] / n, kinds[4] / n, kinds[5] / n, kinds[6] / n,
        kinds[7] / n, len(counts) / n_words**0.8, sum(map(operator.eq, words, words[1:])) / n_words, max(counts.values(), default=0) / n_words, bare / n_words, marked / n_words,
        math.log(n / len(lines)), len(set(lines)) / len(lines), kinds[8] / n,
    ]


@dataclass(frozen=True)
class QualityModel:
    """A fitted classifier: small arrays only."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # raw scores, ascending
    levels: np.ndarray  # probabilities at them, ascending

    def raw(self, features: np.ndarray) -> np.ndarray:
        return fourier((features - self.mean) / self.scale) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(features), self.edges, self.levels), 0.0, 1.0)


def fourier(rows: np.ndarray) -> np.ndarray:
    """Random cosines of standardised rows and a constant column."""
    picks = np.random.default_rng(SEED)
    n = len(FEATURES)
    waves = picks.standard_normal((n, FOURIER)) / math.sqrt(n)
    shifts = picks.uniform(0, 2 * math.pi, FOURIER)
    bounded = np.clip(rows, -5, 5)
    return np.hstack([math.sqrt(2 / FOURIER) * np.cos(bounded @ waves + shifts), np.ones((len(rows), 1))])


def isotonic(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-decreasing means of neighbouring groups, by pooling adjacent violators."""
    pools: list[list[float]] = []
    for value, count in zip(values, counts):
        pools.append([value, count, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, c, k = pools.pop()
            last = pools[-1]
            pools[-1] = [(last[0] * last[1] + v * c) / (last[1] + c), last[1] + c, last[2] + k]
    return np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


def document_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of `docs`: the columns in `keep` and `features`."""
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep) + "features array<double>"

    def measure(batch: dict[str, list]) -> dict[str, list]:
        return {c: batch[c] for c in keep} | {"features": [text_statistics(t) for t in batch[text]]}

    return map_batches(docs.select(*dict.fromkeys([*keep, text])), measure, schema)


def fit_quality(labelled: DataFrame) -> QualityModel:
    """Fit on rows of `features` and `label` (0 or 1)."""
    small_batches(labelled.sparkSession)
    labelled = labelled.select("features", F.col("label").cast("double").alias("label")).where("label IS NOT NULL")
    n = len(FEATURES)
    measures = [f(F.col("features")[i]) for f in (F.avg, F.stddev_pop) for i in range(n)]
    row = [*labelled.agg(F.count(F.lit(1)), *measures).first()]
    if not row[0]:
        return QualityModel(np.zeros(n), np.ones(n), np.zeros(FOURIER + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    mean, spread = np.array(row[1 : n + 1]), np.array(row[n + 1 :])
    scale = np.where(spread > 1e-9, spread, 1.0)
    sums = "line int, cells array<double>"
    schema = pa_schema(labelled.sparkSession, sums)

    def equations(batches):
        total = np.zeros((FOURIER + 1, FOURIER + 2))
        for batch in batches:
            if batch.num_rows:
                z = fourier((np.array(batch.column("features").to_pylist()) - mean) / scale)
                y = batch.column("label").to_numpy(zero_copy_only=False)
                total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array(range(FOURIER + 1), pa.int32()), pa.array(total.tolist(), schema.field("cells").type)], schema=schema)

    def add(lines: pa.Table) -> pa.Table:
        total = np.zeros(FOURIER + 2)
        for batch in lines.to_batches():
            total += np.array(batch.column("cells").to_pylist()).sum(axis=0)
        return pa.table([lines["line"].slice(0, 1), pa.array([total.tolist()], schema.field("cells").type)], schema=schema)

    summed = labelled.mapInArrow(equations, sums).groupBy("line").applyInArrow(add, sums).collect()
    system = np.array([r.cells for r in sorted(summed, key=lambda r: r.line)])
    gram, right = system[:, :-1], system[:, -1]
    penalty = RIDGE * row[0] * np.eye(FOURIER + 1)
    penalty[-1, -1] = 0
    weights = np.linalg.solve(gram + penalty + 1e-9 * np.eye(FOURIER + 1), right)
    plain = QualityModel(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def count(batch: dict[str, list]) -> dict[str, list]:
        raw = plain.raw(np.array(batch["features"]))
        return {"bin": np.floor((np.clip(raw, -0.5, 1.5) + 0.5) / 2 * (BINS - 1)).astype(int).tolist(), "label": batch["label"]}

    bins = map_batches(labelled, count, "bin int, label double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share")).collect()
    bins.sort(key=lambda r: r.bin)
    edges = (np.array([r.bin for r in bins]) + 0.5) / (BINS - 1) * 2 - 0.5
    return QualityModel(mean, scale, weights, edges, isotonic(np.array([r.share for r in bins]), np.array([r.n for r in bins])))


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, `held_out`, `score` and `predicted` of each row of `docs` (doc_id, text).

    Fits on the labels (doc_id, quality) outside the held-out fold. Statistics are computed once and kept in
    the shared folder, from where both the fit and the scores are read. Columns in `keep` that have the name of a
    result, or are called `features`, are left out.
    """
    keep = tuple(c for c in keep if c.lower() not in ("held_out", "score", "predicted", "features"))
    features = settled(document_statistics(docs, keep=(*keep, "doc_id") if "doc_id" not in keep else keep), "quality-features")
    known = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    model = fit_quality(features.select("doc_id", "features").join(known, "doc_id").select("features", "label"))
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep) + "score double"

    def score(batch: dict[str, list]) -> dict[str, list]:
        return {c: batch[c] for c in keep} | {"score": model.score(np.array(batch["features"])).tolist()}

    scored = map_batches(features, score, schema)
    return scored.select(*keep, held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_kernel_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole document."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op3_kernel_quality": op3_kernel_quality}
ORACLE: dict[str, str] = {}
