"""Held-out accuracy of the quality classifier, its parts against plain versions, and edge cases."""

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from valuekit.llm import kernel_quality as kq
from valuekit.llm.shared import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in kq.op3_kernel_quality(spark, sf).collect()}
    assert len(got) == table(spark, sf, "documents").count()
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    for key, r in got.items():
        assert r.held_out == (zlib.crc32(str(key).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    tested = [(got[k].predicted, q) for k, q in labels.items() if got[k].held_out]
    assert np.mean([p == q for p, q in tested]) >= 0.95
    assert all(p == 1 for p, q in tested if q == 1)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 9)), min_size=1, max_size=12))
def test_isotonic_is_the_min_max_formula(points):
    values, counts = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    mean = lambda a, b: np.average(values[a:b], weights=counts[a:b])
    n = len(points)
    expected = [max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]
    assert np.allclose(kq.isotonic(values, counts), expected)


def test_equations_are_those_of_all_rows(spark):
    picks = np.random.default_rng(4)
    x = picks.random((300, len(kq.FEATURES)))
    y = (x[:, 3] > 0.5).astype(int)
    frame = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "features array<double>, label int").repartition(5)
    model = kq.fit_quality(frame)
    z = kq.fourier((x - x.mean(axis=0)) / x.std(axis=0))
    penalty = kq.RIDGE * len(x) * np.eye(kq.FOURIER + 1)
    penalty[-1, -1] = 0
    direct = np.linalg.solve(z.T @ z + penalty + 1e-9 * np.eye(kq.FOURIER + 1), z.T @ y)
    assert np.allclose(z @ direct, model.raw(x), atol=1e-6)


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (2, "word " * 50_000, None), (None, "x", "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (9, 0, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    got = kq.score_quality(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert [r.score for r in kq.score_quality(docs, labels.limit(0)).collect()] == [0.5] * 4
    assert kq.score_quality(docs.limit(0), labels).count() == 0
