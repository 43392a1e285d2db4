import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def integers(vector):
    return tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in vector)


def check(rows, got, counted=False):
    """Result rows against a computation with numpy over the whole table."""
    whole = [(i, integers(v)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({x for _, x in whole}) if not counted else [x for _, x in whole]
    n, sums = len(fit), [sum(d) for d in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(16, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == count * len(whole)
    at = {}
    for r in got:
        at.setdefault(r.component, []).append(r)
    for k in range(count):
        mine = sorted(at[k + 1], key=lambda r: (r.vec_id, r.deviation, abs(r.whitened)))
        want = []
        for i, x in whole:
            off = [n * a - s for a, s in zip(x, sums)]
            want.append((i, sum(o * o for o in off), float(np.array(off) / n @ axes[:, k] / math.sqrt(values[k]))))
        want.sort(key=lambda r: (r[0], r[1], abs(r[2])))
        assert [(r.vec_id, r.deviation, r.n) for r in mine] == [(i, d, n) for i, d, _ in want]
        a, b = np.array([r.whitened for r in mine]), np.array([w for _, _, w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert all(abs(r.explained - values[k] / values.sum()) < 1e-10 and r.identity_error < 1e-9 for r in mine)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    mixed = rng.normal(size=(24, 24)) * np.linspace(0.2, 3, 24)
    vectors = [[float(c) for c in v] for v in rng.normal(size=(300, 24)) @ mixed]
    rows = list(enumerate(vectors))
    rows += [(1000 + k, vectors[k % 3]) for k in range(200)]  # a hot group of equal vectors
    rows += [(2000, None), (2001, [None, *vectors[0][1:]]), (2002, [float("nan"), *vectors[0][1:]]), (2003, [float("inf"), *vectors[0][1:]])]
    return rows + [(2004, [c + 1e-4 for c in vectors[5]]), (7, vectors[8])]


@pytest.mark.parametrize("counted", [False, True])
def test_equals_numpy(spark, rows, counted, monkeypatch):
    monkeypatch.setattr(W, "ROWS", 64)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    df = df.withColumn("digest", F.lit(1)).withColumn("white", F.lit("x")).withColumn("n_rows", F.lit(0)).withColumn("x", F.lit(2))
    check(rows, W.whitened(df, counted=counted).collect(), counted)


def test_few_dimensions_and_vectors(spark):
    make = lambda rows: spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert W.whitened(make([])).collect() == []
    assert W.whitened(make([])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert W.whitened(make([(1, None), (2, [])])).collect() == []
    assert W.whitened(make([(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect() == []
    line = [(1, [0.0, 0.0, 5.0]), (2, [1.0, 2.0, 5.0]), (None, [2.0, 4.0, 5.0])]  # one direction of three
    got = sorted(W.whitened(make(line)).collect(), key=lambda r: r.whitened)
    assert [r.component for r in got] == [1, 1, 1] and {r.vec_id for r in got} == {1, 2, None}
    assert np.allclose([r.whitened for r in got], [-math.sqrt(1.5), 0, math.sqrt(1.5)])
    other = line + [(4, [1.0, 2.0])]  # of another length than most
    assert len(W.whitened(make(other)).collect()) == 3


def test_large_numbers(spark):
    huge = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1e9, 2.0]), (4, [1e9, 2.0])]
    got = W.whitened(spark.createDataFrame([(i, v, 0) for i, v in huge], SCHEMA)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 4} and all(math.isfinite(r.whitened) for r in got)
    off = np.array([[1 << 33, 3], [-(1 << 33), 5]])
    deviations = W._deviations(off + 7, 2, np.array([0, 0]))
    assert deviations.tolist() == [[2 * (x + 7) for x in row] for row in off.tolist()]
    far = W._deviations(np.array([[1 << 40]]), 1 << 30, np.array([5]))
    assert far[0][0] == (1 << 70) - 5
