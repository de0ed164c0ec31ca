"""Isotonic fit and its scores against a sequential fit, whatever the ranges and the way of joining."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import isotonic as I


def sequential(x, y):
    """Blocks (lo, hi, value) by pooling one distinct score at a time."""
    out = []
    for v in np.unique(x):
        hit = y[x == v]
        out.append([v, v, int(hit.sum()), len(hit)])
        while len(out) > 1 and out[-2][2] * out[-1][3] >= out[-1][2] * out[-2][3]:
            b = out.pop()
            out[-1] = [out[-1][0], b[1], out[-1][2] + b[2], out[-1][3] + b[3]]
    return out


def rows(spark, x, y):
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "s double, y int")


CASES = {"noisy": lambda r: (np.round(r.random(3000), 3), None), "hot": lambda r: (np.where(r.random(3000) < 0.4, 0.5, r.random(3000)), None),
         "rising": lambda r: (np.arange(400) / 400, (np.arange(400) >= 200).astype(int)),
         "falling": lambda r: (np.arange(400) / 400, (np.arange(400) < 200).astype(int)), "one": lambda r: (np.zeros(5), np.array([1, 0, 1, 1, 0]))}


@pytest.mark.parametrize("case", sorted(CASES))
def test_blocks_equal_a_sequential_fit(spark, case):
    r = np.random.default_rng(4)
    x, y = CASES[case](r)
    y = (r.random(len(x)) < x).astype(int) if y is None else y
    want = sequential(x, y)
    for buckets in (1, 3, 40):
        got = sorted((b.lo, b.hi, round(b.value * b.n), b.n) for b in I.isotonic_fit(rows(spark, x, y), "s", "y", buckets).collect())
        assert got == [tuple(w) for w in want]


def test_scores_interpolate_by_arrays_and_by_join(spark, monkeypatch):
    r = np.random.default_rng(5)
    x = np.round(r.random(1500) * 0.8 + 0.1, 3)
    y = (r.random(1500) < x).astype(int)
    blocks = I.isotonic_fit(rows(spark, x, y), "s", "y")
    want = sequential(x, y)
    px, py = [e for w in want for e in w[:2]], [w[2] / w[3] for w in want for _ in range(2)]
    asked = [0.0, 0.05, 1.0, *np.linspace(0, 1, 301).tolist(), *x[:50].tolist(), None, float("nan")]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(asked)], "i long, s double")
    expected = [None if s is None or s != s else float(np.interp(s, px, py)) for s in asked]
    few = {r.i: r.c for r in I.isotonic_scores(df, "s", blocks, "c").collect()}
    monkeypatch.setattr(I, "FEW_BLOCKS", 0)
    many = {r.i: r.c for r in I.isotonic_scores(df, "s", blocks, "c").collect()}
    ranged = {r.i: r.c for r in I._joined_scores(df, "s", blocks, "c", n_buckets=17).collect()}
    for got in (few, many, ranged):
        assert len(got) == len(asked)
        for i, e in enumerate(expected):
            assert got[i] == (None if e is None else pytest.approx(e, abs=1e-12))


def test_no_rows_no_scores(spark):
    df = rows(spark, [0.1, 0.2], [0, 1])
    none = I.isotonic_fit(df.where("s > 1"), "s", "y")
    assert none.count() == 0
    assert [r.c for r in I.isotonic_scores(df, "s", none, "c").collect()] == [None, None]
    unlabelled = df.withColumn("y", F.lit(None).cast("int")).unionByName(rows(spark, [0.3], [1]))
    assert [(b.lo, b.value) for b in I.isotonic_fit(unlabelled, "s", "y").collect()] == [(0.3, 1.0)]
