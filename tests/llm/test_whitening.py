import math

import numpy as np
import pytest
from tidewatch.llm import queries
from tidewatch.llm import whitening as W


def brute(rows, k=4):
    """By id: (x, deviation); and the fit's n, eigenvalues, eigenvectors, mean."""
    whole = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in whole}), float)
    n, mean = len(fit), fit.mean(0)
    v = (fit - mean).T @ (fit - mean) / n
    e, axes = np.linalg.eigh(v)
    sums = [int(s) for s in fit.sum(0)]
    return whole, n, sums, mean, e[::-1][:k], axes[:, ::-1][:, :k], np.trace(v), fit


def check(got, rows, k=4):
    whole, n, sums, mean, e, axes, trace, fit = brute(rows, k)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert len(got) == k * len(whole)
    signs = None
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-9
    for i, x in whole:
        mine = sorted(by[i], key=lambda r: r.component)[:k] if len(by[i]) == k else sorted({r.component: r for r in by[i]}.values(), key=lambda r: r.component)
        assert [r.component for r in mine] == list(range(1, k + 1))
        assert {r.n for r in mine} == {n}
        assert {r.deviation for r in mine} == {sum((n * a - s) ** 2 for a, s in zip(x, sums))}
        w = np.array([r.whitened for r in mine])
        want = (np.array(x) - mean) @ axes / np.sqrt(e)
        if signs is None and (np.abs(want) > 1e-3).all():
            signs = np.sign(w * want)
        if signs is not None:
            np.testing.assert_allclose(w, want * signs, atol=1e-8)
        np.testing.assert_allclose([r.explained for r in mine], e / trace, rtol=1e-9)
    assert signs is not None


def vectors(rng, n, d, scale=None):
    x = rng.normal(size=(n, d)) * (np.linspace(2, 0.3, d) if scale is None else scale)
    return [[float(c) for c in r] for r in x]


def test_query_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = list(enumerate(vectors(rng, 500, 12)))
    rows += [(1000 + i, rows[3][1]) for i in range(300)]                       # a hot vector
    rows += [(2000, None), (2001, [None] + [1.0] * 11), (2002, [math.nan] * 12), (2003, [math.inf] + [0.0] * 11),
             (2004, [0.0] * 12), (2005, [-0.0] * 12), (3, rows[4][1])]
    spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, n long, component string").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    rows = [(i, v and [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    got = queries.op13_whitening(spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    assert {r.vec_id for r in got}.isdisjoint({2000, 2001, 2002, 2003})
    check([r for r in got if r.vec_id != 3], [r for r in rows if r[0] != 3] + [])
    assert sum(r.vec_id == 3 for r in got) == 8                               # rows that repeat an id


def test_ill_conditioned_vectors(spark):
    rng = np.random.default_rng(2)
    rows = list(enumerate(vectors(rng, 400, 5, [1e9, 1e6, 1e2, 3.0, 1.0])))
    got = W.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.identity_error < 1e-9 for r in got} == {True}
    assert {r.component for r in got} == {1, 2, 3, 4}


def test_shifted_factor_of_nearly_dependent_rows():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(2000, 8)))
    v, _ = np.linalg.qr(rng.normal(size=(8, 8)))
    s = np.logspace(0, -9, 8)                                                 # condition 1e9: its square is beyond a double
    x = q * s @ v.T
    passes = []

    def gram_of(factors):
        passes.append(len(factors))
        y = W.solved(x, factors)
        return y.T @ y

    r, rank = W.factored(gram_of, 8, 2000)
    assert rank == 8 and 3 <= len(passes) <= W.MOST_PASSES
    np.testing.assert_allclose(np.linalg.svd(r)[1], s, rtol=1e-6)
    values, axes, _ = W.components(r, 2000)
    assert abs(abs(axes[:, 6] @ v[:, 6]) - 1) < 1e-6                           # small directions keep their axes


def test_directions_without_variance(spark):
    rng = np.random.default_rng(4)
    a = rng.integers(-500, 500, (300, 2)) / 256
    flat = [[float(p), float(q), float(2 * p), 1.5, float(p + q), 0.0] for p, q in a]
    got = W.whitened(spark.createDataFrame(list(enumerate(flat)), "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1, 2} and {r.identity_error < 1e-9 for r in got} == {True}
    assert abs(sum(r.explained for r in got if r.vec_id == 0) - 1) < 1e-9
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert W.whitened(same).count() == 0
    assert W.whitened(same.limit(0)).count() == 0
    assert W.whitened(same.selectExpr("vec_id", "cast(null as array<double>) embedding")).count() == 0
    assert W.whitened(same.selectExpr("vec_id", "cast(array() as array<double>) embedding")).count() == 0


def test_short_vectors_huge_entries_and_other_names(spark):
    rows = [(str(i), [float(i), float(i * i % 7), 0.5 * (i % 3)]) for i in range(50)] + [("short", [1.0]), ("huge", [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "name string, `v.x` array<double>")
    got = W.whitened(df, id="name", vector="v.x", components_=2).collect()
    assert {r.name for r in got} == {r[0] for r in rows} - {"short"} and len(got) == 2 * 51
    assert {r.deviation for r in got if r.name == "huge"} == {None}
    near = [r for r in got if r.name == "7"][0]
    x = [[min(math.floor(256 * c), 1 << 53) for c in v] for _, v in rows if len(v) == 3]
    fit = {tuple(v) for v in x}
    sums = [sum(c) for c in zip(*fit)]
    exact = sum((len(fit) * a - s) ** 2 for a, s in zip([7 * 256, 0, 128], sums))
    assert near.deviation == (exact if exact < 1 << 63 else None)


@pytest.mark.parametrize("parts", [1, 40])
def test_tree_of_sums(spark, parts):
    rng = np.random.default_rng(5)
    x = rng.integers(-(1 << 53), 1 << 53, (500, 3))
    df = spark.createDataFrame([(r,) for r in x.tolist()], "x array<long>").repartition(parts)
    total = W.summed(df, lambda b: (b >> 32).sum(0).astype(object) * (1 << 32) + (b & 0xFFFFFFFF).sum(0).astype(object), (3,), whole=True)
    assert total.tolist() == [sum(c) for c in zip(*x.tolist())]
    np.testing.assert_allclose(W.summed(df, lambda b: b.astype(float).T @ b, (3, 3)), x.astype(float).T @ x, rtol=1e-12)
