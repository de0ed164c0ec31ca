"""Threshold sweeps and ranking metrics against brute force on small fixtures."""
import numpy as np
import pytest

from tidewatch.functions import constants as K
from tidewatch.operators import evaluation as ev
from tidewatch.operators.ordering import row_sequence, running_sums


@pytest.fixture(scope="module")
def preds(spark):
    rng = np.random.default_rng(7)
    p = np.round(rng.random(200), 2)           # many ties, some exactly on grid points
    y = (rng.random(200) < p).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    return df, y, p


def brute_curve(y, p, grid, inclusive):
    out = []
    for t in grid:
        yhat = (p >= t) if inclusive else (p > t)
        fn = int(((y == 1) & ~yhat).sum())
        fp = int(((y == 0) & yhat).sum())
        out.append((fn, fp, 10 * fn + fp))
    return out


@pytest.mark.parametrize("grid_fn,inclusive", [(K.grid_101, True), (K.grid_100, False), (K.grid_91, True)])
def test_grid_sweep_matches_brute_force(preds, grid_fn, inclusive):
    df, y, p = preds
    grid = grid_fn()
    curve = ev.grid_sweep(df, "p", "y", grid, inclusive).orderBy("i").collect()
    assert [(r.fn, r.fp, r.cost) for r in curve] == brute_curve(y, p, grid, inclusive)
    best = ev.best_threshold(ev.grid_sweep(df, "p", "y", grid, inclusive)).first()
    costs = [c for _, _, c in brute_curve(y, p, grid, inclusive)]
    assert best.i == int(np.argmin(costs)) and best.cost <= min(costs)


def test_distinct_score_sweep(preds):
    df, y, p = preds
    best = ev.best_distinct_tau(ev.distinct_score_sweep(df, "p", "y", n_buckets=8)).first()
    cands = [(10 * int(((y == 1) & (p < t)).sum()) + int(((y == 0) & (p >= t)).sum()), t) for t in np.unique(p)]
    assert (best.cost, best.tau) == min(cands)


def test_auroc_and_ap(preds):
    df, y, p = preds
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert ev.auroc(df, "p", "y", n_buckets=8).first().auroc == pytest.approx(auc, abs=1e-12)
    ap = 0.0
    for t in np.unique(p)[::-1]:
        sel = p >= t
        ap += ((y == 1) & (p == t)).sum() / (y == 1).sum() * ((y == 1) & sel).sum() / sel.sum()
    assert ev.average_precision(df, "p", "y", n_buckets=8).first().average_precision == pytest.approx(ap, abs=1e-12)


@pytest.mark.parametrize("n_buckets", [None, 1, 8, 64])
def test_any_orderable_key_and_any_bucket_count(spark, n_buckets):
    """NULL, NaN, text, timestamps without zone, and a hot first column: no row is lost or moved."""
    import datetime as dt
    rows = []
    for i in range(1000):
        week = None if i % 10 == 0 else dt.datetime(2020, 1, 6) + dt.timedelta(weeks=i % 7)
        num = None if i % 11 == 0 else float("nan") if i % 13 == 0 else (i * 37 % 101) / 4
        rows.append((i, "hot" if i % 3 else None if i % 2 else f"d{i}", week, num))
    df = spark.createDataFrame(rows, "id long, dept string, week timestamp_ntz, num double").repartition(5)
    rank = lambda v: (0,) if v is None else (2,) if v != v else (1, v)  # noqa: E731  NULL first, NaN last
    for cols in (["dept", "id"], ["week", "id"], ["num", "id"], ["id"]):
        got = {r.id: r.row_id for r in row_sequence(df, cols, n_buckets=n_buckets).collect()}
        names = ["id", "dept", "week", "num"]
        order = sorted(rows, key=lambda r: [rank(r[names.index(c)]) for c in cols])
        assert got == {r[0]: i for i, r in enumerate(order)}


def test_bucket_count_does_not_change_sums(preds):
    df, _, _ = preds
    a = running_sums(df, ["p", "y"], ["y"], n_buckets=1).orderBy("p", "y").collect()
    b = running_sums(df.repartition(7), ["p", "y"], ["y"], n_buckets=16).orderBy("p", "y").collect()
    assert [r.cum_y for r in a] == [r.cum_y for r in b]


def test_rows_without_score_or_label(spark):
    """NULL and NaN scores pass no threshold, NULL labels are left out: every metric agrees."""
    nan = float("nan")
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.2), (1, None), (0, nan), (1, nan), (None, 0.95), (0, None)]
    df = spark.createDataFrame(rows, "y int, p double")
    low = [(y, -1.0 if p is None or p != p else p) for y, p in rows if y is not None]
    y, p = np.array([r[0] for r in low]), np.array([r[1] for r in low])
    for inclusive in (True, False):
        grid = [0.0, 0.2, 0.5, 0.7, 0.95]
        curve = ev.grid_sweep(df, "p", "y", grid, inclusive).orderBy("i").collect()
        assert [(r.fn, r.fp, r.cost) for r in curve] == brute_curve(y, p, grid, inclusive)
        for r in curve:
            c = ev.confusion_counts(df, "p", "y", r.tau, inclusive).first()
            assert (c.tn, c.fp, c.fn, c.tp) == (r.tn, r.fp, r.fn, r.tp)
    sweep = {r.tau: (r.fn, r.fp) for r in ev.distinct_score_sweep(df, "p", "y").collect()}
    assert sweep == {t: b[:2] for t, b in zip(sorted({0.9, 0.8, 0.7, 0.2}), brute_curve(y, p, sorted({0.9, 0.8, 0.7, 0.2}), True))}
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert ev.auroc(df, "p", "y").first().auroc == pytest.approx(auc)
    ap = sum(((y == 1) & (p == t)).sum() / (y == 1).sum() * ((y == 1) & (p >= t)).sum() / (p >= t).sum()
             for t in np.unique(p) if t >= 0)
    assert ev.average_precision(df, "p", "y").first().average_precision == pytest.approx(ap)
    assert sum(r.n for r in ev.calibration_curve(df, "p", "y", [0.5]).collect()) == 4


def test_constant_score_and_all_ties(spark):
    df = spark.createDataFrame([(i % 2, 0.5) for i in range(10)], "y int, p double")
    assert ev.auroc(df, "p", "y").first().auroc == pytest.approx(0.5)
    assert ev.average_precision(df, "p", "y").first().average_precision == pytest.approx(0.5)
    zero = ev.confusion_counts(df, "p", "y", 0.0, inclusive=True).first()
    assert (zero.tn, zero.fp, zero.fn, zero.tp) == (0, 5, 0, 5)


def test_brier_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, p double")
    assert ev.brier_score(df, "p", "y").first().brier is None
