"""Distribution distances against a direct computation, and the edge cases of reports on empty tables."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import dpi, drift, evaluation, ordering, quality, scoring


def direct(a, b):
    """KS, the smallest value where it is reached, and the area between the distribution functions."""
    x = np.unique(np.concatenate([a, b]))
    gap = np.abs(np.searchsorted(np.sort(a), x, "right") / len(a) - np.searchsorted(np.sort(b), x, "right") / len(b))
    return gap.max(), x[np.flatnonzero(np.round(gap, 12) == np.round(gap.max(), 12))[0]], float((gap[:-1] * np.diff(x)).sum())


def test_distances_equal_a_direct_computation(spark):
    rng = np.random.default_rng(1)
    groups = {"same": (rng.normal(size=300), rng.normal(size=200)), "moved": (rng.normal(size=150), rng.normal(0.7, 1, 400)),
              "hot": (np.where(rng.random(500) < 0.5, 0.25, rng.random(500)), np.where(rng.random(300) < 0.9, 0.25, rng.random(300))),
              "apart": (np.array([0.0, 1.0]), np.array([5.0])), "one": (np.array([2.0]), np.array([2.0]))}
    rows = [(g, p, float(v)) for g, (a, b) in groups.items() for p, vs in ((drift.BASE, a), (drift.CUR, b)) for v in vs]
    rows += [("half", drift.CUR, 1.0), ("moved", drift.CUR, None), ("moved", drift.BASE, float("nan")), (None, drift.BASE, 1.0)]
    df = spark.createDataFrame(rows, "g string, period string, v double")
    got = {r.g: r for r in drift.distribution_drift(df, ["g"], "v").collect()}
    assert set(got) == {*groups, "half"}
    for g, (a, b) in groups.items():
        r = got[g]
        ks, at, area = direct(a, b)
        assert (r.n_base, r.n_cur) == (len(a), len(b))
        assert r.ks == pytest.approx(ks) and r.ks_at == pytest.approx(at) and r.wasserstein == pytest.approx(area, abs=1e-12)
        assert r.ks_critical == pytest.approx(1.3581015 * np.sqrt((len(a) + len(b)) / (len(a) * len(b))))
        assert r.shifted == (r.ks > r.ks_critical)
    assert got["moved"].shifted and not got["same"].shifted and got["one"].ks == 0
    assert (got["half"].n_base, got["half"].ks, got["half"].wasserstein, got["half"].shifted) == (0, None, None, None)
    whole = drift.distribution_drift(df.where("g in ('apart', 'one')"), [], "v").collect()
    assert len(whole) == 1 and whole[0].ks == pytest.approx(direct(np.array([0.0, 1, 2]), np.array([5.0, 2]))[0])
    assert drift.distribution_drift(df.limit(0), ["g"], "v").count() == 0


def test_reports_on_empty_tables_count_zero(spark):
    df = spark.createDataFrame([], "sales string, salary string, left_flag int, score double")
    assert [(r.missing_count, r.missing_pct) for r in quality.missing_summary(df).collect()] == [(0, None)] * 4
    assert tuple(quality.cleanup_report(df).first()) == (0, 0, 0, 0, 0, 0)
    curve = evaluation.grid_sweep(df, "score", "left_flag", [0.25, 0.5], inclusive=True).collect()
    assert [(r.tp, r.fp, r.fn, r.tn, r.cost) for r in curve] == [(0, 0, 0, 0, 0.0)] * 2
    assert evaluation.calibration_curve(df, "score", "left_flag", evaluation.quantile_edges(df, "score")).count() == 0


def test_leaderboard_without_hours(spark):
    rows = [("a", 0.1, 0.0, 0.5, 10, 0.0), ("b", 0.2, 0.0, 0.7, 12, 0.1)]
    df = spark.createDataFrame(rows, "sales string, attrition_rate double, average_montly_hours_mean double, satisfaction_level_mean double, "
                                     "headcount long, violation_density double")
    got = {r.sales: r for r in dpi.dpi_leaderboard(df).collect()}
    assert got["a"].workload_score == pytest.approx(0.75) and got["b"].workload_score == pytest.approx(0.85)


def test_exactly_one_benchmark_row(spark):
    bench = spark.createDataFrame([("Fused", 1), ("Other", 2), ("other", 3)], "model string, x int")
    assert scoring.pick_model_row(bench, "fused").first().x == 1
    for name in ("other", "none"):
        with pytest.raises(Exception, match="rows for model"):
            scoring.pick_model_row(bench, name).collect()


def test_held_out_thresholds_come_from_training(spark):
    rng = np.random.default_rng(2)
    rows = [("train" if i % 3 else "test", int(y), float(np.clip(y * 0.3 + rng.random() * 0.7, 0, 1)), float(rng.random()))
            for i, y in enumerate(rng.random(600) < 0.3)]
    df = spark.createDataFrame(rows, "split string, y int, a_score double, b_score double")
    got = {(r.part, r.model_variant): r for r in evaluation.benchmark_heldout(df, ["a_score", "b_score"], "y", "b_score").collect()}
    alone = {r.model_variant: r for r in evaluation.benchmark_enhanced(df.where(F.col("split") == "train"), ["a_score", "b_score"], "y", "b_score").collect()}
    for m in ("a_score", "b_score"):
        assert got["train", m].threshold == got["test", m].threshold == alone[m].threshold
        assert got["train", m].total_cost == alone[m].total_cost
        tau = alone[m].threshold
        s = [(y, a if m == "a_score" else b) for p, y, a, b in rows if p == "test"]
        assert got["test", m].total_cost == 10 * sum(y == 1 and not x > tau for y, x in s) + sum(y == 0 and x > tau for y, x in s)
    assert got["test", "b_score"].cost_reduction_pct == 0


def test_sketches_merge_within_their_rank_error(spark):
    """Quantiles of merged daily sketches; a new day is a merge of one more."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.lognormal(size=60_000), np.full(20_000, 1.0)])
    df = spark.createDataFrame([(int(i % 7), float(v)) for i, v in enumerate(x)] + [(0, None), (1, float("nan"))], "day int, v double")
    days = ordering.quantile_sketches(df, ["day"], "v").cache()
    probs, error = [0.01, 0.25, 0.5, 0.9, 0.999], ordering.rank_error()
    for upto in (6, 7):
        part = np.sort(x[np.arange(len(x)) % 7 < upto])
        whole = ordering.merged_sketches(days.where(F.col("day") < upto), [])
        assert whole.first().n == len(part) and len(whole.first().sketch) < 100_000
        for p, v in zip(probs, ordering.sketch_quantiles(whole, [], probs).first().q):
            under, to = np.searchsorted(part, v, "left") / len(part), np.searchsorted(part, v, "right") / len(part)
            assert under - error <= p <= to + error
