"""Second-order trees: one split by hand, plain boosting in numpy, order of rows, several models, odd tables."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import boosting, models
from tidewatch.session import scratch_path

WHOLE = dict(subsample=1.0, columns=1.0)


def frame(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 6 + 0.5 * (x[:, 1] > 4) * x[:, 2])))).astype(int)
    w = rng.integers(1, 4, n).astype(float)
    rows = [(i, *map(float, r), int(t), float(v)) for i, (r, t, v) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, "i int, a double, b double, c double, y int, w double"), x, y, w


def plain(x, y, w, rounds, depth, step, l2, min_hessian):
    """Margins of plain boosting with every distinct value as an edge, by recursion over row sets."""
    margin = np.zeros(len(y))

    def grow(rows, left):
        p = 1 / (1 + np.exp(-margin[rows]))
        g, h = (p - y[rows]) * w[rows], p * (1 - p) * w[rows]
        best = (1e-6, None)
        if left:
            for f in range(x.shape[1]):
                for v in np.unique(x[:, f])[:-1]:
                    to_left = x[rows, f] <= v
                    gl, hl, gr, hr = g[to_left].sum(), h[to_left].sum(), g[~to_left].sum(), h[~to_left].sum()
                    if min(hl, hr) >= min_hessian:
                        gain = gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - g.sum() ** 2 / (h.sum() + l2)
                        best = max(best, (gain, (f, v)), key=lambda b: b[0])
        if best[1] is None:
            return [(rows, -step * g.sum() / (h.sum() + l2))]
        f, v = best[1]
        return grow(rows[x[rows, f] <= v], left - 1) + grow(rows[x[rows, f] > v], left - 1)

    for _ in range(rounds):
        for rows, value in grow(np.arange(len(y)), depth):
            margin = margin + np.where(np.isin(np.arange(len(y)), rows), value, 0)
    return margin


def test_one_split_by_hand(spark):
    """At margin 0: g = w (1/2 - y), h = w / 4.  Left of 1: w 2, y 0; right: w 3 and 1, y 1."""
    df = spark.createDataFrame([(1.0, 0, 2.0), (2.0, 1, 3.0), (2.0, 1, 1.0)], "x double, y int, w double")
    f = boosting.fit(df, ["x"], "y", {"m": F.col("w")}, rounds=1, depth=1, step=0.5, l2=1.0, min_hessian=0.0, **WHOLE)
    assert f.feature[0, 0].tolist() == [0, -1, -1] and f.threshold[0, 0, 0] == 1.0
    left, right = -0.5 * 1.0 / (0.5 + 1), -0.5 * -2.0 / (1.0 + 1)
    assert f.value[0, 0, 1:].tolist() == pytest.approx([left, right])
    none = boosting.fit(df, ["x"], "y", {"m": F.col("w")}, rounds=1, depth=1, step=0.5, l2=1.0, min_hessian=0.6, **WHOLE)
    assert none.feature.max() == -1 and none.value[0, 0, 0] == pytest.approx(-0.5 * -1.0 / (1.5 + 1))


@pytest.mark.parametrize("l2,min_hessian", [(1.0, 1.0), (5.0, 0.1)])
def test_equal_to_plain_boosting(spark, l2, min_hessian):
    df, x, y, w = frame(spark)
    f = boosting.fit(df, ["a", "b", "c"], "y", {"m": F.col("w")}, rounds=23, depth=3, step=0.3, l2=l2, min_hessian=min_hessian,
                     bins=256, **WHOLE)
    want = 1 / (1 + np.exp(-plain(x, y, w, 23, 3, 0.3, l2, min_hessian)))
    got = [r.p for r in f.score(df, "p").orderBy("i").collect()]
    assert np.abs(np.array(got) - want).max() < 1e-4


def test_partitions_order_and_the_tree_of_sums(spark, monkeypatch):
    df, *_ = frame(spark)
    kw = dict(rounds=5, depth=3, **WHOLE)
    a = boosting.fit(df, ["a", "b", "c"], "y", **kw)
    monkeypatch.setattr(boosting, "MIN_TASK_ROWS", 1)
    monkeypatch.setattr(boosting, "FAN_IN", 3)
    b = boosting.fit(df.orderBy(F.desc("i")).repartition(11), ["a", "b", "c"], "y", **kw)
    assert np.array_equal(a.feature, b.feature) and np.array_equal(a.value, b.value)


def test_models_side_by_side_equal_each_alone(spark):
    df, *_ = frame(spark)
    weights = {"all": F.lit(1.0), "some": F.when(F.col("i") % 3 != 0, F.col("w"))}
    kw = dict(rounds=4, depth=2, **WHOLE)
    both = boosting.fit(df, ["a", "b"], "y", weights, **kw)
    for m, (name, w) in enumerate(weights.items()):
        alone = boosting.fit(df.where(w.isNotNull()), ["a", "b"], "y", {name: w}, bins=64, **kw)
        assert np.array_equal(both.feature[m], alone.feature[0]) and np.allclose(both.value[m], alone.value[0])


def test_samples_are_repeatable_and_of_their_share():
    ids = np.arange(100_000)
    a, b = boosting._sampled(ids, 5, 0.9), boosting._sampled(ids, 6, 0.9)
    assert np.array_equal(a, boosting._sampled(ids, 5, 0.9)) and abs(a.mean() - 0.9) < 0.01
    assert abs((a & b).mean() - 0.81) < 0.01 and boosting._sampled(ids, 5, 1.0).all()


def test_odd_tables_and_bundle(spark):
    schema = "_id int, _w string, x double, z double, y int"
    odd = spark.createDataFrame([(1, "a", None, 1.0, 1), (2, None, float("nan"), None, 0), (3, "a", 5.0, 2.0, 1), (4, "b", 5.0, 2.0, None)]
                                * 20, schema)
    f = boosting.fit(odd, ["x", "z"], "y", rounds=3, depth=2)
    out = f.score(odd, "p")
    assert out.columns == [*odd.columns, "p"] and out.count() == 80 and out.where("p > 0 and p < 1").count() == 80
    path = scratch_path(spark, "forest")
    f.save(spark, path)
    again = boosting.Forest.load(spark, path)
    assert again.names == f.names and again.columns == f.columns and np.array_equal(again.value, f.value)
    p = [[r.p for r in scored.orderBy("_id").collect()] for scored in (again.score(odd, "p"), out)]
    assert p[0] == p[1]
    for rows, p in ((odd.limit(0), 0.5), (odd.where("y = 1"), None)):
        g = boosting.fit(rows, ["x", "z"], "y", rounds=3, depth=2)
        got = {r.p for r in g.score(odd, "p").collect()}
        assert len(got) == 1 and (p is None or got == {p})
    assert f.score(odd.limit(0), "p").count() == 0


def test_held_out_precision_not_below_first_order_trees(spark):
    df, *_ = frame(spark, 6000, 8)
    train, test = df.where("i % 3 != 0"), df.where("i % 3 = 0")
    cols = ["a", "b", "c"]

    def precision(scored):
        r = scored.toPandas().sort_values("p", ascending=False, kind="stable")
        hits = r.y.to_numpy().cumsum()
        return (hits / np.arange(1, len(r) + 1) * r.y.to_numpy()).sum() / r.y.sum()

    ours = precision(boosting.fit(train, cols, "y", rounds=30, step=0.1).score(test, "p"))
    theirs = precision(models.score(models.fit_gbt(train, cols, "y", rounds=30, step=0.1), test, cols, "p"))
    assert ours > theirs - 0.005


def test_calibration_by_groups_with_models_beside(spark):
    """Every row is scored, also rows and groups outside the training part, a null group and extra columns."""
    df, *_ = frame(spark)
    df = df.withColumn("g", F.when(F.col("i") % 9 != 0, F.concat(F.lit("g"), F.col("i") % 9)))
    got = models.calibrated_gbt_scores(df, ["a", "b", "c"], "y", "i", folds=2, rounds=3, train=F.col("i") < 300, group="g",
                                       beside={"whole": F.when(F.col("i") < 300, 1.0)})
    rows = got.collect()
    assert sorted(r.i for r in rows) == list(range(400)) and got.columns == ["i", "calibrated_score", "cross_fitted_score", "whole"]
    assert all(0 <= v <= 1 for r in rows for v in r[1:])
    assert len({round(r.whole, 9) for r in rows}) > 2


def test_margins_sisters_and_joint_histograms_change_nothing(spark, monkeypatch):
    """Trees are the same however often margins are kept or made anew and whichever features share a histogram."""
    df, *_ = frame(spark)
    weights = {"all": F.lit(1.0), "some": F.when(F.col("i") % 3 != 0, F.col("w"))}
    kw = dict(rounds=13, depth=3, step=0.3)
    a = boosting.fit(df, ["a", "b", "c"], "y", weights, **kw)
    for name, v in (("ADVANCE_EVERY", 2), ("RESTART_EVERY", 6), ("JOINT_CELLS", 1), ("CHUNK_ROWS", 50)):
        monkeypatch.setattr(boosting, name, v)
    b = boosting.fit(df, ["a", "b", "c"], "y", weights, **kw)
    assert np.array_equal(a.feature, b.feature) and np.array_equal(a.threshold, b.threshold) and np.allclose(a.value, b.value)
    assert (a.feature[:, -1, 3:7] >= 0).any()                              # the last tree is grown to its depth
    monkeypatch.setattr(boosting, "JOINT_CELLS", 24)
    assert boosting._joint([2, 12, 3, 2, 40]) == [[4], [1, 0], [2, 3]]


def test_scores_follow_each_row_down_its_trees(spark):
    df, x, *_ = frame(spark, 200)
    f = boosting.fit(df, ["a", "b", "c"], "y", {"m": F.col("w"), "n": F.lit(1.0)}, rounds=6, depth=4, min_hessian=8.0)
    want = np.zeros((2, len(x)))
    for m in range(2):
        for t in range(6):
            for i, row in enumerate(x):
                node = 0
                while f.feature[m, t, node] >= 0:
                    node = 2 * node + 1 + int(row[f.feature[m, t, node]] > f.threshold[m, t, node])
                want[m, i] += f.value[m, t, node]
    got = np.array([r.p for r in df.withColumn("p", f.scores()).orderBy("i").collect()]).T
    assert np.allclose(got, 1 / (1 + np.exp(-want)), rtol=0, atol=1e-12) and (f.feature == -1).any()


def test_all_rounds_run_in_a_few_jobs(spark, monkeypatch):
    """The number of Spark jobs does not follow the number of rounds and levels (F1 to F12: one job a level)."""
    df, *_ = frame(spark)
    monkeypatch.setattr(boosting, "MIN_TASK_ROWS", 1)
    spark.sparkContext.setJobGroup("few jobs", "boosting")
    try:
        f = boosting.fit(df, ["a", "b", "c"], "y", rounds=60, depth=3)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (f.feature[0, :, 0] >= 0).all()                                 # every round has its tree
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("few jobs")) <= 20


def test_mapped_rows_and_sums_taken_down_early_change_nothing(spark, monkeypatch):
    df, *_ = frame(spark)
    weights = {"all": F.lit(1.0), "some": F.when(F.col("i") % 3 != 0, F.col("w"))}
    kw = dict(rounds=9, depth=3)
    a = boosting.fit(df, ["a", "b", "c"], "y", weights, **kw)
    for name, v in (("HELD_BYTES", 1), ("CHUNK_ROWS", 50), ("MIN_TASK_ROWS", 1), ("FAN_IN", 2)):
        monkeypatch.setattr(boosting, name, v)
    b = boosting.fit(df, ["a", "b", "c"], "y", weights, **kw)
    assert np.array_equal(a.feature, b.feature) and np.array_equal(a.threshold, b.threshold) and np.array_equal(a.value, b.value)


def test_large_weights_are_counted_whole(spark, monkeypatch):
    """Units beyond 32 bits, and sums beyond 53 bits over the chunks of a task."""
    df, x, y, w = frame(spark)
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 50)
    big = 2.0 ** 26
    f = boosting.fit(df.repartition(16), ["a", "b", "c"], "y", {"m": F.col("w") * big}, rounds=7, depth=3, step=0.3, l2=big, min_hessian=big,
                     bins=256, **WHOLE)
    want = 1 / (1 + np.exp(-plain(x, y, w * big, 7, 3, 0.3, big, big)))
    got = [r.p for r in f.score(df, "p").orderBy("i").collect()]
    assert np.abs(np.array(got) - want).max() < 1e-4


def test_edges_above_which_no_value_lies_are_left_out(spark):
    df = spark.createDataFrame([(float(i % 2), float(i), 1.0, None) for i in range(100)], "a double, b double, c double, d double")
    a, b, c, d = boosting._bin_edges(df, ["a", "b", "c", "d"], 16)
    assert a.tolist() == [0.0] and len(b) == 15 and c.tolist() == [1.0] and d.tolist() == [0.0]
    assert [e.tolist() for e in boosting._bin_edges(df.limit(0), ["a"], 16)] == [[0.0]]
