import numpy as np
import pytest
from tidewatch.llm import vector_join as V


def brute(rows, groups, cosine=0.93):
    usable = [v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
              for _, v, label in rows]
    g, links = groups(range(len(rows))), [0] * len(rows)
    keys = {}
    for i, (_, v, label) in enumerate(rows):
        if usable[i]:
            keys.setdefault((label, len(v)), []).append(i)
    for members in keys.values():
        x = np.array([rows[i][1] for i in members], float)
        norm = np.sqrt((x * x).sum(1))
        for a, b in zip(*np.nonzero(x @ x.T / np.outer(norm, norm) >= cosine)):
            if a != b:
                links[members[a]] += 1
                g.link(members[a], members[b])
    least = {}
    for i, (n, *_) in enumerate(rows):
        if n is not None:
            least[g.root(i)] = min(least.get(g.root(i), n), n)
    return sorted(((n, links[i], least.get(g.root(i)), n == least.get(g.root(i))) for i, (n, *_) in enumerate(rows)), key=str)


@pytest.mark.parametrize("cell,block", [(2000, 1024), (25, 8)])
def test_links_and_components(spark, groups, cell, block):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(12, 5))
    rows = [(i, None if i % 97 == 0 else [float(x) for x in np.float32(centre[i % 12] + rng.normal(size=5) * 0.35)],
             None if i % 53 == 0 else i % 2) for i in range(400)]
    one, nan, inf = [1.0, 0.0, 0.0, 0.0, 0.0], float("nan"), float("inf")
    rows += [(500 + i, one, 0) for i in range(30)] + [(500, one, 0), (None, one, 1)]
    rows += [(600, [0.0] * 5, 0), (601, [nan] * 5, 0), (602, [None, 1.0, 1.0, 1.0, 1.0], 0), (603, [inf, 1.0, 1.0, 1.0, 1.0], 1),
             (604, [], 0), (605, [1.0, 2.0], 0), (606, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, links string")
    got = sorted((tuple(r) for r in V.near_duplicates(df, cell=cell, block=block).collect()), key=str)
    assert got == brute(rows, groups)
    assert V.near_duplicates(df.limit(0)).collect() == []


def test_groups_of_a_bounded_number_of_pivots(spark, groups):
    """A label with many pivots is worked on in tiles of them, with the same links."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(30, 4))
    rows = [(i, [float(x) for x in centre[i % 30] + rng.normal(size=4) * 0.3], i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((tuple(r) for r in V.near_duplicates(df, cell=5, block=16, deal=100, tile=8).collect()), key=str)
    assert got == brute(rows, groups)
    _, distinct = V.classes(df, "vec_id", "embedding", "label")
    dealt, pivots = V._dealt(distinct, cell=1, deal=100, tile=20)
    sizes = pivots.groupBy("p_label", "p_dim", "p_deal", "p_tile").count().collect()
    assert pivots.select("p_c").distinct().count() == 600 and max(r["count"] for r in sizes) < 60
    assert max(r["count"] for r in dealt.groupBy("label", "dim", "deal").count().collect()) < 200
