"""Updated gold equals a rebuild after adds, edits and deletes, and reads changed weeks only."""
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import features
from tidewatch.plans import catalog, incremental
from tidewatch.session import scratch_path
from tidewatch.sources import store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hr(spark):
    weeks = [r[0] for r in catalog._hr(spark, SF).select("weekly_ts").distinct().orderBy("weekly_ts").limit(30).collect()]
    return catalog._hr(spark, SF).where(F.col("weekly_ts").isin(weeks)).cache(), [str(w)[:10] for w in weeks]


def same(got, want):
    key = lambda r: (str(r["sales"]), str(r["weekly_ts"]))
    got, want = (sorted((r.asDict() for r in df.collect()), key=key) for df in (got, want))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert {k: round(v, 9) if isinstance(v, float) else v for k, v in a.items()} == {
            k: round(v, 9) if isinstance(v, float) else v for k, v in b.items()}


def test_adds_edits_and_deletes(spark, hr):
    rows, weeks = hr
    home = scratch_path(spark, "incremental")
    silver = f"{home}/silver"
    at = lambda *i: F.date_format("weekly_ts", "yyyy-MM-dd").isin([weeks[k] for k in i])
    now = rows.where(~at(4, 17))
    incremental.land(now, silver)
    done = incremental.update(spark, silver, home)
    assert done["rethreshold"] and done["read"] == sorted(set(weeks) - {weeks[4], weeks[17]})
    same(incremental.gold(spark, home), features.dept_week_gold(now))
    assert incremental.update(spark, silver, home) == {"read": [], "written": [], "rethreshold": False}

    # an edit that leaves the quantiles alone: labels only; unchanged weeks are neither read nor written
    edited = now.withColumn("left_flag", F.when(at(9), 1 - F.col("left_flag")).otherwise(F.col("left_flag")))
    incremental.land(edited.where(at(9)), silver)
    done = incremental.update(spark, silver, home)
    assert done["read"] == [weeks[9]] and not done["rethreshold"]
    assert weeks[9] in done["written"] and len(done["written"]) <= 7 and min(done["written"]) == weeks[9]
    same(incremental.gold(spark, home), features.dept_week_gold(edited))

    # a deleted week changes the next one's lags; an added week, too
    store.remove(spark, f"{silver}/week={weeks[20]}")
    incremental.land(rows.where(at(4)), silver)
    now = edited.where(~at(20)).unionByName(rows.where(at(4)))
    done = incremental.update(spark, silver, home)
    assert weeks[4] in done["read"] and weeks[20] not in done["written"]
    same(incremental.gold(spark, home), features.dept_week_gold(now))

    # other quantiles: every flag may change, so all weeks are read
    moved = now.withColumn("average_montly_hours", F.when(at(2, 3, 5, 6, 7, 8), F.col("average_montly_hours") + 500).otherwise(F.col("average_montly_hours")))
    incremental.land(moved.where(at(2, 3, 5, 6, 7, 8)), silver)
    assert incremental.update(spark, silver, home)["rethreshold"]
    same(incremental.gold(spark, home), features.dept_week_gold(moved))


def test_a_failed_update_is_done_again(spark, hr, monkeypatch):
    rows, weeks = hr
    home = scratch_path(spark, "incremental")
    rows = rows.where(F.date_format("weekly_ts", "yyyy-MM-dd").isin(weeks[:8]))
    incremental.land(rows.where(F.col("EmployeeID") % 3 != 0), f"{home}/silver")
    incremental.update(spark, f"{home}/silver", home)
    incremental.land(rows, f"{home}/silver")
    put = store.put_new
    monkeypatch.setattr(store, "put_new", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        incremental.update(spark, f"{home}/silver", home)
    monkeypatch.setattr(store, "put_new", put)
    incremental.update(spark, f"{home}/silver", home)
    same(incremental.gold(spark, home), features.dept_week_gold(rows))
