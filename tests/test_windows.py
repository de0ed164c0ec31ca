"""Windows closed by timers: every row is in one window or late, and state holds open weeks only."""
import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from tidewatch.session import shared_dir
from tidewatch.streaming import weekly, windows

MONDAY = datetime.datetime(2024, 1, 1)


def land(spark, path, batches):
    """Each batch of (day, key, value) is one file, taken alone and in order."""
    import os
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(MONDAY + datetime.timedelta(days=d), k, v) for d, k, v in rows], "ts timestamp_ntz, k string, value double")
        df.coalesce(1).write.mode("append").parquet(path)
        for f in os.listdir(path):
            full = f"{path}/{f}"
            if os.path.getmtime(full) > 10_000:
                os.utime(full, (1000 + i, 1000 + i))
    return weekly.file_stream(spark, path, df.schema, 1)


def brute(batches, delay):
    """Windows {(week, key): [n, sum]} and late rows, by the watermark each batch begins with."""
    mark, top, held, late = -10**9, -10**9, {}, []
    for rows in batches:
        for d, k, v in rows:
            week = int(d // 7)
            if (week + 1) * 7 <= mark:
                late.append((k, v, week))
            else:
                n = held.setdefault((week, k), [0, 0.0])
                n[0], n[1] = n[0] + 1, n[1] + (v or 0)
        top = max([top, *(d for d, _, _ in rows)])
        mark = top - delay
    return held, late, mark


BATCHES = [[(0.5, "a", 1.0), (6.9, "b", 2.0), (3, None, 5.0)], [(8, "a", 3.0), (1, "a", 4.0)], [(16, "b", 1.5), (9, "a", None)],
           [(2, "a", 7.0), (8.5, "b", 2.5), (22, "a", 1.0)], [(10, "c", 9.0), (40, "b", 1.0), (23, "a", 2.0)], [(41, "b", 2.0), (12, "c", 1.0)]]


@pytest.mark.parametrize("delay", [0, 10])
def test_rows_are_in_one_window_or_late(spark, delay):
    path = f"{shared_dir(spark)}/rows-{uuid.uuid4().hex[:8]}"
    stream = land(spark, path, BATCHES)
    found, late = windows.closing_weekly_stream(spark, stream, "ts", ["k"], "value", f"{delay} days")
    held, want_late, mark = brute(BATCHES, delay)
    week = lambda t: (t - MONDAY).days // 7
    rows = found.collect()
    assert {(week(r.week_start), r.k): [r.n, r.sum_value or 0.0] for r in rows} == held
    assert {(week(r.week_start), r.k) for r in rows if r.closed} == {(w, k) for w, k in held if (w + 1) * 7 <= mark}
    assert sorted((r.k, r.value, week(r.week_start)) for r in late.collect()) == sorted(want_late)
    assert sum(r.n for r in rows) + late.count() == sum(map(len, BATCHES))
    assert bool(want_late) == (delay == 0) or delay


def test_state_does_not_grow_with_weeks(spark):
    """Ten times the weeks, one week a batch: the state rows stay those of the open weeks."""
    held = {}
    for weeks in (3, 30):
        path = f"{shared_dir(spark)}/rows-{uuid.uuid4().hex[:8]}"
        name = f"flat-{uuid.uuid4().hex[:8]}"
        batches = [[(7 * w + 1, "a", 1.0), (7 * w + 2, "b", 1.0)] for w in range(weeks)]
        stream = land(spark, path, [sum(batches[i:i + weeks // 3], []) for i in range(0, weeks, weeks // 3)])
        found, late = windows.closing_weekly_stream(spark, stream, "ts", ["k"], "value", "1 day", name=name)
        assert found.count() == 2 * weeks and late.count() == 0
        state = spark.read.format("statestore").option("stateVarName", "open").load(f"{shared_dir(spark)}/streams/{name}/checkpoint")
        held[weeks] = state.count()
    assert held[30] == held[3] == 2
