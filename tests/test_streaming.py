"""The weekly replay loses no row, whatever the batches, and resumes on a named checkpoint."""
import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators import scoring
from tidewatch.plans import catalog
from tidewatch.session import shared_dir
from tidewatch.sources import store
from tidewatch.streaming import weekly
from tidewatch.streaming.sink import KeyedTable
from tidewatch.streaming.weeksource import WeekReader

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    scored = catalog._scored(spark, SF)
    weeks = [r.weekly_ts for r in scored.select("weekly_ts").distinct().orderBy("weekly_ts").limit(12).collect()]
    return scored.where(F.col("weekly_ts").isin(weeks)), catalog._gold(spark, SF), weeks


def rows(df):
    return sorted((r.dept, r.weekly_ts, round(r.risk_score, 6), r.warning, r.summary) for r in df.collect())


def test_every_week_whatever_the_batches(spark, tables):
    scored, gold, weeks = tables
    whole = rows(weekly.weekly_alert_stream(spark, scored, gold, 0.3))
    risk = scoring.dept_week_risk(scored)
    assert len(whole) == risk.count() and max(r[1] for r in whole) == str(weeks[-1])[:10]
    assert rows(weekly.weekly_alert_stream(spark, scored, gold, 0.3, weeks=1)) == whole


def test_named_stream_resumes_without_duplicates(spark, tables):
    scored, gold, weeks = tables
    name = f"test-{uuid.uuid4().hex[:8]}"
    # the second half holds more rows of weeks that the first has seen, and new weeks
    half = F.col("EmployeeID") % 2 == 0
    weekly.weekly_alert_stream(spark, scored.where(half & (F.col("weekly_ts") < weeks[8])), gold, 0.3, weeks=3, name=name)
    rest = scored.where(~(half & (F.col("weekly_ts") < weeks[8])))
    resumed = rows(weekly.weekly_alert_stream(spark, rest, gold, 0.3, weeks=2, name=name))
    assert resumed == rows(weekly.weekly_alert_stream(spark, scored, gold, 0.3))
    record = spark.read.json(f"{shared_dir(spark)}/streams/{name}/sink/batch=*")
    assert set(record.columns) >= {"alert", "summary"} and "dept" in record.select("alert.*").columns


def test_source_offsets_are_weeks_in_landing_order(spark, tables):
    """Order rests on names only: the files' times are shuffled before the source sees them."""
    scored, _, weeks = tables
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex[:8]}"
    rows = scored.select(*weekly.LANDED)
    for part in (rows.where(F.col("weekly_ts") >= weeks[3]), rows.where(F.col("weekly_ts") < weeks[6])):
        weekly.stage_by_week(part, path, rows_a_file=5)
    rows.where("1 = 0").write.parquet(f"{path}/landing=000000009")           # empty
    rows.limit(3).withColumn("week", F.lit("1990-01-01")).write.partitionBy("week").parquet(f"{path}/landing=000000010")
    os.remove(f"{path}/landing=000000010/_SUCCESS")                          # not finished
    for i, f in enumerate(sorted(glob.glob(f"{path}/*/*/*.parquet"), key=lambda f: f[::-1])):
        os.utime(f, (i, i))
    reader = WeekReader({"path": path, "weeks": "2"}, weekly.LANDED)
    offset, seen, steps = reader.initialOffset(), [], 0
    while (new := reader.latestOffset()) != offset:
        for p in reader.partitions(offset, new):
            for batch in reader.read(p):
                assert batch.num_rows <= 5 and batch.schema.names == [*weekly.LANDED, "landing", "week"]
                seen += [(a, b, e) for a, b, e in zip(*(batch.column(c).to_pylist() for c in ("landing", "week", "EmployeeID")))]
        offset, steps = new, steps + 1
    places = [s[:2] for s in seen]
    day = lambda w: str(w)[:10]
    want = sorted({("landing=000000001", day(w)) for w in weeks[3:]} | {("landing=000000002", day(w)) for w in weeks[:6]})
    assert list(dict.fromkeys(places)) == want and steps == -(-len(want) // 2)
    assert len(seen) == rows.count() + rows.where((F.col("weekly_ts") >= weeks[3]) & (F.col("weekly_ts") < weeks[6])).count()
    # a restarted source goes on after what the output holds
    again = WeekReader({"path": path, "weeks": "2", "after": json.dumps(want[4])}, weekly.LANDED)
    assert tuple(again.latestOffset().values()) == want[6]


SCHEMA = "k int, v string"


@pytest.fixture
def table(spark):
    return KeyedTable(spark, f"{shared_dir(spark)}/table-{uuid.uuid4().hex[:8]}", T._parse_datatype_string(SCHEMA), ["k"], few_rows=4)


def batch_of(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def state(df):
    return dict(sorted((r.k, r.v) for r in df.collect()))


def test_table_replays_and_crashes(spark, table, monkeypatch):
    assert state(table.read()) == {}
    assert table.commit(batch_of(spark, (1, "a"), (2, "b")), 0, "p0")
    assert not table.commit(batch_of(spark, (1, "replayed")), 0)
    assert state(table.read()) == {1: "a", 2: "b"} and table.manifest()["position"] == "p0"
    # the driver dies between the data and the manifest: the version stays, the replay succeeds
    put = store.put_new
    monkeypatch.setattr(store, "put_new", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        table.commit(batch_of(spark, (2, "lost"), (3, "lost")), 1)
    assert state(table.read()) == {1: "a", 2: "b"}
    monkeypatch.setattr(store, "put_new", put)
    assert table.commit(batch_of(spark, (2, "c"), (3, "d")), 1, "p1")
    assert state(table.read()) == {1: "a", 2: "c", 3: "d"}
    # a second writer of the same version fails instead of overwriting
    doc = table.manifest()
    with pytest.raises(Exception):
        table._publish(doc)
    assert table.manifest() == doc


def test_compaction_under_a_reader(spark, table):
    for i in range(3):
        table.commit(batch_of(spark, (1, f"a{i}"), (i, f"b{i}")) if i != 1 else batch_of(spark, (1, "b1")), i)
    version = table.manifest()["version"]
    before, old = table.read(), state(table.read())
    table.compact()
    assert table.manifest()["log"] == [] and state(table.read()) == old and state(before) == old
    assert table.vacuum(keep=2) == [] and state(table.read(version)) == old   # the version before is kept
    table.commit(batch_of(spark, (9, "z")), 3)
    table.compact()
    assert len(table.vacuum(keep=1)) >= 4 and state(table.read()) == {**old, 9: "z"}
    with pytest.raises(ValueError):
        table.read(version)


def test_reads_stay_in_proportion_to_the_keys(spark, table):
    want = {}
    for i in range(16):
        pairs = {k: f"{i}-{k}" for k in (i % 5, (i + 1) % 5)}
        want.update(pairs)
        table.commit(batch_of(spark, *pairs.items()), i)
        doc = table.manifest()
        held = (doc["snapshot"]["rows"] if doc["snapshot"] else 0) + sum(e["rows"] for e in doc["log"])
        assert held <= 2 * len(want) + table.few_rows
    assert state(table.read()) == dict(sorted(want.items()))
    table.max_log = 0                                                        # very many folders
    table.commit(batch_of(spark, (0, "last")), 16)
    assert table.manifest()["log"] == [] and state(table.read())[0] == "last"
