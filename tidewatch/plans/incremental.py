"""Gold department-weeks kept up to date from changed weeks only.

The silver rows lie in ``week=<yyyy-mm-dd>`` folders (``land`` writes them).  Beside the gold table the store keeps, per week, what
adds up: the histogram of the columns behind the violation thresholds, and the sums and counts of every
department.  An update

1. compares the weeks' files with those of the last update (names, sizes, times: no rows are read);
2. reads the rows of added and edited weeks only, and replaces their histograms;
3. merges all weeks' histograms to the exact thresholds.  Where these moved, the flags of every row may have, so
   every week's sums are made again, which is the only case that reads unchanged weeks;
4. replaces the sums of the weeks read, drops those of deleted weeks;
5. rewrites the gold rows of the changed weeks and of each department's next week after one, whose lags come
   from it, by dynamic partition overwrite.

The state file is written last, so an update that failed is done again; every step replaces whole weeks, so
doing it again changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.operators import features
from tidewatch.session import checkpointed
from tidewatch.sources import store

WEEK = "week"


def land(silver: DataFrame, path: str) -> None:
    """Silver rows into ``week=<yyyy-mm-dd>`` folders; the weeks they hold are replaced, the others stay."""
    write_weeks(silver.withColumn(WEEK, F.coalesce(F.date_format("weekly_ts", "yyyy-MM-dd"), F.lit("none"))), path)


def write_weeks(df: DataFrame, path: str) -> None:
    """Replace the weeks in ``df``; a week is few files, and a hot one is split by its size."""
    df.hint("rebalance", WEEK).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WEEK).parquet(path)


def _read(spark: SparkSession, path: str, weeks: list[str] | None = None) -> DataFrame:
    """The rows of all weeks, or of some; only their folders are listed and read."""
    paths = [path] if weeks is None else [f"{path}/{WEEK}={w}" for w in weeks]
    return spark.read.option("basePath", path).parquet(*paths).withColumn(WEEK, F.col(WEEK).cast("string"))


def _last_state(spark: SparkSession, home: str) -> dict:
    found = [n for n in store.names(spark, f"{home}/state") if not n.startswith(".")]
    return json.loads(store.read_text(spark, f"{home}/state/{found[-1]}")) if found else {"version": 0, "weeks": {}, "thresholds": None}


def _drop(spark: SparkSession, path: str, weeks: list[str]) -> None:
    there = set(store.names(spark, path))
    for w in weeks:                                        # a week may end up with no row of a table
        if f"{WEEK}={w}" in there:
            store.remove(spark, f"{path}/{WEEK}={w}")


def update(spark: SparkSession, silver: str, home: str) -> dict:
    """Bring the gold table at ``home`` up to date with the rows at ``silver``; returns what was done.

    ``read`` lists the weeks whose rows were read, ``written`` those whose gold rows were.
    """
    last, now = _last_state(spark, home), store.states(spark, silver, WEEK)
    changed = sorted(w for w in now if last["weeks"].get(w) != now[w])
    deleted = sorted(w for w in last["weeks"] if w not in now)
    if not changed and not deleted:
        return {"read": [], "written": [], "rethreshold": False}
    hist, sums, gold = (f"{home}/{name}" for name in ("histogram", "sums", "gold"))
    _drop(spark, hist, [*deleted, *changed])
    if changed:
        write_weeks(features.threshold_histogram(_read(spark, silver, changed), [WEEK]), hist)
    if not now:
        for path in (sums, gold):
            _drop(spark, path, deleted)
        _save(spark, home, last, now, None)
        return {"read": [], "written": deleted, "rethreshold": False}
    merged = _read(spark, hist).groupBy("feature", "value").agg(F.sum("cnt").alias("cnt"))
    limits = features.thresholds_of(merged).first().asDict()
    moved = limits != last["thresholds"]
    again = sorted(now) if moved else changed
    _drop(spark, sums, [*deleted, *again])
    if again:
        values = spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in limits.items()])
        partials = features.dept_week_partials(features.violation_flags(_read(spark, silver, again), values))
        write_weeks(partials.withColumn(WEEK, F.date_format("weekly_ts", "yyyy-MM-dd")), sums)
    parts = checkpointed(_read(spark, sums))               # departments x weeks, not rows
    rows = features.add_lags(features.finished(parts)).withColumn(WEEK, F.date_format("weekly_ts", "yyyy-MM-dd"))
    if not moved:
        # a mark behind each changed week of every department: the row that follows one has a new lag
        marks = F.explode(F.array(*[F.lit(w) for w in [*changed, *deleted]]))
        marked = parts.select("sales").distinct().select("sales", marks.alias(WEEK), F.lit(None).cast("timestamp_ntz").alias("weekly_ts"))
        line = parts.select("sales", WEEK, "weekly_ts").unionByName(marked).withColumn("_mark", F.col("weekly_ts").isNull())
        follows = F.lag("_mark").over(Window.partitionBy("sales").orderBy(WEEK, "_mark", "weekly_ts"))
        due = line.withColumn("_due", follows | F.col(WEEK).isin(changed)).where("_due and not _mark")
        rows = rows.join(due.select(WEEK).distinct(), WEEK, "left_semi")
    rows = checkpointed(rows)
    written = sorted(r[0] for r in rows.select(WEEK).distinct().collect())                    # weeks
    _drop(spark, gold, sorted({*deleted, *changed, *written}))
    if written:
        write_weeks(rows, gold)
    _save(spark, home, last, now, limits)
    return {"read": again, "written": written, "rethreshold": moved}


def _save(spark: SparkSession, home: str, last: dict, now: dict, limits: dict | None) -> None:
    version = last["version"] + 1
    store.put_new(spark, f"{home}/state/{version:09d}-{uuid.uuid4().hex[:6]}.json",
                  json.dumps({"version": version, "weeks": now, "thresholds": limits}))


def gold(spark: SparkSession, home: str) -> DataFrame:
    """The department-week table, its columns in the order of a whole build."""
    out = _read(spark, f"{home}/gold").drop(WEEK)
    return out.select(*features.KEYS, *[c for c in out.columns if c not in features.KEYS])
