"""Structured Streaming: weekly event windows and the weekly alert replay.

* R2 ``weekly_event_stream`` — file source → event time → tumbling Monday-aligned
  one-week windows per key, in update mode.
* R1/R3/R4 ``weekly_alert_stream`` — scored employee rows land and are replayed in week
  order by the week source; department-week means are updated, joined to the static
  department-week context inside ``foreachBatch`` and kept as JSON ``{alert, summary}`` records.

A micro-batch commits the windows it changed to a keyed table (``streaming.sink``): replayed batches
change nothing, readers see whole versions, and reads stay in proportion to the windows.  Every week is
there, the open one too, and a late row only updates its week.  State is one row per window and
key; ``delay`` sets a watermark that lets old windows go (and drops rows later than that), none keeps all.
``streaming.windows`` closes windows by timers instead and keeps the late rows.

With a ``name``, landing folder, sink and checkpoint live under
``<shared folder>/streams/<name>`` and a restarted driver goes on after the last
committed batch; without one, each call is a new stream.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators import alerts as AL
from tidewatch.session import scratch_path, shared_dir
from tidewatch.sources import store
from tidewatch.streaming.sink import KeyedTable
from tidewatch.streaming.weeksource import WeekSource

WEEK = "1 week"
MONDAY_OFFSET_DAYS = 4             # epoch day 0 is a Thursday; +4 days aligns windows to Monday
MONDAY_OFFSET = f"{MONDAY_OFFSET_DAYS} days"
US_PER_DAY = 86_400_000_000


def event_time_utc(ntz: Column) -> Column:
    """Wall-clock ``timestamp_ntz`` → instant, reading the wall clock as UTC.

    Built from date and time parts, so it does not depend on the session time
    zone (a plain cast would).  Watermarks need an instant-typed column.
    """
    days = F.datediff(F.to_date(ntz), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = (F.hour(ntz) * 3600 + F.minute(ntz) * 60).cast("bigint")
    frac_us = (F.date_part(F.lit("SECOND"), ntz) * 1_000_000).cast("bigint")
    return F.timestamp_micros(days * US_PER_DAY + secs * 1_000_000 + frac_us)


def window_start_ntz(window_start: Column) -> Column:
    """Start instant of a (midnight-aligned) window back to a ``timestamp_ntz`` date."""
    days = F.floor(F.unix_micros(window_start) / US_PER_DAY).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("timestamp_ntz")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("latestFirst", "false")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if path.endswith(".parquet") and "*" not in path and "[" not in path:
        # a single parquet file: read it through a one-file glob under its folder
        base, name = path.rsplit("/", 1)
        return reader.option("basePath", base).parquet(f"{base}/[{name[0]}]{name[1:]}")
    return reader.parquet(path)


def stream_home(spark: SparkSession, name: str | None) -> str:
    return f"{shared_dir(spark).rstrip('/')}/streams/{name}" if name else scratch_path(spark, "stream")


def _weekly(stream: DataFrame, ts_col: str, keys: Sequence[str], delay: str | None, *aggs: Column) -> DataFrame:
    """Updates of Monday-aligned weekly windows: ``week``, the keys and the aggregates."""
    timed = stream.withColumn("_et", event_time_utc(F.col(ts_col)))
    if delay is not None:
        timed = timed.withWatermark("_et", delay)
    agg = timed.groupBy(F.window("_et", WEEK, WEEK, MONDAY_OFFSET).alias("w"), *keys).agg(*aggs)
    return agg.select(window_start_ntz(F.col("w.start")).alias("week"), *[c for c in agg.columns if c != "w"])


def _run(updates: DataFrame, home: str, commit, stepwise: bool = False) -> None:
    """All that is available now, batch by batch, through ``commit(rows, batch id)``.

    A ``stepwise`` source offers more each time it is asked, until there is no more.
    """
    writer = (updates.writeStream.outputMode("update").foreachBatch(commit).option("checkpointLocation", f"{home}/checkpoint"))
    if not stepwise:
        writer.trigger(availableNow=True).start().awaitTermination()
        return
    q = writer.start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def weekly_event_stream(spark: SparkSession, source: str, ts_col: str, keys: Sequence[str], value_col: str,
                        delay: str | None = None, max_files: int | None = None, name: str | None = None) -> DataFrame:
    """R2: run the windowed aggregation over all that is available and return every window."""
    stream = file_stream(spark, source, spark.read.parquet(source).schema, max_files)
    out = _weekly(stream, ts_col, keys, delay, F.count(F.lit(1)).alias("n"), F.avg(value_col).alias("avg_value"),
                  F.sum(value_col).alias("sum_value")).withColumnRenamed("week", "week_start")
    home = stream_home(spark, name)
    table = KeyedTable(spark, f"{home}/sink", out.schema, ["week_start", *keys])
    _run(out, home, table.commit)
    return table.read()


def stage_by_week(df: DataFrame, path: str, week_col: str = "weekly_ts", split_by: str = "EmployeeID",
                  rows_a_file: int = 1_000_000) -> str:
    """Land rows as the next ``landing=<number>/week=<Monday>`` folders, for the week source.

    Rows are range-partitioned by week and ``split_by``, and files are bounded, so a hot week is several files.
    Rows without a week land in a week of their own, the last.
    """
    number = 1 + max((int(n.split("=")[1]) for n in store.names(df.sparkSession, path) if n.startswith("landing=")), default=0)
    (df.withColumn("week", F.coalesce(F.date_format(week_col, "yyyy-MM-dd"), F.lit("none"))).repartitionByRange("week", split_by)
     .write.option("maxRecordsPerFile", rows_a_file).partitionBy("week").parquet(f"{path}/landing={number:09d}"))
    return path


ALERT_RECORD = T.StructType([
    T.StructField("alert", T.StructType([
        T.StructField("dept", T.StringType()), T.StructField("weekly_ts", T.StringType()),
        T.StructField("headcount", T.LongType()), T.StructField("leavers", T.LongType()),
        T.StructField("attrition_rate", T.DoubleType()), T.StructField("risk_score", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()), T.StructField("top_drivers", T.ArrayType(T.StringType())),
        T.StructField("warning", T.BooleanType()), T.StructField("notes", T.StringType())])),
    T.StructField("summary", T.StringType())])


class AlertTable(KeyedTable):
    """JSON ``{alert, summary}`` records, keyed by department and week."""

    def flat(self, files: DataFrame) -> DataFrame:
        rest = [c for c in files.columns if c not in ("alert", "summary")]
        return files.select("alert.*", "summary", *rest)

    def nested(self, rows: DataFrame) -> DataFrame:
        names = [f.name for f in ALERT_RECORD["alert"].dataType]
        return rows.select(F.struct(*names).alias("alert"), "summary")


LANDED = ["EmployeeID", "sales", "weekly_ts", "fused_score"]


def weekly_alert_stream(spark: SparkSession, scored: DataFrame, dept_week: DataFrame, tau: float,
                        delay: str | None = None, weeks: int | None = None, name: str | None = None) -> DataFrame:
    """R1 + R3 + R4: land the rows, replay them week by week, update department-week risk, keep alert records.

    A micro-batch takes the next ``weeks`` weeks, all that are there by default.  Returns the
    latest record of every department-week, flat.  ``tau`` is a plain float: a
    streaming query runs indefinitely, so the threshold is resolved once when it starts.
    A second call with the same ``name`` lands its rows after the first's and resumes.
    """
    home = stream_home(spark, name)
    table = AlertTable(spark, f"{home}/sink", ALERT_RECORD, ["dept", "weekly_ts"], fmt="json")
    landing = stage_by_week(scored.select(*LANDED), f"{home}/landing")
    spark.dataSource.register(WeekSource)
    schema = T.StructType([*(scored.schema[c] for c in LANDED), T.StructField("landing", T.StringType()), T.StructField("week", T.StringType())])
    reader = spark.readStream.format("weeks").schema(schema).option("path", landing)
    if weeks:
        reader = reader.option("weeks", str(weeks))
    after = table.manifest()["position"]
    if after:
        reader = reader.option("after", json.dumps(after))
    risk = _weekly(reader.load(), "weekly_ts", ["sales"], delay, F.avg("fused_score").alias("risk_score"),
                   F.max(F.struct(F.col("landing"), F.col("week"))).alias("_position")).withColumnRenamed("week", "weekly_ts")
    context = dept_week.select(*AL.KEYS, *[c for c in AL.CONTEXT_COLUMNS if c in dept_week.columns])

    def commit(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            reached = batch.agg(F.max("_position")).first()[0]
            known = batch.where(F.col("sales").isNotNull() & F.col("weekly_ts").isNotNull()).drop("_position")
            records = AL.alert_records(known.join(context, AL.KEYS, "left"), F.lit(float(tau)))
            table.commit(AL.with_summary(records), batch_id, list(reached) if reached else table.manifest()["position"])
        finally:
            batch.unpersist()

    _run(risk, home, commit, stepwise=True)
    return table.read()
