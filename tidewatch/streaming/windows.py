"""Weekly windows that close by event-time timers, with late rows kept aside: no row is lost, state stays flat.

Every key holds its open weeks in a map state; the first row of a week sets an event-time timer at the
week's end.  Once the watermark (largest event time so far less ``delay``) is past it, the window is closed: its
last version is put out, and its state goes.  A row of a closed week is late and goes to the late table as it
is.  So every row with a time is in exactly one window or in the late table, and state holds open weeks only,
however long the stream runs.

The watermark column itself is dropped before the stateful step, which would otherwise drop late rows unseen.
A batch's rows of one key are aggregated map-side in pandas pieces; nothing is kept per row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidewatch.streaming.sink import KeyedTable
from tidewatch.streaming.weekly import MONDAY_OFFSET_DAYS, US_PER_DAY, event_time_utc, stream_home, window_start_ntz

WEEK_US = 7 * US_PER_DAY
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class WeeklyWindows(StatefulProcessor):
    """Sums of ``value`` per open week; rows are ``(keys..., us, value)``, ``us`` = event time in microseconds."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "week bigint", "n bigint, seen bigint, total double")

    def _rows(self, key, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["kind", "week", "us", "value", "n", "seen", "total"])
        for name, value in zip(self.keys, key):
            out[name] = value
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        touched: dict[int, list] = {}
        for piece in rows:
            week = (piece["us"] - MONDAY_OFFSET_DAYS * US_PER_DAY) // WEEK_US * WEEK_US + MONDAY_OFFSET_DAYS * US_PER_DAY
            late = week + WEEK_US <= mark
            if late.any():
                yield self._rows(key, [("late", int(w), int(us), v, None, None, None) for w, us, v in
                                       zip(week[late], piece["us"][late], piece["value"][late])])
            for w, values in piece["value"][~late].groupby(week[~late]):
                t = touched.setdefault(int(w), [0, 0, 0.0])
                t[0], t[1], t[2] = t[0] + len(values), t[1] + int(values.count()), t[2] + float(values.sum())
        out = []
        for w, (n, seen, total) in sorted(touched.items()):
            old = self.open.getValue((w,)) if self.open.containsKey((w,)) else None
            if old is None:
                self.handle.registerTimer((w + WEEK_US) // 1000)
            else:
                n, seen, total = n + old[0], seen + old[1], total + old[2]
            self.open.updateValue((w,), (n, seen, total))
            out.append(("open", w, None, None, n, seen, total))
        if out:
            yield self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        w = expiredTimerInfo.getExpiryTimeInMs() * 1000 - WEEK_US
        if self.open.containsKey((w,)):
            n, seen, total = self.open.getValue((w,))
            self.open.removeKey((w,))
            yield self._rows(key, [("closed", w, None, None, n, seen, total)])

    def close(self) -> None:
        pass


def closing_weekly_stream(spark: SparkSession, stream: DataFrame, ts_col: str, keys: Sequence[str], value_col: str,
                          delay: str = "0 seconds", name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run over all that is available: ``(windows, late rows)``.

    ``windows`` has ``week_start``, the keys, ``n`` rows, ``avg_value``, ``sum_value`` and whether the window is
    ``closed``; ``late`` has the keys, ``event_us``, ``value`` and ``week_start``.  Keys may be NULL; rows without a time
    are in neither.  With a ``name`` a later call goes on after the last batch.
    """
    home = stream_home(spark, name)
    timed = stream.withColumn("_et", event_time_utc(F.col(ts_col))).where("_et is not null").withWatermark("_et", delay)
    plain = timed.select(*keys, F.unix_micros("_et").alias("us"), F.col(value_col).cast("double").alias("value"))
    fields = [T.StructField(n, t) for n, t in (
        ("kind", T.StringType()), ("week", T.LongType()), ("us", T.LongType()), ("value", T.DoubleType()), ("n", T.LongType()),
        ("seen", T.LongType()), ("total", T.DoubleType()))]
    schema = T.StructType([*fields, *(plain.schema[k] for k in keys)])
    states = plain.groupBy(*keys).transformWithStateInPandas(WeeklyWindows(keys), schema, "Update", "EventTime")
    rows = T.StructType([T.StructField("week", T.LongType()), *(plain.schema[k] for k in keys), *schema.fields[4:7], T.StructField("closed", T.BooleanType())])
    table = KeyedTable(spark, f"{home}/sink", rows, ["week", *keys])

    def commit(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.where("kind = 'late'").select(*keys, F.col("us").alias("event_us"), "value", "week").write.mode("overwrite") \
                .parquet(f"{home}/late/batch={batch_id}")
            # a window may change and close in one batch
            last = batch.where("kind != 'late'").groupBy("week", *keys).agg(F.max_by(F.struct("n", "seen", "total"), "n").alias("v"),
                                                                            F.bool_or(F.col("kind") == "closed").alias("closed"))
            table.commit(last.select("week", *keys, "v.*", "closed"), batch_id)
        finally:
            batch.unpersist()

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        states.writeStream.outputMode("update").foreachBatch(commit).option("checkpointLocation", f"{home}/checkpoint") \
            .trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    start = window_start_ntz(F.timestamp_micros("week")).alias("week_start")
    windows = table.read().select(start, *keys, "n", F.try_divide("total", "seen").alias("avg_value"),
                                  F.when(F.col("seen") > 0, F.col("total")).alias("sum_value"), "closed")
    late = spark.read.schema(T.StructType([*(plain.schema[k] for k in keys), T.StructField("event_us", T.LongType()),
                                           T.StructField("value", T.DoubleType()), T.StructField("week", T.LongType())])) \
        .parquet(f"{home}/late/batch=*")
    return windows, late.select(*keys, "event_us", "value", start)
