"""A streaming source whose offsets are weeks: landed rows are replayed in week order on any store.

Rows land as ``landing=<number>/week=<Monday>/*.parquet``, one landing a call.  An offset is a
(landing, week) pair, so order is that of names: landings as they came, and the weeks of each in order.  No
file time is read or set.  A landing counts once its ``_SUCCESS`` file is there.

Each micro-batch holds the next ``weeks`` weeks (all that are there by default).  Spark hands a
restarted source the offsets of an unfinished batch only; where the last one was finished, the caller says with
``after`` up to where its own output goes.

The source lists and reads through pyarrow's file systems (local, HDFS, S3, GCS, Azure), on the driver for
names and in tasks for rows, some ``TASK_BYTES`` of files a task.
"""

from __future__ import annotations

import json

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidewatch.sources import store

START = ("", "")
TASK_BYTES, FILE_BYTES = 64 << 20, 1 << 20          # a file counts as FILE_BYTES more than its size


def landed(path: str) -> dict[tuple[str, str], list[tuple[str, int]]]:
    """Files, with sizes, of every (landing, week) of the finished landings below ``path``."""
    from pyarrow import fs
    where, base = store.in_task(path)
    found: dict[tuple[str, str], list[tuple[str, int]]] = {}
    done = set()
    for info in where.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)):
        parts = info.path[len(base):].strip("/").split("/")
        if parts[-1] == "_SUCCESS":
            done.add(parts[0])
        elif info.is_file and len(parts) == 3 and parts[1].startswith("week=") and parts[2].endswith(".parquet"):
            found.setdefault((parts[0], parts[1][5:]), []).append((info.path, info.size))
    return {k: sorted(v) for k, v in sorted(found.items()) if k[0] in done}


class WeekReader(DataSourceStreamReader):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.columns = options["path"], columns
        self.weeks = int(options.get("weeks") or 0)
        self.position = tuple(json.loads(options["after"])) if options.get("after") else START

    @staticmethod
    def _offset(place) -> dict:
        return {"landing": place[0], "week": place[1]}

    @staticmethod
    def _place(offset: dict) -> tuple[str, str]:
        return offset["landing"], offset["week"]

    def initialOffset(self) -> dict:
        return self._offset(START)

    def latestOffset(self) -> dict:
        ahead = [k for k in landed(self.path) if k > self.position]
        if not ahead:
            return self._offset(self.position)
        return self._offset(ahead[min(self.weeks or len(ahead), len(ahead)) - 1])

    def partitions(self, start: dict, end: dict) -> list:
        first, last = self._place(start), self._place(end)
        self.position = max(self.position, last)
        tasks, room = [], 0
        for k, files in landed(self.path).items():
            if first < k <= last:
                for name, size in files:
                    if room < size + FILE_BYTES:
                        tasks.append([])
                        room = TASK_BYTES
                    tasks[-1].append((k, name))
                    room -= size + FILE_BYTES
        return [InputPartition(t) for t in tasks]

    def read(self, partition: InputPartition):
        import pyarrow as pa
        from pyarrow import parquet
        where, _ = store.in_task(self.path)
        for (landing, week), name in partition.value:
            with where.open_input_file(name) as f:
                for batch in parquet.ParquetFile(f).iter_batches(columns=self.columns):
                    n = batch.num_rows
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in self.columns), pa.array([landing] * n, pa.string()),
                                                      pa.array([week] * n, pa.string())], [*self.columns, "landing", "week"])


class WeekSource(DataSource):
    """``spark.readStream.format("weeks").schema(data columns + landing, week).option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return "weeks"

    def schema(self):
        raise ValueError("give the schema of the landed rows, and landing and week as strings")

    def streamReader(self, schema) -> WeekReader:
        return WeekReader(dict(self.options), [f.name for f in schema if f.name not in ("landing", "week")])
