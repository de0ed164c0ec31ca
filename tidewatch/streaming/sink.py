"""A keyed table that micro-batches update: a snapshot, a log of batches, and an atomic manifest.

``<home>/manifest/<version>.json`` names what a version consists of: one snapshot folder (or none), the
folders of the batches after it, and the last batch.  A batch is written to a folder of its own and
then becomes part of the table by one new manifest, which is renamed into place and never
overwritten.  So

* a batch that is replayed after its manifest is skipped, one that failed before it left a folder no version names;
* readers resolve a version once and go on reading its folders, whatever is committed or compacted meanwhile;
* two writers cannot both add the same version: the second fails.

Compaction rewrites snapshot and log to a new snapshot with each key's last version when the log has
more rows than the snapshot, or very many folders.  So a read touches at most about twice the live keys
(and ``FEW_ROWS``), and each row is rewritten a bounded number of times on average.  ``vacuum`` deletes what only
older versions name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources import store

FEW_ROWS, MAX_LOG = 10_000, 24
EMPTY = {"version": 0, "batch": -1, "position": None, "snapshot": None, "log": []}


def latest(log: DataFrame, keys: Sequence[str], order: str = "batch") -> DataFrame:
    """Each key's last version in a log with an ``order`` column."""
    rest = [c for c in log.columns if c not in keys and c != order]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order).cast("bigint")).alias("v"))
    return last.select(*keys, "v.*")


@dataclass
class KeyedTable:
    """The table at ``home``; ``schema`` is that of its files, ``keys`` are columns of ``flat(file rows)``."""

    spark: SparkSession
    home: str
    schema: T.StructType
    keys: Sequence[str]
    fmt: str = "parquet"
    few_rows: int = FEW_ROWS
    max_log: int = MAX_LOG

    def flat(self, files: DataFrame) -> DataFrame:
        """File rows as table rows, which hold the keys as columns."""
        return files

    def nested(self, rows: DataFrame) -> DataFrame:
        """Table rows as file rows."""
        return rows

    def manifest(self, version: int | None = None) -> dict:
        found = [n for n in store.names(self.spark, f"{self.home}/manifest") if n.endswith(".json") and not n.startswith(".")]
        if version is not None:
            found = [n for n in found if int(n.split(".")[0]) == version]
            if not found:
                raise ValueError(f"no version {version}")
        return json.loads(store.read_text(self.spark, f"{self.home}/manifest/{found[-1]}")) if found else dict(EMPTY)

    def _publish(self, doc: dict) -> None:
        store.put_new(self.spark, f"{self.home}/manifest/{doc['version']:012d}.json", json.dumps(doc))

    def _write(self, files: DataFrame, name: str) -> dict:
        """One new folder of rows, and how many there are."""
        counted = Observation()
        name = f"{name}-{uuid.uuid4().hex[:8]}"
        files.observe(counted, F.count(F.lit(1)).alias("n")).write.format(self.fmt).save(f"{self.home}/{name}")
        return {"path": name, "rows": counted.get["n"]}

    def commit(self, rows: DataFrame, batch: int, position=None) -> bool:
        """Add the changed rows of a batch; ``False`` if that batch is part of the table already."""
        now = self.manifest()
        if batch <= now["batch"]:
            return False
        new = self._write(self.nested(rows), f"batch={batch}")
        doc = {**now, "version": now["version"] + 1, "batch": batch, "log": [*now["log"], {**new, "batch": batch}]}
        if position is not None:
            doc["position"] = position
        self._publish(doc)
        in_log = sum(e["rows"] for e in doc["log"])
        if in_log > max(self.few_rows, doc["snapshot"]["rows"] if doc["snapshot"] else 0) or len(doc["log"]) > self.max_log:
            self.compact()
        return True

    def compact(self) -> None:
        """A new version whose snapshot holds the last version of every key, and whose log is empty."""
        now = self.manifest()
        if not now["log"]:
            return
        snapshot = self._write(self.nested(self.read(now["version"])), f"snapshot={now['version'] + 1}")
        self._publish({**now, "version": now["version"] + 1, "snapshot": snapshot, "log": []})

    def read(self, version: int | None = None) -> DataFrame:
        """Each key's last version, as of the newest or the given version of the table."""
        now = self.manifest(version)
        parts = ([{**now["snapshot"], "batch": -1}] if now["snapshot"] else []) + now["log"]
        if not parts:
            return self.flat(self.spark.createDataFrame([], self.schema))
        found = None
        for e in parts:
            one = self.spark.read.schema(self.schema).format(self.fmt).load(f"{self.home}/{e['path']}").withColumn("batch", F.lit(e["batch"]))
            found = one if found is None else found.unionByName(one)
        return latest(self.flat(found), self.keys)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders that none of the ``keep`` newest versions names, and older manifests; returns their names."""
        found = [n for n in store.names(self.spark, f"{self.home}/manifest") if n.endswith(".json") and not n.startswith(".")]
        named = set()
        for n in found[-keep:]:
            doc = json.loads(store.read_text(self.spark, f"{self.home}/manifest/{n}"))
            named |= {e["path"] for e in doc["log"]} | ({doc["snapshot"]["path"]} if doc["snapshot"] else set())
        gone = [n for n in store.names(self.spark, self.home) if n.startswith(("batch=", "snapshot=")) and n not in named]
        for n in gone:
            store.remove(self.spark, f"{self.home}/{n}")
        for n in found[:-keep]:
            store.remove(self.spark, f"{self.home}/manifest/{n}")
        return gone
