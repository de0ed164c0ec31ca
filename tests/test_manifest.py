"""The tree of hashes finds one edited row by reading one file, and does not mind how rows are split."""
import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidewatch.sources import manifest


def table(spark, path, rows=3000, files=4):
    df = spark.range(rows).selectExpr("id", "id % 10 as p", "if(id % 7 = 0, null, concat('v', id)) as v")
    df.repartition(files).write.mode("overwrite").partitionBy("p").parquet(path)
    return df


def stored(spark, files, folder):
    """As a caller keeps it; a cached one would be taken for the next listing of the same path."""
    path = f"{folder}/manifest-{uuid.uuid4().hex[:6]}"
    files.write.parquet(path)
    return spark.read.parquet(path)


def test_one_edited_row_is_found_reading_one_file(spark, tmp_path):
    path = str(tmp_path / "a table")
    df = table(spark, path)
    first, read = manifest.updated(spark, path)
    first = stored(spark, first, tmp_path)
    names = glob.glob(f"{path}/*/*.parquet")
    assert read == len(names) == first.count() >= 40
    root = manifest.tree(first).where("level = 'table'").first()
    assert root.n_rows == 3000 and manifest.tree(first).where("level = 'partition'").count() == 10
    assert manifest.updated(spark, path, first)[1] == 0

    victim = sorted(names)[17]
    os.remove(f"{os.path.dirname(victim)}/.{os.path.basename(victim)}.crc")  # the local store's own checksum
    rows = spark.read.parquet(victim).toPandas()
    edited = rows.copy()
    edited.loc[0, "v"] = "edited"
    edited.to_parquet(victim, index=False)
    os.utime(victim, (1, 1))
    second, read = manifest.updated(spark, path, first)
    second = stored(spark, second, tmp_path)
    assert read == 1
    found = manifest.differences(first, second).collect()
    assert [(r.change, r.rows_before, r.rows_after) for r in found] == [("changed", len(rows), len(rows))]
    assert victim.endswith(found[0].file) and found[0].partition == victim.split("/")[-2]
    whole, _ = manifest.updated(spark, path)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, second.collect()))

    # back again: the file was touched, but the table is the same
    rows.to_parquet(victim, index=False)
    third, read = manifest.updated(spark, path, second)
    third = stored(spark, third, tmp_path)
    assert read == 1 and manifest.differences(first, third).count() == 0
    assert tuple(manifest.tree(third).where("level = 'table'").first()) == tuple(root)
    os.remove(victim)
    gone = manifest.differences(first, manifest.updated(spark, path, third)[0]).collect()
    assert [(r.change, r.rows_after) for r in gone] == [("removed", None)]

    # the same rows in other files: no difference
    other = str(tmp_path / "other")
    df.orderBy(F.desc("id")).repartition(2).write.partitionBy("p").parquet(other)
    assert manifest.differences(first, manifest.updated(spark, other)[0]).count() == 0


@pytest.mark.parametrize("named", [0, 10_000])
def test_repeats_nulls_and_empty_tables(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(manifest, "NAMED_FILES", named)
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None), (1, None), (None, "x")], "a int, b string")
    df.coalesce(1).write.parquet(path)
    one, _ = manifest.updated(spark, path)
    one = stored(spark, one, tmp_path)
    assert one.first().partition == "" and one.first().n_rows == 3
    df.limit(0).coalesce(1).write.mode("append").parquet(path)
    two = stored(spark, manifest.updated(spark, path, one)[0], tmp_path)
    assert manifest.differences(one, two).count() == 0
    df.where("a is null").coalesce(1).write.mode("append").parquet(path)
    three, _ = manifest.updated(spark, path, one)
    assert manifest.tree(three).where("level = 'table'").first().n_rows == 4
    assert [(r.change, r.rows_after) for r in manifest.differences(two, three).collect()] == [("added", 1)]
