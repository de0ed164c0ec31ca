"""Checksums, fingerprints and the run manifest."""
import glob
import hashlib
import subprocess
import os

from pyspark.sql import functions as F

from tidewatch.sources import files

SF = "/root/testdata/sf0.001"


def test_checksums(spark):
    got = {r.file_name: (r.size_bytes, r.sha256) for r in files.file_checksums(spark, f"{SF}/*.parquet").collect()}
    for path in glob.glob(f"{SF}/*.parquet"):
        raw = open(path, "rb").read()
        assert got[os.path.basename(path)] == (len(raw), hashlib.sha256(raw).hexdigest())


def test_fingerprint_depends_on_content_only(spark):
    df = spark.read.parquet(f"{SF}/nation.parquet")
    first = lambda d: files.dataset_manifest({"t": d}).first()
    assert first(df) == first(df.repartition(3))
    changed = df.withColumn(df.columns[0], F.col(df.columns[0]) + 1)
    assert first(df).hash_xor != first(changed).hash_xor


def test_run_manifest_round_trip(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/region.parquet")
    path = str(tmp_path / "manifest.json")
    files.write_run_manifest({"region": df}, path, {"seed": "42"})
    r = files.read_run_manifest(spark, path).first()
    assert r.dataset == "region" and r.n_rows == df.count() and r.parameters == {"seed": "42"} and r.created_at[:2] == "20"


def test_layers_follow_their_source(spark, tmp_path):
    from tidewatch.plans.layers import materialized
    src = str(tmp_path / "src")
    build = lambda: spark.read.parquet(src)
    spark.range(3).write.parquet(src)
    assert materialized(spark, src, "t", build).count() == 3
    spark.range(2).write.mode("append").parquet(src)
    assert materialized(spark, src, "t", build).count() == 5


def test_checksum_of_a_file_beyond_one_row(spark, tmp_path):
    """3 GB, sparse: more than a row can hold; streamed in chunks."""
    path = tmp_path / "large file%20.bin"
    with open(path, "wb") as f:
        f.write(b"head")
        f.truncate(3 << 30)
        f.seek((3 << 30) - 4)
        f.write(b"tail")
    (tmp_path / "small.bin").write_bytes(b"few")
    want = subprocess.run(["sha256sum", str(path)], capture_output=True, text=True, check=True).stdout.lstrip("\\").split()[0]
    got = {r.size_bytes: r.sha256 for r in files.file_checksums(spark, str(tmp_path)).collect()}
    assert got == {3 << 30: want, 3: hashlib.sha256(b"few").hexdigest()}
