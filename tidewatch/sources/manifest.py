"""A manifest of what a parquet table holds, as a tree: multiset hashes by file, by partition and of the whole.

A file's hash is the count, the sum and the xor of its rows' 64-bit hashes, so neither the order of rows nor the way
they are split matters, and the hashes of a partition and of the table are sums over files.  An update
lists the files, reads those whose size or time changed or that are new, and keeps the others' hashes.  Two
manifests are compared from the top: equal roots end it, then only partitions that differ are looked into.

Defined cases: rows that repeat count as often as they are there; NULLs hash like values; an empty table has a root of
no rows; partition columns belong to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HASHES = ["n_rows", "hash_sum", "hash_xor"]
FILE = "partition string, file string, size long, modified timestamp, n_rows long, hash_sum decimal(38,0), hash_xor long"
#: So many changed files are named to the reader one by one; from there on the whole folder is read and joined.
NAMED_FILES = 10_000


def _relative(path: F.Column, root: str) -> F.Column:
    """``path`` below ``root``, without the ways in which a store may begin it."""
    return F.regexp_replace(F.substring_index(F.url_decode(path), root.rstrip("/").split(":")[-1].lstrip("/") + "/", -1), "^/+", "")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """``(partition, file, size, modified)`` of the parquet files below ``path``; nothing is read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
             .select(_relative(F.replace("path", F.lit("%"), F.lit("%25")), path).alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")))
    return files.select(F.regexp_replace("file", "/?[^/]*$", "").alias("partition"), "file", "size", "modified")


def row_hashes(rows: DataFrame, path: str) -> DataFrame:
    """``(file, n_rows, hash_sum, hash_xor)`` of the rows read from below ``path``."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(rows.columns)])
    found = rows.select(_relative(F.col("_metadata.file_path"), path).alias("file"), h.alias("h"))
    return found.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
                                     F.bit_xor("h").alias("hash_xor"))


def updated(spark: SparkSession, path: str, last: DataFrame | None = None) -> tuple[DataFrame, int]:
    """The files' table now, and how many files had to be read.

    ``last`` is an earlier one, read from where it was written (not cached: Spark would take it for the new listing).
    """
    now = listing(spark, path)
    if last is None:
        known, new = None, now
    else:
        same = last.select("file", "size", "modified", *HASHES)
        known = now.join(same, ["file", "size", "modified"]).select("partition", "file", "size", "modified", *HASHES)
        new = now.join(same, ["file", "size", "modified"], "left_anti")
    named = [r.file for r in new.select("file").limit(NAMED_FILES + 1).collect()]
    if not named:
        return (known if known is not None else spark.createDataFrame([], FILE)), 0
    rows = spark.read.parquet(path) if known is None or len(named) > NAMED_FILES else \
        spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/{f}" for f in named])
    zero = [F.coalesce(c, F.lit(0).cast(t)).alias(c) for c, t in zip(HASHES, ("long", "decimal(38,0)", "long"))]
    fresh = new.join(row_hashes(rows, path), "file", "left").select("partition", "file", "size", "modified", *zero)     # a file may hold no row
    out = fresh if known is None else known.unionByName(fresh)
    return out, new.count()


def tree(files: DataFrame) -> DataFrame:
    """``(level, name, n_rows, hash_sum, hash_xor)``: the root, the partitions and the files."""
    total = [F.coalesce(F.sum("n_rows"), F.lit(0).cast("long")).alias("n_rows"), F.coalesce(F.sum("hash_sum"), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").alias("hash_sum"),
             F.coalesce(F.bit_xor("hash_xor"), F.lit(0).cast("long")).alias("hash_xor")]
    root = files.agg(*total).select(F.lit("table").alias("level"), F.lit("").alias("name"), *HASHES)
    parts = files.groupBy("partition").agg(*total).select(F.lit("partition").alias("level"), F.col("partition").alias("name"), *HASHES)
    return root.unionByName(parts).unionByName(files.select(F.lit("file").alias("level"), F.col("file").alias("name"), *HASHES))


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(partition, file, change, rows_before, rows_after)`` of two files' tables, looked for from the top.

    ``change`` is ``added``, ``removed`` or ``changed``.  Where a partition's hashes are equal its rows are, however
    they are split into files, and no file of it is reported.
    """
    def parts(files: DataFrame, name: str) -> DataFrame:
        return files.groupBy("partition").agg(F.struct(F.sum("n_rows"), F.sum("hash_sum"), F.bit_xor("hash_xor")).alias(name))

    unlike = parts(before, "a").join(parts(after, "b"), "partition", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("partition")
    a = before.join(unlike, "partition", "left_semi").select("partition", "file", F.struct(*HASHES).alias("a"))
    b = after.join(unlike, "partition", "left_semi").select("partition", "file", F.struct(*HASHES).alias("b"))
    both = a.join(b, ["partition", "file"], "full").where(~F.col("a").eqNullSafe(F.col("b")))
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed")
    return both.select("partition", "file", change.alias("change"), F.col("a.n_rows").alias("rows_before"), F.col("b.n_rows").alias("rows_after"))
