"""File sources and sinks: CSV/parquet/JSON I/O, prediction files, previews, manifests.

Paths are whatever the caller passes (HDFS, object store, local in tests);
scratch output goes under the shared folder from :func:`tidewatch.session.shared_dir`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources import store

# FIXED VALUES — raw employee CSV schema (header names as delivered)
RAW_SCHEMA = T.StructType([
    T.StructField("satisfaction_level", T.DoubleType()),
    T.StructField("last_evaluation", T.DoubleType()),
    T.StructField("number_project", T.IntegerType()),
    T.StructField("average_montly_hours", T.IntegerType()),
    T.StructField("time_spend_company", T.IntegerType()),
    T.StructField("Work_accident", T.IntegerType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("promotion_last_5years", T.IntegerType()),
    T.StructField("Department", T.StringType()),
    T.StructField("salary", T.StringType()),
])


# --------------------------------------------------------------------- S1 / S2
def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Raw CSV by header name, typed by ``schema`` (no inference pass; bad text is NULL);
    ``Department`` → ``sales``, label ``left`` → ``left_flag``.  Columns may come in any order;
    one that the file lacks is left out, for the missing-column check to report."""
    text = spark.read.option("header", True).csv(path)
    df = text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema if f.name in text.columns])
    if "Department" in df.columns:
        df = df.withColumnRenamed("Department", "sales")
    if "left" in df.columns:
        df = df.withColumnRenamed("left", "left_flag")
    return df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


# --------------------------------------------------------------------- S3 / S4 / S6
def save_df(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write by suffix: ``.csv`` → CSV with header, ``.json``/``.jsonl`` → JSON lines,
    anything else → parquet.  Overwrite mode: a rerun replaces the previous output."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path.endswith(".csv"):
        w.option("header", True).csv(path)
    elif path.endswith(".json") or path.endswith(".jsonl"):
        w.json(path)
    else:
        w.parquet(path)


def write_gold(dept_week: DataFrame, employees: DataFrame, out_dir: str) -> dict[str, str]:
    """Gold layer: department-week partitioned by week, employees as plain parquet."""
    dw_path, emp_path = f"{out_dir}/hr_dept_gold", f"{out_dir}/hr_emp_gold"
    dept_week.write.mode("overwrite").partitionBy("weekly_ts").parquet(dw_path)
    employees.write.mode("overwrite").parquet(emp_path)
    return {"dept": dw_path, "emp": emp_path}


# --------------------------------------------------------------------- S7
def read_threshold(spark: SparkSession, path: str, order: Sequence[str] = ("optimal_threshold", "tau")) -> DataFrame:
    """Threshold from a metrics JSON file, first present key in ``order`` wins."""
    df = spark.read.json(path)
    present = [F.col(k).cast("double") for k in order if k in df.columns]
    return df.select(F.coalesce(*present, F.lit(None).cast("double")).alias("threshold"))


# --------------------------------------------------------------------- S8
def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Predictions file: requires ``y_true``, ``y_prob``; ``dept`` defaults to ``unknown``."""
    df = spark.read.option("header", True).csv(path)
    missing = {"y_true", "y_prob"} - set(df.columns)
    if missing:
        raise ValueError("predictions CSV must have y_true,y_prob")
    dept = F.col("dept") if "dept" in df.columns else F.lit("unknown")
    return df.select(F.col("y_true").cast("int").alias("y_true"), F.col("y_prob").cast("double").alias("y_prob"),
                     dept.alias("dept"))


# --------------------------------------------------------------------- S9
def preview(df: DataFrame, order_by: Sequence[str], n: int = 50) -> DataFrame:
    """First ``n`` rows in key order plus the total row count (a top-k report)."""
    total = df.agg(F.count(F.lit(1)).alias("n")).select(F.struct("n")).scalar().n
    return df.orderBy(*order_by).limit(n).withColumn("n_rows", total)


# --------------------------------------------------------------------- S10 / S11
CHUNK_BYTES = 8 << 20
#: File systems that tasks open through pyarrow; files of others are read by Spark, whole, up to 2 GB.
STREAMED = ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")


def _digests(batches):
    import hashlib

    import pyarrow as pa

    for batch in batches:
        for path, size in zip(*(c.to_pylist() for c in batch.columns)):
            where, name = store.in_task(path)
            digest = hashlib.sha256()
            with where.open_input_stream(name) as f:
                while chunk := f.read(CHUNK_BYTES):
                    digest.update(chunk)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([digest.hexdigest()])],
                                             ["path", "size_bytes", "sha256"])


def file_checksums(spark: SparkSession, path_glob: str) -> DataFrame:
    """SHA-256 of each input file of any size: tasks stream files in chunks of ``CHUNK_BYTES``.

    The listing is Spark's (no content is read for it; empty files are not in it) and deals files to tasks by their size.
    """
    files = spark.read.format("binaryFile").load(path_glob)
    if store.scheme(spark, path_glob) in STREAMED:
        out = files.select("path", "length").mapInArrow(_digests, "path string, size_bytes long, sha256 string")
    else:
        out = files.select("path", F.col("length").alias("size_bytes"), F.sha2(F.col("content"), 256).alias("sha256"))
    return out.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "size_bytes", "sha256")


def dataset_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per dataset: rows, columns, schema JSON and an order-insensitive
    content fingerprint (sum and xor of a per-row 64-bit hash) — one pass each."""
    rows = None
    for name, df in tables.items():
        h = F.xxhash64(*[F.col(c) for c in df.columns])
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"),
                     F.bit_xor(h).alias("hash_xor")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
            F.lit(df.schema.json()).alias("schema_json"), "hash_sum", "hash_xor")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def write_run_manifest(tables: dict[str, DataFrame], path: str, parameters: dict[str, str]) -> None:
    """One JSON document: when the run was, its parameters, and each dataset's manifest row."""
    rows = dataset_manifest(tables)
    doc = rows.agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias("datasets"))     # one entry per dataset
    pairs = [x for k, v in sorted(parameters.items()) for x in (F.lit(k), F.lit(v))]
    doc.select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at"),
               F.create_map(*pairs).alias("parameters") if pairs else F.lit(None).cast("map<string,string>").alias("parameters"),
               "datasets").coalesce(1).write.mode("overwrite").json(path)


def read_run_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's datasets as rows, with the run's time and parameters."""
    schema = ("created_at string, parameters map<string,string>, datasets array<struct<dataset:string,n_rows:bigint,"
              "n_columns:int,schema_json:string,hash_sum:string,hash_xor:bigint>>")
    return spark.read.schema(schema).json(path).select("created_at", "parameters", F.inline("datasets"))
