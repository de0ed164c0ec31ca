"""Data-quality checks: schema, types, domains, verdict, missing values, outliers.

Schema checks read only ``df.schema`` (metadata, no job).  Data checks are one
aggregate pass each; wide results are unpivoted with ``inline``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import constants as K
from tidewatch.functions.exprs import failing, safe_ratio, scalar_row
from tidewatch.operators.ordering import grouped_quantiles
from tidewatch.operators.profile import long_values

FINDING_SCHEMA = T.StructType([
    T.StructField("check_kind", T.StringType(), False),
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("bad_count", T.LongType(), True),
    T.StructField("message", T.StringType(), False),
])


def dtype_name(dt: T.DataType) -> str:
    """pandas-style dtype label for a Spark type."""
    if isinstance(dt, T.DoubleType):
        return "float64"
    if isinstance(dt, T.FloatType):
        return "float32"
    if isinstance(dt, T.LongType):
        return "int64"
    if isinstance(dt, T.IntegerType):
        return "int32"
    if isinstance(dt, (T.ShortType, T.ByteType)):
        return "int16"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "datetime64[ns]"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, T.StringType):
        return "object"
    return dt.simpleString()


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def schema_findings(spark: SparkSession, df: DataFrame,
                    required: Sequence[tuple[str, str]] = tuple(K.REQUIRED_COLUMNS)) -> DataFrame:
    """Q1 + Q2: missing required columns, then wrong kinds of type."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for i, (c, _) in enumerate(required):
        if c not in fields:
            rows.append(("missing", i, c, None, f"missing: {c}"))
    for i, (c, kind) in enumerate(required):
        if c not in fields:
            continue
        dt = fields[c]
        ok = isinstance(dt, T.StringType) if kind == "text" else _is_numeric(dt)
        if not ok:
            rows.append(("type", len(required) + i, c, None, f"{c}: bad dtype {dtype_name(dt)}"))
    return spark.createDataFrame(rows, FINDING_SCHEMA)


def range_findings(df: DataFrame) -> DataFrame:
    """Q3: bad-row count per domain rule (inclusive bounds, NULL = bad), failing rules only."""
    present = set(df.columns)
    rules = []
    base = 2 * len(K.REQUIRED_COLUMNS)
    for i, (c, lo, hi) in enumerate(K.RANGE_RULES):
        if c in present:
            rules.append((base + i, c, failing(F.col(c).between(lo, hi))))
    for j, (c, allowed) in enumerate(K.SET_RULES):
        if c in present:
            rules.append((base + len(K.RANGE_RULES) + j, c, failing(F.col(c).isin(allowed))))
    if not rules:
        return df.sparkSession.createDataFrame([], FINDING_SCHEMA)
    wide = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(f"r{seq}")
                    for seq, _, cond in rules])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit("range").alias("check_kind"), F.lit(seq).alias("seq"), F.lit(c).alias("column_name"),
                 F.col(f"r{seq}").alias("bad_count"))
        for seq, c, _ in rules])))
    return (long.where(F.col("bad_count") > 0)
            .withColumn("message", F.format_string("%s: %d bad", F.col("column_name"), F.col("bad_count")))
            .select(*FINDING_SCHEMA.fieldNames()))


def all_findings(spark: SparkSession, df: DataFrame) -> DataFrame:
    return schema_findings(spark, df).unionByName(range_findings(df))


def verdict(findings: DataFrame) -> DataFrame:
    """Q4: error count, pass/fail and the messages joined in check order."""
    return findings.agg(
        F.count(F.lit(1)).alias("n_errors"),
        (F.count(F.lit(1)) == 0).alias("passed"),
        F.coalesce(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "message"))),
                                            lambda s: s["message"]), "; "), F.lit("")).alias("errors"),
    )


def missing_summary(df: DataFrame) -> DataFrame:
    """Q5: missing count (NULL, or NaN for floating columns), percent and dtype per column."""
    structs = []
    aggs = [F.count(F.lit(1)).alias("__n")]
    for f in df.schema.fields:
        c = F.col(f.name)
        miss = c.isNull() | F.isnan(c) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c.isNull()
        aggs.append(F.count_if(miss).alias(f"m__{f.name}"))
        structs.append((f.name, dtype_name(f.dataType)))
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"m__{name}").alias("missing_count"),
                 safe_ratio(F.col(f"m__{name}") * 100.0, "__n").alias("missing_pct"),
                 F.lit(dt).alias("dtype"))
        for name, dt in structs]))).orderBy(F.desc("missing_count"), "column_name")


def outlier_summary(df: DataFrame, cols: Sequence[str] = tuple(K.NUMERIC_PROFILE_COLUMNS)) -> DataFrame:
    """Q6: IQR fences per column and the share of all rows outside them.

    Quartiles come from one histogram of all columns; the outlier counts are a second
    single pass against that small table (one row per column).
    """
    long = long_values(df, cols)
    q = grouped_quantiles(long, ["feature"], "value", [0.25, 0.75])
    q1, q3, x = F.col("q")[0], F.col("q")[1], F.col("value")
    fences = q.select("feature", q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"),
                      (q1 - (q3 - q1) * 1.5).alias("lower_bound"), (q3 + (q3 - q1) * 1.5).alias("upper_bound"))
    beyond = (x < F.col("lower_bound")) | (x > F.col("upper_bound"))
    keys = fences.columns
    return long.join(F.broadcast(fences), "feature").groupBy(*keys).agg(
        F.count_if(beyond).alias("outlier_count"), (F.count_if(beyond) * 100.0 / F.count(F.lit(1))).alias("outlier_pct"))


def cleanup_report(df: DataFrame, label: str = "left_flag") -> DataFrame:
    """Q7: rows before/after, exact duplicates removed, null labels dropped, blanks → NULL."""
    before = scalar_row(df.agg(F.count(F.lit(1)).alias("n"))).getField("n")
    dedup = df.dropDuplicates()
    kept = F.col(label).isNotNull()
    return dedup.agg(
        before.alias("rows_before"),
        (before - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(~kept).alias("rows_missing_left_removed"),
        F.count_if(kept & (F.col("sales") == "")).alias("blank_sales_to_na"),
        F.count_if(kept & (F.col("salary") == "")).alias("blank_salary_to_na"),
        F.count_if(kept).alias("rows_after"),
    )
