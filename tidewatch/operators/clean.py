"""Cleaning and row transforms: dedup, coercion, strict drop, row ids, synthetic weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.operators.ordering import DEFAULT_BUCKETS, row_sequence


def dedup(df: DataFrame) -> DataFrame:
    """Exact duplicates on all columns (NULLs compare equal) — one hash aggregate."""
    return df.dropDuplicates()


def coerce(df: DataFrame, numeric_text: Sequence[str] = (), label: str = "left_flag",
           blank_to_null: Sequence[str] = ("sales", "salary")) -> DataFrame:
    """Dedup, text → double (bad text → NULL), drop NULL label, blank text → NULL."""
    out = dedup(df)
    out = out.withColumns({f"{c}_numeric": F.col(c).try_cast("double") for c in numeric_text})
    out = out.where(F.col(label).isNotNull())
    return out.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in blank_to_null if c in out.columns})


def strict(df: DataFrame) -> DataFrame:
    """Drop rows with any NULL (or NaN), then exact duplicates."""
    return df.dropna(how="any").dropDuplicates()


def week_offset(start: str, k: Column) -> Column:
    """``start`` + k weeks as a timestamp without time zone."""
    return F.date_add(F.lit(start).cast("date"), (k * 7).cast("int")).cast("timestamp_ntz")


def synthetic_week(df: DataFrame, order_by: Sequence[str], rows_per_week: int = K.ROWS_PER_WEEK,
                   out: str = "synthetic_ts", start: str = K.SYNTHETIC_WEEK_START,
                   n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """week = start + (row position // rows_per_week) weeks.

    The position follows the declared key order (``order_by``); it comes from the
    two-phase row sequence, never from a single-task window.
    """
    n = max(int(rows_per_week), 1)
    seq = row_sequence(df, order_by, name="_pos", n_buckets=n_buckets)
    return seq.withColumn(out, week_offset(start, F.floor(F.col("_pos") / n))).drop("_pos")


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values in ascending order."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)
