"""Profiling aggregates: class balance, group rates, correlations, describe, group stats.

Each profile is a single aggregate pass (partial aggregation before one
exchange); wide results are turned long with ``inline(array(struct…))`` inside
the same stage instead of N separate scans unioned together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.operators.ordering import grouped_quantiles


def class_balance(df: DataFrame, label: str = "left_flag") -> DataFrame:
    """A1: rows per label value (null label kept as its own row)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


def rate_by(df: DataFrame, group: str, label: str = "left_flag", keep_null: bool = True) -> DataFrame:
    """A2: mean label per group; the NULL group is kept unless ``keep_null=False``."""
    src = df if keep_null else df.where(F.col(group).isNotNull())
    return src.groupBy(group).agg(F.avg(label).alias("attrition_rate")).orderBy(F.desc("attrition_rate"), group)


def rate_by_salary(df: DataFrame, label: str = "left_flag") -> DataFrame:
    """A3: salary rates with the display order low, medium, high, then the rest."""
    order = F.coalesce(*[F.when(F.col("salary") == lvl, F.lit(i + 1))
                         for i, lvl in enumerate(K.SALARY_LEVELS)], F.lit(len(K.SALARY_LEVELS) + 1))
    return rate_by(df, "salary", label).withColumn("salary_order", order.cast("int")).orderBy("salary_order", "salary")


def correlation_matrix(df: DataFrame, cols: Sequence[str] = tuple(K.CORRELATION_COLUMNS)) -> DataFrame:
    """A4: Pearson r for every column pair (a before b in list order), one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                    for a, b in pairs])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("r"))
        for a, b in pairs])))


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, feature, value)``: the columns' values below each other, as doubles, in one pass."""
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.inline(values))


def numeric_describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: count, mean, sample std, min, quartiles (exact, linear), max per column, in the given order."""
    long = long_values(df, cols)
    x = F.col("value")
    moments = long.groupBy("feature").agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                                          F.min(x).alias("min"), F.max(x).alias("max"))
    q = grouped_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75])
    place = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("feature"))
    return moments.join(q, "feature", "left").orderBy(place).select(
        "feature", "count", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"), "max")


def grouped_summary(df: DataFrame, by: str, cols: Sequence[str] = tuple(K.NUMERIC_PROFILE_COLUMNS)) -> DataFrame:
    """Mean / median / sample std per group (NULL group dropped, as in a pandas group-by), by group."""
    known = df.where(F.col(by).isNotNull())
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}_mean"), F.stddev_samp(x).alias(f"{c}_std")]
    medians = grouped_quantiles(long_values(known, cols, [by]), [by, "feature"], "value", [0.5])
    wide = medians.groupBy(by).agg(*[F.max(F.when(F.col("feature") == c, F.col("q")[0])).alias(f"{c}_median") for c in cols])
    out = known.groupBy(by).agg(*aggs).join(wide, by, "left")
    return out.orderBy(by).select(by, *[f"{c}_{m}" for c in cols for m in ("mean", "median", "std")])


def top_rates(df: DataFrame, group: str = "sales", label: str = "left_flag", n: int = 5) -> DataFrame:
    """The n groups with the highest rate (name breaks ties); a top-k report."""
    rates = rate_by(df, group, label, keep_null=False)
    top = rates.orderBy(F.col("attrition_rate").desc(), F.col(group).asc()).limit(n)
    w = Window.orderBy(F.col("attrition_rate").desc(), F.col(group).asc())
    return top.withColumn("rank", F.row_number().over(w).cast("int"))

