"""Department Performance Index: roll-up, component scores, ranking, KPIs.

Input is the department-week table (already aggregated), so the department
roll-up and the rank window run over one row per department.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.functions.exprs import safe_ratio


def department_rollup(dept_week: DataFrame) -> DataFrame:
    """Unweighted mean of the weekly rows per department."""
    return dept_week.where(F.col("sales").isNotNull()).groupBy("sales").agg(
        F.avg("attrition_rate").alias("attrition_rate"),
        F.avg("average_montly_hours_mean").alias("average_montly_hours_mean"),
        F.avg("satisfaction_level_mean").alias("satisfaction_level_mean"),
        F.avg("headcount").alias("headcount"),
        F.avg("violation_density").alias("violation_density"),
    )


def dpi_leaderboard(dept_week: DataFrame) -> DataFrame:
    """X4 + W2: retention, workload, compliance → weighted DPI, ranked 1..n.

    The roll-up has one row per department, so the maxima are a window over
    that bounded table (the same single partition the rank uses) instead of a
    second pass over the employee rows.  Ties in DPI are broken by department
    name so the rank is deterministic.
    """
    dept = department_rollup(dept_week)
    all_depts = Window.partitionBy()
    max_hours = F.max("average_montly_hours_mean").over(all_depts)
    max_density = F.max("violation_density").over(all_depts)
    w = K.DPI_WEIGHTS
    scored = dept.withColumns({
        "retention_score": F.lit(1.0) - F.col("attrition_rate"),
        "workload_score": (F.lit(1.0) - F.coalesce(safe_ratio("average_montly_hours_mean", max_hours), F.lit(0.0))) * 0.5
        + F.col("satisfaction_level_mean") * 0.5,
        "compliance_score": F.when(max_density > 0, F.lit(1.0) - safe_ratio("violation_density", max_density))
        .otherwise(F.lit(1.0)),
    })
    scored = scored.withColumn(
        "dpi", F.col("retention_score") * w["retention"] + F.col("workload_score") * w["workload"]
        + F.col("compliance_score") * w["compliance"])
    rank_w = Window.orderBy(F.col("dpi").desc(), F.col("sales").asc())
    return scored.select(
        F.row_number().over(rank_w).cast("int").alias("rank"),
        "sales", "dpi", "retention_score", "workload_score", "compliance_score", "headcount",
    ).orderBy("rank")


def dpi_kpis(leaderboard: DataFrame, top_n: int = 5) -> DataFrame:
    """Department count, top performer, mean DPI, and the top-n names in rank order."""
    return leaderboard.agg(
        F.count(F.lit(1)).alias("n_departments"),
        F.min_by("sales", "rank").alias("top_performer"),
        F.avg("dpi").alias("mean_dpi"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= top_n, F.struct("rank", "sales")))),
                        lambda s: s["sales"]), ",").alias("top_departments"),
    )
