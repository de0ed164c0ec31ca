"""Score scaling, anomaly score, fusion, score attachment and department-week risk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.functions.exprs import scalar_row

KEYS = ["sales", "weekly_ts"]


def minmax_scale(df: DataFrame, col: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """(x - min) / (max - min); a constant column maps to 0.5.

    Global: min/max come from a struct scalar subquery (no single-task window).
    Per group: a grouped aggregate joined back on the group keys.
    """
    x = F.col(col).cast("double")
    if by:
        mm = df.groupBy(*by).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
        joined = df.join(mm, list(by), "left")
        lo, hi = F.col("_lo"), F.col("_hi")
        return joined.withColumn(out, F.when(hi - lo == 0, F.lit(0.5)).otherwise((x - lo) / (hi - lo))) \
            .drop("_lo", "_hi")
    s = scalar_row(df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")))
    return df.withColumn(out, F.when(s.hi - s.lo == 0, F.lit(0.5)).otherwise((x - s.lo) / (s.hi - s.lo)))


def anomaly_score(df: DataFrame, decision_col: str, out: str = "anomaly_score") -> DataFrame:
    """1 − minmax(decision) so that higher means more anomalous."""
    scaled = minmax_scale(df, decision_col, "_mm")
    return scaled.withColumn(out, F.lit(1.0) - F.col("_mm")).drop("_mm")


def violation_decision(dept_week: DataFrame, out: str = "decision") -> DataFrame:
    """Proxy anomaly decision for department-weeks: lower = more anomalous.

    Used where an exact SQL oracle is needed; the fitted isolation forest
    (:mod:`tidewatch.operators.iforest`) produces the same column from a model.
    """
    return dept_week.withColumn(out, -F.col("violation_density"))


def fuse(sup: Column, unsup: Column, weight: float = K.FUSION_WEIGHT_SUPERVISED) -> Column:
    """Weighted fusion w·supervised + (1-w)·unsupervised."""
    return sup * F.lit(weight) + unsup * F.lit(1.0 - weight)


def fuse_max(sup: Column, unsup: Column) -> Column:
    """Fusion by maximum."""
    return F.greatest(sup, unsup)


def attach_dept_score(emp: DataFrame, dept_scores: DataFrame, score_col: str,
                      fill: float = K.ANOMALY_FILL) -> DataFrame:
    """Left join employees ← department-week score; missing → ``fill``.

    Only the score column crosses the join (no duplicated feature columns).
    """
    right = dept_scores.select(*KEYS, score_col)
    return emp.join(right, KEYS, "left").withColumn(score_col, F.coalesce(F.col(score_col), F.lit(fill)))


def scored_employees(hr: DataFrame, dept_week: DataFrame, supervised: str = "score",
                     weight: float = K.FUSION_WEIGHT_SUPERVISED) -> DataFrame:
    """Employee rows with supervised, anomaly, fused and max-fused scores."""
    dw = anomaly_score(violation_decision(dept_week), "decision", "anomaly_score")
    emp = attach_dept_score(hr, dw, "anomaly_score")
    return emp.withColumns({
        "supervised_score": F.col(supervised),
        "fused_score": fuse(F.col(supervised), F.col("anomaly_score"), weight),
        "fused_max_score": fuse_max(F.col(supervised), F.col("anomaly_score")),
    })


def dept_week_risk(scored: DataFrame, score_col: str = "fused_score") -> DataFrame:
    """Mean fused score per department-week (partial aggregation before the shuffle)."""
    return scored.where(F.col("sales").isNotNull() & F.col("weekly_ts").isNotNull()) \
        .groupBy(*KEYS).agg(F.avg(score_col).alias("risk_score"))


def class_weight(df: DataFrame, label: str = "left_flag") -> DataFrame:
    """Positive-class weight max(1, neg / max(pos, 1))."""
    y = F.col(label)
    agg = df.agg(F.count_if(y == 0).alias("neg"), F.count_if(y == 1).alias("pos"))
    return agg.withColumn("scale_pos_weight", F.greatest(
        F.lit(1.0), F.col("neg").cast("double") / F.greatest(F.col("pos"), F.lit(1)).cast("double")))


def pick_model_row(bench: DataFrame, name: str, model_col: str = "model") -> DataFrame:
    """The one benchmark row whose model name equals ``name`` case-insensitively; an error if none or several do."""
    found = bench.where(F.lower(F.col(model_col)) == name.lower()).agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*bench.columns)).alias("row"))
    message = F.format_string(f"%d rows for model {name}, not one", "n")
    return found.select(F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(message)).alias("row")).select("row.*")
