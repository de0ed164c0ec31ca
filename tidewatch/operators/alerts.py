"""Alerts: top drivers, alert records, notices, employee alerts, sanitizing, summaries.

Alerts are built per department-week with column expressions; the weekly
replay loop of a notebook becomes one projection over the whole table (batch)
or over each micro-batch (see :mod:`tidewatch.streaming.weekly`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.functions import text as TX
from tidewatch.functions.exprs import col_, rounded_units

KEYS = ["sales", "weekly_ts"]
CONTEXT_COLUMNS = ["headcount", "leavers", "attrition_rate", "satisfaction_level_mean",
                   "average_montly_hours_mean", "time_spend_company_mean", "v1_overtime_sum",
                   "v2_overload_satisfaction_sum", "v3_stagnation_sum", "v4_post_accident_overwork_sum",
                   "violation_density"]


def rounded(c, digits: int) -> Column:
    """``c`` to ``digits`` decimals, exact ties to even (see :func:`rounded_units`)."""
    x = F.round(col_(c).cast("double"), 9)
    return F.signum(x) * rounded_units(c, digits) / float(10 ** digits)


def top_drivers(df: DataFrame, out: str = "top_drivers") -> DataFrame:
    """L1: rule hits in fixed order, first five; the fallback label when none hit."""
    ops = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b}
    present = set(df.columns)
    hits = []
    for name, col, op, thr in K.DRIVER_RULES:
        if col not in present:
            continue
        # compare the value rounded to 9 decimals: a mean lying on a rule boundary
        # must not flip with the order in which its sum was accumulated
        v = F.round(F.col(col).cast("double"), 9)
        hits.append(F.when(F.coalesce(ops[op](v, F.lit(thr)), F.lit(False)), F.lit(name)))
    arr = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return df.withColumn(out, F.when(F.size(arr) == 0, F.array(F.lit(K.DRIVER_FALLBACK)))
                         .otherwise(F.slice(arr, 1, K.MAX_DRIVERS)))


def alert_context(risk: DataFrame, dept_week: DataFrame) -> DataFrame:
    """Department-week risk left-joined to its context columns."""
    ctx = dept_week.select(*KEYS, *[c for c in CONTEXT_COLUMNS if c in dept_week.columns])
    return risk.join(ctx, KEYS, "left")


def alert_records(ctx: DataFrame, tau: Column) -> DataFrame:
    """L2: one alert per department-week (warning = risk > tau, unrounded)."""
    d = top_drivers(ctx)
    return d.select(
        F.col("sales").alias("dept"),
        F.date_format("weekly_ts", "yyyy-MM-dd").alias("weekly_ts"),
        F.col("headcount").cast("bigint").alias("headcount"),
        F.col("leavers").cast("bigint").alias("leavers"),
        F.col("attrition_rate").cast("double").alias("attrition_rate"),
        rounded("risk_score", 4).alias("risk_score"),
        rounded(tau, 4).alias("threshold"),
        "top_drivers",
        (F.col("risk_score") > tau).alias("warning"),
        F.lit(K.ALERT_NOTE).alias("notes"),
    )


def _sanitized(alerts: DataFrame) -> list[tuple[str, Column]]:
    out = []
    for f in alerts.schema.fields:
        if f.name not in K.ALERT_ALLOWLIST:
            continue
        t = f.dataType.typeName()
        if t == "string":
            out.append((f.name, TX.clip_text(F.col(f.name))))
        elif t == "array":
            out.append((f.name, TX.clip_list(F.col(f.name))))
        elif t == "map":
            out.append((f.name, TX.clip_map(F.col(f.name))))
        else:
            out.append((f.name, F.col(f.name)))
    return out


def sanitize(alerts: DataFrame) -> DataFrame:
    """L5 + L6: allow-listed fields only; text clipped, lists / maps trimmed to 20 clipped items."""
    return alerts.select(*[e.alias(n) for n, e in _sanitized(alerts)])


def with_summary(alerts: DataFrame, out: str = "summary") -> DataFrame:
    """L8 + L9: templated advisory text built from the sanitized alert fields."""
    pairs = dict(_sanitized(alerts))

    def c(name):
        return pairs.get(name, F.lit(None))

    return alerts.withColumn(out, TX.summary_text(
        c("dept"), c("weekly_ts"), c("risk_score"), c("threshold"), c("warning"), c("headcount"),
        c("leavers"), c("attrition_rate"), c("top_drivers"), c("notes")))


def summary_lines(dept, week, drivers) -> Column:
    """Non-blank lines of the summary for (dept, week, drivers) with warning on."""
    text = TX.summary_text(TX.clip_text(dept), TX.clip_text(week), F.lit(None), F.lit(None), F.lit(True),
                           F.lit(None), F.lit(None), F.lit(None), TX.clip_list(drivers), F.lit(None))
    return TX.non_blank_lines(text)


def notices(risk: DataFrame, tau: Column) -> DataFrame:
    """L3: short weekly notice per department."""
    return risk.select(F.col("sales").alias("dept"), F.date_format("weekly_ts", "yyyy-MM-dd").alias("week"),
                       rounded("risk_score", 4).alias("score"), (F.col("risk_score") > tau).alias("notice"))


def employee_alerts(scored: DataFrame, tau: Column, score: str = "fused_score") -> DataFrame:
    """L4: employees above a fraction of the threshold; HIGH above it, else MEDIUM.

    The emission time is added by the caller (``current_timestamp()``) when
    alerts are published; it is left out here so results are reproducible.
    """
    s = F.col(score)
    return scored.where(s > tau * K.EMPLOYEE_ALERT_FRACTION).select(
        F.col("EmployeeID").alias("employee_id"), F.col("sales").alias("department"),
        F.date_format("weekly_ts", "yyyy-MM-dd").alias("week"), s.cast("double").alias("fused_score"),
        tau.cast("double").alias("threshold"),
        F.when(s > tau, F.lit("HIGH")).otherwise(F.lit("MEDIUM")).alias("risk_level"),
        (s > tau).alias("action_required"))
