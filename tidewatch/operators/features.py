"""Policy-violation flags, department-week features, lags and employee gold.

Plan shape at scale (employees ≫ department-weeks):

* global thresholds: one histogram and its running counts → struct scalar subquery, inlined as literals;
* flags: narrow projection inside the scan's whole-stage-codegen stage;
* department-week: partial hash aggregate before the exchange on
  (department, week), so a hot department-week collapses map-side;
* lags: window partitioned by department over the *aggregated* table
  (one row per department-week, never employee rows);
* employee gold: left join employees ← department-week on the two keys; AQE
  broadcasts the aggregated side when its measured size is under the broadcast
  threshold and otherwise keeps a sort-merge join with skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.functions.exprs import flag, safe_ratio, scalar_row
from tidewatch.operators.ordering import histogram_quantiles, merged_sketches, quantile_sketches, row_sequence, sketch_quantiles
from tidewatch.operators.profile import long_values

KEYS = ["sales", "weekly_ts"]


# --------------------------------------------------------------------- A8
# FIXED VALUES — name: (column, quantile)
THRESHOLDS = {"p95_hours": ("average_montly_hours", 0.95), "p75_projects": ("number_project", 0.75),
              "p25_satisfaction": ("satisfaction_level", 0.25), "p75_tenure": ("time_spend_company", 0.75),
              "median_hours": ("average_montly_hours", 0.5)}


def threshold_histogram(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, feature, value, cnt)`` of the columns behind the thresholds; histograms add up."""
    long = long_values(df, list(dict.fromkeys(c for c, _ in THRESHOLDS.values())), by)
    return long.where("value is not null").groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("cnt"))


def thresholds_of(hist: DataFrame) -> DataFrame:
    """One row: the thresholds of a histogram ``(feature, value, cnt)``."""
    probs = sorted({p for _, p in THRESHOLDS.values()})
    q = histogram_quantiles(hist, ["feature"], "value", probs)
    return q.agg(*[F.max(F.when(F.col("feature") == c, F.col("q")[probs.index(p)])).alias(name) for name, (c, p) in THRESHOLDS.items()])


def violation_thresholds(df: DataFrame) -> DataFrame:
    """One row: p95 hours, p75 projects, p25 satisfaction, p75 tenure, median hours.

    Exact linear-interpolated percentiles (the pandas default) from one histogram of all
    four columns, whatever the number of distinct values.
    """
    return thresholds_of(threshold_histogram(df))


def threshold_sketches(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, feature, n, sketch)``: mergeable sketches of the columns behind the thresholds."""
    return quantile_sketches(long_values(df, list(dict.fromkeys(c for c, _ in THRESHOLDS.values())), by), [*by, "feature"], "value")


def approximate_thresholds(sketches: DataFrame) -> DataFrame:
    """A8 without a shuffle of values: one row of thresholds within ``rank_error`` of their quantiles.

    ``sketches`` may be of any parts of the table (``threshold_sketches``); they are merged.
    """
    probs = sorted({p for _, p in THRESHOLDS.values()})
    q = sketch_quantiles(merged_sketches(sketches, ["feature"]), ["feature"], probs)
    return q.agg(*[F.max(F.when(F.col("feature") == c, F.col("q")[probs.index(p)])).alias(name) for name, (c, p) in THRESHOLDS.items()])


# --------------------------------------------------------------------- A9
def violation_flags(df: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """Adds the four 0/1 row-level violation flags (NULL comparisons count as 0)."""
    t = scalar_row(thresholds if thresholds is not None else violation_thresholds(df))
    hours = F.col("average_montly_hours")
    return df.withColumns({
        "v1_overtime": flag(hours > t.p95_hours),
        "v2_overload_satisfaction": flag(
            (F.col("number_project") >= t.p75_projects) & (F.col("satisfaction_level") < t.p25_satisfaction)),
        "v3_stagnation": flag(
            (F.col("time_spend_company") >= t.p75_tenure) & (F.col("promotion_last_5years") == 0)
            & (hours > t.median_hours)),
        "v4_post_accident_overwork": flag((F.col("Work_accident") == 1) & (hours > t.p95_hours)),
    })


# ------------------------------------------------------------------ A10/A11
def dept_week_partials(flagged: DataFrame, label: str = "left_flag") -> DataFrame:
    """Mergeable sums and counts per department-week (null keys dropped, as a pandas group-by does)."""
    means = [label, "satisfaction_level", "average_montly_hours", "time_spend_company"]
    return (
        flagged.where(F.col("sales").isNotNull() & F.col("weekly_ts").isNotNull())
        .groupBy(*KEYS)
        .agg(*[F.sum(c).alias(f"{c}__sum") for c in means], *[F.count(c).alias(f"{c}__n") for c in means],
             *[F.sum(v).cast("bigint").alias(f"{v}_sum") for v in K.VIOLATION_FLAGS],
             F.count("EmployeeID").alias("headcount"))
    )


def finished(partials: DataFrame, label: str = "left_flag") -> DataFrame:
    """The department-week features of partials, one row per department-week."""
    mean = lambda c: safe_ratio(f"{c}__sum", f"{c}__n")
    total = sum((F.col(f"{v}_sum") for v in K.VIOLATION_FLAGS), F.lit(0))
    return partials.select(
        *KEYS, F.col(f"{label}__sum").cast("bigint").alias("leavers"), mean(label).alias("attrition_rate"),
        mean("satisfaction_level").alias("satisfaction_level_mean"), mean("average_montly_hours").alias("average_montly_hours_mean"),
        mean("time_spend_company").alias("time_spend_company_mean"), *[f"{v}_sum" for v in K.VIOLATION_FLAGS], "headcount",
        safe_ratio(total, "headcount").alias("violation_density"))


def dept_week_features(flagged: DataFrame, label: str = "left_flag") -> DataFrame:
    """Department-week aggregate."""
    return finished(dept_week_partials(flagged, label), label)


# --------------------------------------------------------------------- W1
def add_lags(dept_week: DataFrame, cols: Sequence[str] = tuple(K.LAGGED_COLUMNS)) -> DataFrame:
    """Previous *present* week's value per department (row lag, not calendar lag).

    The window is partitioned by department and runs over the aggregated table,
    whose size is departments × weeks, independent of the employee count.
    """
    w = Window.partitionBy("sales").orderBy("weekly_ts")
    return dept_week.withColumns({f"{c}_lag1": F.lag(c, 1).over(w) for c in cols})


def dept_week_gold(hr: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """Thresholds → flags → department-week aggregate → lags (19 columns).

    ``thresholds`` may be a stored row of ``violation_thresholds(hr)``.
    """
    flagged = violation_flags(hr, thresholds if thresholds is not None else violation_thresholds(hr))
    return add_lags(dept_week_features(flagged))


# ------------------------------------------------------------------ T7–T9
def category_levels(df: DataFrame, col: str, max_levels: int = 1000) -> list[str]:
    """Distinct non-null categories, sorted — a small fitted vocabulary for dense one-hot columns.

    Dense columns end at ``max_levels``; ``wide_vocabulary`` and ``sparse_one_hot`` take any number.
    """
    rows = (df.where(F.col(col).isNotNull()).select(col).distinct()
            .orderBy(col).limit(max_levels + 1).collect())
    levels = [r[0] for r in rows]
    if len(levels) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} categories: use sparse_one_hot")
    return levels


def wide_vocabulary(df: DataFrame, col: str, slots: int | None = None) -> DataFrame:
    """``(value, n, slot)``: non-null categories by falling count, then value; the first ``slots`` of them, or all.

    Counts collapse map-side, so a category of a third of the rows is one row a task; slots are
    numbered by a two-phase prefix sum, so any number of categories will do.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if slots is not None:
        counts = counts.orderBy(F.desc("n"), "value").limit(slots)
    return row_sequence(counts.withColumn("_less", -F.col("n")), ["_less", "value"], "slot").select("value", "n", "slot")


def sparse_one_hot(df: DataFrame, col: str, vocabulary: DataFrame, out: str) -> DataFrame:
    """``df`` with a sparse vector column ``out``: one slot a category, and a last one for all others and NULL.

    The vocabulary meets rows by a join that adaptive execution broadcasts where it is small and splits
    where a category is hot.  The vector holds one entry whatever the number of slots.
    """
    size = vocabulary.agg(F.coalesce(F.max("slot") + 1, F.lit(0))).first()[0]
    slots = vocabulary.select(F.col("value").alias("_value"), F.col("slot").cast("double").alias("_slot"))
    found = df.join(slots, F.col(col) == F.col("_value"), "left").withColumn("_slot", F.coalesce("_slot", F.lit(float(size))))
    encoder = OneHotEncoder(inputCol="_slot", outputCol=out, dropLast=False).fit(df.sparkSession.range(1).select(F.lit(float(size)).alias("_slot")))
    return encoder.transform(found).drop("_value", "_slot")


def employee_features(df: DataFrame, dept_levels: Sequence[str], variant: bool = False) -> DataFrame:
    """Salary ordinal, two interaction terms, department one-hot (``dept_<level>``)."""
    mapping = K.SALARY_ORDINAL_VARIANT if variant else K.SALARY_ORDINAL
    salary_map = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = df.withColumns({
        "salary_ord": salary_map[F.col("salary")].cast("int"),
        "satisfaction_x_eval": F.col("satisfaction_level") * F.col("last_evaluation"),
        "hours_x_projects": (F.col("average_montly_hours") * F.col("number_project")).cast("bigint"),
    })
    return out.withColumns({
        f"dept_{lvl}": F.when(F.col("sales") == lvl, 1).otherwise(0).cast("int") for lvl in dept_levels
    })


# --------------------------------------------------------------------- T10
def infer_department(df: DataFrame, dept_cols: Sequence[str], out: str = "sales_inferred") -> DataFrame:
    """Inverse one-hot: first set ``dept_*`` column wins; ``unknown`` if none is set."""
    picks = [F.when(F.col(c) == 1, F.lit(c[len("dept_"):])) for c in dept_cols]
    return df.withColumn(out, F.coalesce(*picks, F.lit("unknown")))


# --------------------------------------------------------------------- J1
def employee_gold(hr: DataFrame, dept_week: DataFrame, dept_levels: Sequence[str]) -> DataFrame:
    """Employees left-joined to their department-week features, plus row features."""
    joined = hr.join(dept_week, KEYS, "left")
    return employee_features(joined, dept_levels)


# --------------------------------------------------------------------- A12
def dept_week_fixed_rules(df: DataFrame, label: str = "left_flag") -> DataFrame:
    """Variant aggregate: mean/std of five columns, sums, distinct headcount,
    fixed-threshold flags on the means (NaN/NULL comparisons count as 0)."""
    cols = K.NUMERIC_PROFILE_COLUMNS
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    dw = (
        df.where(F.col("sales").isNotNull() & F.col("weekly_ts").isNotNull())
        .groupBy(*KEYS)
        .agg(*aggs,
             F.sum("Work_accident").cast("bigint").alias("Work_accident_sum"),
             F.sum("promotion_last_5years").cast("bigint").alias("promotion_last_5years_sum"),
             F.sum(label).cast("bigint").alias(f"{label}_sum"),
             F.count(label).alias(f"{label}_count"),
             F.countDistinct("EmployeeID").alias("EmployeeID_nunique"))
    )
    dw = dw.withColumns({
        "leavers": F.col(f"{label}_sum"),
        "headcount": F.col("EmployeeID_nunique"),
        "attrition_rate": safe_ratio(f"{label}_sum", "EmployeeID_nunique"),
        "v1_overtime_sum": flag(F.col("average_montly_hours_mean") > K.FIXED_RULE_HOURS),
        "v2_low_satisfaction_sum": flag(F.col("satisfaction_level_mean") < K.FIXED_RULE_SATISFACTION),
        "v3_stagnation_sum": flag((F.col("time_spend_company_mean") > K.FIXED_RULE_TENURE)
                                  & (F.col("promotion_last_5years_sum") == 0)),
        "v4_overload_sum": flag(F.col("number_project_mean") > K.FIXED_RULE_PROJECTS),
    })
    total = (F.col("v1_overtime_sum") + F.col("v2_low_satisfaction_sum")
             + F.col("v3_stagnation_sum") + F.col("v4_overload_sum"))
    return dw.withColumn("violation_density", safe_ratio(total, "headcount"))
