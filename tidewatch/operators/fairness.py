"""Group fairness: demographic parity, equalized odds, audit metrics and gaps.

Every metric is one ``groupBy(group)`` aggregate over the scored rows (partial
aggregation, so a group holding a third of the rows costs no more than any
other); overall rates are a one-row aggregate inlined as a scalar subquery.
Output is long: one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.functions.exprs import fixed_decimals, nan_to_null, safe_ratio, scalar_row, zero_if_undefined

# FIXED VALUES — report wording per group dimension
BIAS_ALERT = {
    "department": "ALERT: Department bias detected. Max parity difference: ",
    "salary": "ALERT: Salary-based bias detected. Max parity difference: ",
}
ALL_CLEAR = "No significant bias detected. Model meets fairness criteria."


def demographic_parity(df: DataFrame, group: str, pred: str) -> DataFrame:
    """Positive rate per group, absolute gap to the overall rate, group size.

    One pass: the overall rate is the groups' sums over their sizes.
    """
    p = F.col(pred).cast("double")
    g = df.groupBy(group).agg(F.sum(p).alias("_pos"), F.count(p).alias("_of"), F.count(F.lit(1)).alias("sample_size"))
    rate = safe_ratio(F.col("_pos"), F.col("_of"))
    groups = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)      # one row per group
    overall = safe_ratio(F.sum("_pos").over(groups), F.sum("_of").over(groups))
    return g.select(group, rate.alias("positive_rate"), F.abs(rate - overall).alias("parity_difference"), "sample_size")


def _count_columns(label: str, pred: str) -> list[Column]:
    y, p = F.col(label), F.col(pred)
    return [F.count(F.lit(1)).alias("n"),
            F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
            F.sum(p.cast("double")).alias("pos"), F.count(p).alias("of_pos"),
            F.sum(y.cast("double")).alias("base"), F.count(y).alias("of_base")]


def equalized_odds(df: DataFrame, group: str, label: str, pred: str) -> DataFrame:
    """TPR, FPR, accuracy per group; groups with a single class are skipped."""
    c = df.groupBy(group).agg(*_count_columns(label, pred))
    both = (F.col("tp") + F.col("fn") > 0) & (F.col("fp") + F.col("tn") > 0)
    return c.where(both).select(
        group,
        zero_if_undefined(F.col("tp"), F.col("tp") + F.col("fn")).alias("true_positive_rate"),
        zero_if_undefined(F.col("fp"), F.col("fp") + F.col("tn")).alias("false_positive_rate"),
        safe_ratio(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"))


def _summaries(df: DataFrame, dimensions: dict[str, str], label: str, pred: str, limit: float) -> DataFrame:
    """N3 for several group columns in one pass: rows dealt once per dimension, counted per group, summed."""
    deal = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(c).cast("string").alias("g"))
                               for d, c in dimensions.items()]))
    groups = (df.select(label, pred, deal.alias("_d")).groupBy(F.col("_d.dimension").alias("dimension"), F.col("_d.g").alias("g"))
              .agg(*_count_columns(label, pred)))
    overall = Window.partitionBy("dimension")              # one row per group
    rate = safe_ratio(F.sum("pos").over(overall), F.sum("of_pos").over(overall))
    groups = groups.withColumn("gap", F.abs(safe_ratio(F.col("pos"), F.col("of_pos")) - rate))
    return groups.groupBy("dimension").agg(
        safe_ratio(F.sum("tp") + F.sum("tn"), F.sum("n")).alias("accuracy"),
        safe_ratio(F.sum("pos"), F.sum("of_pos")).alias("positive_rate"),
        safe_ratio(F.sum("base"), F.sum("of_base")).alias("base_rate"),
        F.max("gap").alias("max_parity_difference"),
        (F.max("gap") > F.lit(limit)).alias("fairness_violation"))


def fairness_summary(df: DataFrame, group: str, label: str, pred: str,
                     limit: float = K.PARITY_LIMIT) -> DataFrame:
    """Overall accuracy, positive and base rate, max parity gap, violation flag; one pass."""
    return _summaries(df, {group: group}, label, pred, limit).drop("dimension")


def bias_report(df: DataFrame, label: str, pred: str, dimensions: dict[str, str],
                limit: float = K.PARITY_LIMIT) -> DataFrame:
    """One row per dimension with its max gap and alert text; an all-clear row
    when no dimension violates the limit.  One pass over the rows; what is collected is a
    row per dimension."""
    alert = F.coalesce(*[F.when(F.col("dimension") == d, F.lit(BIAS_ALERT[d])) for d in dimensions])
    rows = _summaries(df, dimensions, label, pred, limit).select(
        "dimension", "max_parity_difference", "fairness_violation",
        F.when(F.col("fairness_violation"), F.concat(alert, fixed_decimals(F.col("max_parity_difference"), 3))).alias("recommendation"))
    clear_row = F.array(F.struct(F.lit("all").alias("dimension"),
                                 F.lit(None).cast("double").alias("max_parity_difference"),
                                 F.lit(False).alias("fairness_violation"),
                                 F.lit(ALL_CLEAR).alias("recommendation")))
    found = rows.agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias("r"),
                     F.count_if("fairness_violation").alias("v"))
    return found.select(F.inline(F.when(F.col("v") == 0, F.concat("r", clear_row)).otherwise(F.col("r"))))


def _audit_cols(c: DataFrame, brier: Column) -> list[Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rec = zero_if_undefined(tp, tp + fn)
    return [
        zero_if_undefined(tp + fn, F.col("n")).alias("prevalence"),
        rec.alias("recall"), (F.lit(1.0) - rec).alias("fnr"),
        zero_if_undefined(tp, tp + fp).alias("precision"),
        (F.col("fp").cast("double") / F.greatest(F.col("fp") + F.col("tn"), F.lit(1)).cast("double")).alias("fpr"),
        brier.alias("brier"),
    ]


def audit_group_metrics(df: DataFrame, group: str, label: str, prob: str, tau: Column | float,
                        inclusive: bool = True) -> DataFrame:
    """N, prevalence, recall, FNR, precision, FPR (denominator max(neg,1)), Brier per group."""
    t = tau if isinstance(tau, Column) else F.lit(float(tau))
    p = nan_to_null(prob)                                   # no score passes no threshold
    scored = df.where(F.col(label).isNotNull()).withColumn("_yhat", F.when(p >= t if inclusive else p > t, 1).otherwise(0))
    y = F.col(label).cast("double")
    sq = (p - y) * (p - y)
    c = scored.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col(label) == 1) & (F.col("_yhat") == 1)).alias("tp"),
        F.count_if((F.col(label) == 0) & (F.col("_yhat") == 1)).alias("fp"),
        F.count_if((F.col(label) == 1) & (F.col("_yhat") == 0)).alias("fn"),
        F.count_if((F.col(label) == 0) & (F.col("_yhat") == 0)).alias("tn"),
        F.when(F.min(label) != F.max(label), F.avg(sq)).alias("_brier"))
    return c.select(group, "n", *_audit_cols(c, F.col("_brier")))


def audit_overall(df: DataFrame, label: str, prob: str, tau: Column | float, inclusive: bool = True) -> DataFrame:
    """The same metrics over all rows."""
    one = df.withColumn("_all", F.lit("all"))
    return audit_group_metrics(one, "_all", label, prob, tau, inclusive).drop("_all", "n", "prevalence")


def fnr_gap(group_metrics: DataFrame, limit: float = K.FNR_GAP_LIMIT) -> DataFrame:
    """Max − min FNR over groups and the pass/fail flag."""
    g = group_metrics.agg((F.max("fnr") - F.min("fnr")).alias("fnr_gap"))
    return g.withColumn("failed", F.coalesce(F.col("fnr_gap") > F.lit(limit), F.lit(False)))


def audit_report_json(df: DataFrame, group: str, label: str, prob: str, tau: Column,
                      fn_weight: float = K.FN_WEIGHT) -> DataFrame:
    """The audit as one JSON document (tau, weight, overall, per-group list, gaps)."""
    per = audit_group_metrics(df, group, label, prob, tau)
    per_list = scalar_row(per.agg(F.array_sort(F.collect_list(F.struct(*per.columns))).alias("g"))).g
    ov = audit_overall(df, label, prob, tau)
    gap = scalar_row(fnr_gap(per)).fnr_gap
    return ov.select(F.to_json(F.struct(
        tau.alias("tau"), F.lit(float(fn_weight)).alias("fn_weight"),
        F.struct(*ov.columns).alias("overall"), per_list.alias("per_group"),
        F.struct(gap.alias("fnr_gap")).alias("gaps"))).alias("report"))


def parse_audit_report(reports: DataFrame, group: str) -> DataFrame:
    """The report's metrics as rows: the overall ones (``group`` = overall, no size) and one per group."""
    metrics = "recall double, fnr double, precision double, fpr double, brier double"
    schema = (f"tau double, fn_weight double, overall struct<{metrics.replace(' double', ':double')}>, "
              f"per_group array<struct<{group}:string,n:bigint,prevalence:double,{metrics.replace(' double', ':double').replace(', ', ',')}>>")
    r = reports.select(F.from_json("report", schema).alias("r"))
    names = ["recall", "fnr", "precision", "fpr", "brier"]
    whole = F.struct(F.lit("overall").alias(group), F.lit(None).cast("bigint").alias("n"), *[F.col(f"r.overall.{m}").alias(m) for m in names])
    groups = F.transform("r.per_group", lambda g: F.struct(g[group].alias(group), g["n"].alias("n"), *[g[m].alias(m) for m in names]))
    return r.select("r.tau", "r.fn_weight", F.inline(F.concat(F.array(whole), groups)))
