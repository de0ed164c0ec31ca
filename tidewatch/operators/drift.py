"""Drift between two periods of the same table, batch verdicts and a promotion gate.

Both periods are read in one pass: conditional aggregates per period replace
two scans and a join; category shares use conditional counts per category, so
categories missing in one period get a zero share without a full outer join, and distribution
distances come from one merged histogram of both periods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.functions.exprs import nan_to_null, safe_ratio, scalar_row
from tidewatch.operators.ordering import running_sums

BASE, CUR = "baseline", "current"
PSI_EPS = 1e-6

# FIXED VALUES — default action policy (the thresholds are parameters)
POLICY = [("high", "retrain and re-validate"), ("moderate", "review features and thresholds"),
          ("low", "monitor")]


def split_periods(df: DataFrame, ts_col: str, cut: str, out: str = "period") -> DataFrame:
    """Label rows before ``cut`` as baseline and the rest as current."""
    return df.withColumn(out, F.when(F.col(ts_col) < F.lit(cut).cast("timestamp_ntz"), F.lit(BASE))
                         .otherwise(F.lit(CUR)))


def _in(period: str, x: Column) -> Column:
    return F.when(F.col("period") == period, x)


def numeric_drift(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean / sample std per period, mean difference, relative change, std ratio."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(_in(BASE, x)).alias(f"{c}__bm"), F.stddev_samp(_in(BASE, x)).alias(f"{c}__bs"),
                 F.avg(_in(CUR, x)).alias(f"{c}__cm"), F.stddev_samp(_in(CUR, x)).alias(f"{c}__cs")]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__bm").alias("baseline_mean"),
                 F.col(f"{c}__cm").alias("current_mean"), F.col(f"{c}__bs").alias("baseline_std"),
                 F.col(f"{c}__cs").alias("current_std"),
                 (F.col(f"{c}__cm") - F.col(f"{c}__bm")).alias("mean_diff"),
                 safe_ratio(F.col(f"{c}__cm") - F.col(f"{c}__bm"), F.abs(F.col(f"{c}__bm"))).alias("rel_change"),
                 safe_ratio(F.col(f"{c}__cs"), F.col(f"{c}__bs")).alias("std_ratio"))
        for c in cols])))


def category_drift(df: DataFrame, col: str) -> DataFrame:
    """Share per category in each period and its population-stability term."""
    counts = df.groupBy(F.coalesce(F.col(col), F.lit("<null>")).alias("category")).agg(
        F.count_if(F.col("period") == BASE).alias("n_base"), F.count_if(F.col("period") == CUR).alias("n_cur"))
    tot = scalar_row(counts.agg(F.sum("n_base").alias("b"), F.sum("n_cur").alias("c")))
    b = F.greatest(safe_ratio(F.col("n_base"), tot.b), F.lit(PSI_EPS))
    c = F.greatest(safe_ratio(F.col("n_cur"), tot.c), F.lit(PSI_EPS))
    return counts.select(
        F.lit(col).alias("feature"), "category", "n_base", "n_cur",
        safe_ratio(F.col("n_base"), tot.b).alias("baseline_share"),
        safe_ratio(F.col("n_cur"), tot.c).alias("current_share"),
        ((c - b) * F.log(c / b)).alias("psi_term"))


def rate_drift(df: DataFrame, group: str, label: str, score: str, anomaly: str, anomaly_cut: float = 0.5) -> DataFrame:
    """D3: attrition rate, mean score and anomaly-flag rate per group in both periods."""
    y, s = F.col(label).cast("double"), F.col(score).cast("double")
    a = F.when(F.col(anomaly) >= anomaly_cut, 1.0).otherwise(0.0)
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.avg(_in(BASE, y)).alias("attrition_base"), F.avg(_in(CUR, y)).alias("attrition_cur"),
        F.avg(_in(BASE, s)).alias("score_base"), F.avg(_in(CUR, s)).alias("score_cur"),
        F.avg(_in(BASE, a)).alias("anomaly_rate_base"), F.avg(_in(CUR, a)).alias("anomaly_rate_cur"))
    return g.withColumns({
        "attrition_shift": F.col("attrition_cur") - F.col("attrition_base"),
        "score_shift": F.col("score_cur") - F.col("score_base"),
        "anomaly_rate_shift": F.col("anomaly_rate_cur") - F.col("anomaly_rate_base"),
    })


#: sqrt(-ln(0.05 / 2) / 2): the two-sample Kolmogorov-Smirnov factor at a 5 % error level.
KS_FACTOR = 1.3581015157406195


def distribution_drift(df: DataFrame, by: Sequence[str], value: str, factor: float = KS_FACTOR) -> DataFrame:
    """D3: how far the whole distribution of ``value`` moved between the periods, per group.

    ``ks`` is the largest gap between the two distribution functions and ``ks_at`` the smallest value with
    that gap; ``wasserstein`` is the area between them (mean distance the values moved);
    ``shifted`` says whether ``ks`` is above ``ks_critical = factor * sqrt((n + m) / (n * m))``.

    Both periods collapse into one histogram of (group, value), so a value that a third of
    the rows share costs one row, and two running sums over it give both functions at every value.
    The area needs no next value: with D the gap after a value, it is the sum of
    ``value * (|D before| - |D after|)``.

    Rows with a NULL group key or a NULL / NaN value are left out.  A group without rows in one
    period has NULL distances; an empty table gives no groups.
    """
    keys = [F.col(k) for k in by]
    x = nan_to_null(F.col(value).cast("double"))
    rows = df.select(*keys, "period", x.alias("_x")).where(F.col("_x").isNotNull())
    for k in by:
        rows = rows.where(F.col(k).isNotNull())
    hist = rows.groupBy(*by, "_x").agg(F.count_if(F.col("period") == BASE).alias("_b"), F.count_if(F.col("period") == CUR).alias("_c"))
    cum = running_sums(hist, [*by, "_x"], ["_b", "_c"], prefix="_to")
    ends = cum.groupBy(*by).agg(F.min(F.col("_to_b") - F.col("_b")).alias("_b0"), F.min(F.col("_to_c") - F.col("_c")).alias("_c0"),
                                F.sum("_b").alias("n_base"), F.sum("_c").alias("n_cur"))
    both = cum.join(ends, list(by)) if by else cum.crossJoin(F.broadcast(ends))              # one row without groups
    base, cur = F.col("_to_b") - F.col("_b0"), F.col("_to_c") - F.col("_c0")
    after = safe_ratio(base, "n_base") - safe_ratio(cur, "n_cur")
    before = safe_ratio(base - F.col("_b"), "n_base") - safe_ratio(cur - F.col("_c"), "n_cur")
    gap = F.abs(F.col("_after"))
    out = both.withColumns({"_after": after, "_before": before}).groupBy(*by, "n_base", "n_cur").agg(
        F.max(gap).alias("ks"),
        F.max(F.when(gap.isNotNull(), F.struct(F.round(gap, 12).alias("g"), (-F.col("_x")).alias("x")))).alias("_at"),
        F.sum(F.col("_x") * (F.abs("_before") - gap)).alias("wasserstein"))
    n, m = F.col("n_base").cast("double"), F.col("n_cur").cast("double")
    critical = F.when((n > 0) & (m > 0), F.lit(factor) * F.sqrt((n + m) / (n * m)))
    return out.select(*by, "n_base", "n_cur", "ks", (-F.col("_at.x")).alias("ks_at"), "wasserstein",
                      critical.alias("ks_critical"), (F.col("ks") > critical).alias("shifted"))


def drift_policy(numeric: DataFrame, categorical: DataFrame, moderate: float = 0.1, high: float = 0.25) -> DataFrame:
    """One level and action per feature from |relative mean change| or PSI."""
    num = numeric.select("feature", F.lit("rel_change").alias("metric"), F.abs("rel_change").alias("value"))
    cat = categorical.groupBy("feature").agg(F.sum("psi_term").alias("value")) \
        .select("feature", F.lit("psi").alias("metric"), "value")
    both = num.unionByName(cat)
    level = F.when(F.col("value") > high, "high").when(F.col("value") > moderate, "moderate").otherwise("low")
    action = F.coalesce(*[F.when(level == lv, F.lit(a)) for lv, a in POLICY])
    return both.withColumns({"level": level, "action": action})


def batch_verdict(df: DataFrame, required: Sequence[str], ts_col: str, label: str,
                  allowed: dict[str, Sequence[str]], warn_share: float = 0.0, reject_share: float = 0.05) -> DataFrame:
    """Accepted / accepted with warnings / rejected from duplicate, timestamp,
    label and category checks (missing required columns reject outright)."""
    missing = [c for c in required if c not in df.columns]
    n = F.count(F.lit(1))
    dup = scalar_row(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("k"))
                     .agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("d"))).d
    checks = {"null_timestamps": F.count_if(F.col(ts_col).isNull()),
              "null_labels": F.count_if(F.col(label).isNull())}
    for c, vals in allowed.items():
        checks[f"unknown_{c}"] = F.count_if(~F.coalesce(F.col(c).isin(list(vals)), F.lit(False)))
    agg = df.agg(n.alias("n_rows"), *[v.alias(k) for k, v in checks.items()])
    agg = agg.withColumn("duplicate_rows", dup.cast("bigint"))
    issues = sum((F.col(k) for k in [*checks, "duplicate_rows"]), F.lit(0))
    worst = F.greatest(*[safe_ratio(F.col(k), F.col("n_rows")) for k in [*checks, "duplicate_rows"]])
    outcome = (F.when(F.lit(bool(missing)) | (worst > reject_share), "rejected")
               .when(issues > 0, "accepted with warnings").otherwise("accepted"))
    return agg.withColumns({"missing_columns": F.lit(",".join(missing)), "outcome": outcome})


def promotion_gate(enhanced: DataFrame, production: str, candidate: str, f1_tolerance: float = 0.0) -> DataFrame:
    """Promote the candidate when its cost is lower and its F1 is not worse."""
    def of(model: str, column: str) -> Column:
        return F.max(F.when(F.col("model_variant") == model, F.col(column)))

    one = enhanced.agg(of(production, "total_cost").alias("production_cost"), of(candidate, "total_cost").alias("candidate_cost"),
                       of(production, "f1_score").alias("production_f1"), of(candidate, "f1_score").alias("candidate_f1"))
    promote = (F.col("candidate_cost") < F.col("production_cost")) & \
        (F.col("candidate_f1") >= F.col("production_f1") - F.lit(f1_tolerance))
    return one.select(F.lit(production).alias("production"), F.lit(candidate).alias("candidate"), *one.columns,
                      F.when(promote, "promote").otherwise("keep production").alias("decision"))
