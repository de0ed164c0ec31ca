"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (through the fixture projections) and runs
the library operators over the whole input.  Double results are rounded to 9
decimals as a final presentation step so that two engines summing in different
orders report the same digits.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.exprs import round_doubles
from tidewatch.operators import dpi, features
from tidewatch.sources import fixtures
from tidewatch.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def _r(df: DataFrame) -> DataFrame:
    return round_doubles(df, 9)


# ------------------------------------------------------------------ shared plans
from tidewatch.plans import incremental  # noqa: E402
from tidewatch.plans.layers import materialized  # noqa: E402


def _hr(spark, sf):
    """Silver layer: the employee projection of the driver tables, written once per session."""
    return materialized(spark, sf, "silver_hr", lambda: fixtures.hr(spark, sf))


def _thresholds(spark, sf):
    """The silver layer's violation thresholds, one stored row."""
    return materialized(spark, sf, "thresholds", lambda: features.violation_thresholds(_hr(spark, sf)))


def _gold(spark, sf):
    """Gold layer: the 19-column department-week table, written once per session."""
    return materialized(spark, sf, "gold_dept_week", lambda: features.dept_week_gold(_hr(spark, sf), _thresholds(spark, sf)))


# ------------------------------------------------------------------ features
@query("violation_thresholds")
def q_violation_thresholds(spark, sf):
    return _r(features.violation_thresholds(_hr(spark, sf)))


@query("threshold_sketches")
def q_threshold_sketches(spark, sf):
    """Thresholds from merged weekly sketches: whether each one's rank in the table is within the stated error."""
    hr = _hr(spark, sf)
    weekly_parts = materialized(spark, sf, "threshold_sketches", lambda: features.threshold_sketches(hr, ["weekly_ts"]))
    found = features.approximate_thresholds(weekly_parts)
    wide = found.select(F.inline(F.array(*[F.struct(F.lit(n).alias("threshold"), F.lit(c).alias("feature"), F.lit(p).alias("rank"), F.col(n).alias("value"))
                                           for n, (c, p) in features.THRESHOLDS.items()])))
    long = profile.long_values(hr, list(dict.fromkeys(c for c, _ in features.THRESHOLDS.values()))).withColumnRenamed("value", "x")
    below = long.join(F.broadcast(wide), "feature").groupBy("threshold", "rank", "value").agg(                       # five rows
        F.avg((F.col("x") < F.col("value")).cast("double")).alias("under"), F.avg((F.col("x") <= F.col("value")).cast("double")).alias("upto"))
    error = rank_error()
    return below.select("threshold", "rank", F.lit(error).alias("rank_error"),
                        ((F.col("under") - error <= F.col("rank")) & (F.col("rank") <= F.col("upto") + error)).alias("within"))


@query("violation_flags")
def q_violation_flags(spark, sf):
    return features.violation_flags(_hr(spark, sf)).select(
        "EmployeeID", "v1_overtime", "v2_overload_satisfaction", "v3_stagnation",
        "v4_post_accident_overwork")


@query("dept_week_features")
def q_dept_week_features(spark, sf):
    hr = _hr(spark, sf)
    return _r(features.dept_week_features(features.violation_flags(hr)))


@query("dept_week_lags")
def q_dept_week_lags(spark, sf):
    return _r(features.dept_week_gold(_hr(spark, sf), _thresholds(spark, sf)))


@query("dept_week_incremental")
def q_dept_week_incremental(spark, sf):
    """Gold kept by updates: a first load that lacks or misstates every 40th week's rows, then these weeks alone."""
    hr, home = _hr(spark, sf), scratch_path(spark, "incremental")
    week = F.datediff(F.col("weekly_ts").cast("date"), F.lit("1970-01-05").cast("date")) / 7
    late = F.pmod(week.cast("int"), F.lit(40)) == 0
    satisfied = F.when(late, F.lit(1.0)).otherwise(F.col("satisfaction_level")).alias("satisfaction_level")
    first = hr.select(*[satisfied if c == "satisfaction_level" else F.col(c) for c in hr.columns])
    incremental.land(first.where(~late | (F.col("EmployeeID") % 2 == 0)), f"{home}/silver")
    incremental.update(spark, f"{home}/silver", home)
    incremental.land(hr.where(late), f"{home}/silver")
    incremental.update(spark, f"{home}/silver", home)
    return _r(incremental.gold(spark, home))


@query("employee_gold")
def q_employee_gold(spark, sf):
    hr = _hr(spark, sf)
    levels = features.category_levels(hr, "sales")
    return _r(features.employee_gold(hr, _gold(spark, sf), levels))


@query("dept_week_fixed_rules")
def q_dept_week_fixed_rules(spark, sf):
    return _r(features.dept_week_fixed_rules(_hr(spark, sf)))


@query("wide_one_hot")
def q_wide_one_hot(spark, sf):
    """Customers as a category of orders: rows per slot of the sparse vectors, the 500 commonest and the rest."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    vocabulary = features.wide_vocabulary(orders, "customer", 500)
    hot = features.sparse_one_hot(orders, "customer", vocabulary, "v").select("o_orderkey", F.col("v").cast("string").alias("v"))
    slot = F.regexp_extract("v", r"\[(\d+)\]", 1).cast("long")       # "(size,[slot],[1.0])"
    return hot.groupBy(slot.alias("slot"), F.regexp_extract("v", r"^\((\d+),", 1).cast("long").alias("size")).agg(F.count(F.lit(1)).alias("n"))


@query("infer_department")
def q_infer_department(spark, sf):
    hr = _hr(spark, sf)
    levels = features.category_levels(hr, "sales")
    emp = features.employee_features(hr, levels)
    return features.infer_department(emp, [f"dept_{x}" for x in levels]).select(
        "EmployeeID", "sales_inferred")


# ------------------------------------------------------------------ DPI
@query("dpi_leaderboard")
def q_dpi_leaderboard(spark, sf):
    return _r(dpi.dpi_leaderboard(features.dept_week_gold(_hr(spark, sf), _thresholds(spark, sf))))


@query("dpi_kpis")
def q_dpi_kpis(spark, sf):
    return _r(dpi.dpi_kpis(dpi.dpi_leaderboard(_gold(spark, sf))))


# ------------------------------------------------------------------ profile
from tidewatch.functions import constants as K  # noqa: E402
from tidewatch.operators import clean, profile, quality  # noqa: E402
from tidewatch.operators.ordering import rank_error  # noqa: E402


def _dirty(spark, sf):
    return fixtures.hr_dirty(spark, sf, _hr(spark, sf))


def _coerced(spark, sf):
    return clean.coerce(_dirty(spark, sf), numeric_text=["hours_text"])


@query("class_balance")
def q_class_balance(spark, sf):
    return profile.class_balance(_hr(spark, sf))


@query("attrition_by_dept")
def q_attrition_by_dept(spark, sf):
    return _r(profile.rate_by(_coerced(spark, sf), "sales"))


@query("attrition_by_salary")
def q_attrition_by_salary(spark, sf):
    return _r(profile.rate_by_salary(_coerced(spark, sf)))


@query("correlation_matrix")
def q_correlation_matrix(spark, sf):
    return _r(profile.correlation_matrix(_hr(spark, sf)))


@query("numeric_describe")
def q_numeric_describe(spark, sf):
    return _r(profile.numeric_describe(_hr(spark, sf), K.CORRELATION_COLUMNS))


for _by in ("left_flag", "sales", "salary"):
    def _mk(by):
        return lambda spark, sf: _r(profile.grouped_summary(_hr(spark, sf), by))
    QUERIES[f"grouped_summary_{'left' if _by == 'left_flag' else _by}"] = _mk(_by)


@query("top_attrition_depts")
def q_top_attrition_depts(spark, sf):
    return _r(profile.top_rates(_hr(spark, sf), "sales", n=5))


# ------------------------------------------------------------------ quality (Q1–Q7)
@query("quality_findings")
def q_quality_findings(spark, sf):
    return quality.all_findings(spark, _dirty(spark, sf))


@query("quality_range_checks")
def q_quality_range_checks(spark, sf):
    return quality.range_findings(_dirty(spark, sf))


@query("quality_verdict")
def q_quality_verdict(spark, sf):
    return quality.verdict(quality.all_findings(spark, _dirty(spark, sf)))


@query("missing_summary")
def q_missing_summary(spark, sf):
    return _r(quality.missing_summary(_dirty(spark, sf)))


@query("outlier_summary")
def q_outlier_summary(spark, sf):
    return _r(quality.outlier_summary(_hr(spark, sf)))


@query("cleanup_report")
def q_cleanup_report(spark, sf):
    return quality.cleanup_report(_dirty(spark, sf))


# ------------------------------------------------------------------ cleaning
@query("clean_dedup")
def q_clean_dedup(spark, sf):
    return _r(clean.dedup(_dirty(spark, sf)))


@query("clean_coerce")
def q_clean_coerce(spark, sf):
    return _r(_coerced(spark, sf))


@query("clean_strict")
def q_clean_strict(spark, sf):
    return _r(clean.strict(_dirty(spark, sf)))


@query("row_sequence")
def q_row_sequence(spark, sf):
    from tidewatch.operators.ordering import row_sequence
    return row_sequence(_hr(spark, sf).select("EmployeeID"), ["EmployeeID"])


@query("synthetic_week")
def q_synthetic_week(spark, sf):
    return clean.synthetic_week(_hr(spark, sf).select("EmployeeID"), ["EmployeeID"], K.ROWS_PER_WEEK)


@query("synthetic_week_strict")
def q_synthetic_week_strict(spark, sf):
    s = clean.strict(_dirty(spark, sf)).select("EmployeeID")
    return clean.synthetic_week(s, ["EmployeeID"], K.ROWS_PER_WEEK_VARIANT, out="weekly_ts")


@query("distinct_weeks")
def q_distinct_weeks(spark, sf):
    return clean.distinct_sorted(_hr(spark, sf), "weekly_ts")


# ------------------------------------------------------------------ scoring
from tidewatch.operators import evaluation as ev  # noqa: E402
from tidewatch.operators import scoring  # noqa: E402

MODELS = ["supervised_score", "anomaly_score", "fused_score"]


def _scored(spark, sf):
    """Scored employees (supervised, anomaly, fused) as a layer read by downstream queries."""
    return materialized(spark, sf, "scored_employees",
                        lambda: scoring.scored_employees(_hr(spark, sf), _gold(spark, sf)))


def _fused_tau(scored):
    """Best threshold of the fused score on the 101-point inclusive grid (scalar subquery)."""
    best = ev.best_threshold(ev.grid_sweep(scored, "fused_score", "left_flag", K.grid_101(), inclusive=True))
    return best.select(F.struct("tau")).scalar().tau


@query("minmax_scale")
def q_minmax_scale(spark, sf):
    dw = _gold(spark, sf)
    return _r(scoring.minmax_scale(dw, "average_montly_hours_mean", "hours_scaled")
              .select("sales", "weekly_ts", "hours_scaled"))


@query("anomaly_scaled")
def q_anomaly_scaled(spark, sf):
    dw = scoring.violation_decision(_gold(spark, sf))
    return _r(scoring.anomaly_score(dw, "decision").select("sales", "weekly_ts", "anomaly_score"))


@query("fused_scores")
def q_fused_scores(spark, sf):
    scored = scoring.scored_employees(_hr(spark, sf), _gold(spark, sf))
    return _r(scored.select("EmployeeID", "supervised_score", "anomaly_score", "fused_score"))


@query("fused_scores_max")
def q_fused_scores_max(spark, sf):
    return _r(_scored(spark, sf).select("EmployeeID", "fused_max_score"))


@query("dept_week_risk")
def q_dept_week_risk(spark, sf):
    return _r(scoring.dept_week_risk(_scored(spark, sf)))


@query("class_weight")
def q_class_weight(spark, sf):
    return _r(scoring.class_weight(_hr(spark, sf)))


@query("decisions_at_tau")
def q_decisions_at_tau(spark, sf):
    s = F.col("score")
    return _hr(spark, sf).select("EmployeeID", ev.decision(s, 0.5, False).alias("decision_strict"),
                                 ev.decision(s, 0.5, True).alias("decision_inclusive"))


# ------------------------------------------------------------------ evaluation
@query("confusion_counts")
def q_confusion_counts(spark, sf):
    return ev.confusion_counts(_hr(spark, sf), "score", "left_flag", 0.5, inclusive=False)


@query("misclassification_cost")
def q_misclassification_cost(spark, sf):
    return ev.with_cost(ev.confusion_counts(_hr(spark, sf), "score", "left_flag", 0.5, inclusive=False))


@query("classification_metrics")
def q_classification_metrics(spark, sf):
    return _r(ev.with_metrics(ev.confusion_counts(_hr(spark, sf), "score", "left_flag", 0.5)))


@query("cost_curve")
def q_cost_curve(spark, sf):
    return _r(ev.grid_sweep(_scored(spark, sf), "fused_score", "left_flag", K.grid_101(), inclusive=True))


@query("best_tau_grid101")
def q_best_tau_grid101(spark, sf):
    return _r(ev.best_threshold(ev.grid_sweep(_scored(spark, sf), "fused_score", "left_flag",
                                              K.grid_101(), inclusive=True)))


@query("best_tau_grid100")
def q_best_tau_grid100(spark, sf):
    return _r(ev.best_threshold(ev.grid_sweep(_scored(spark, sf), "fused_score", "left_flag",
                                              K.grid_100(), inclusive=False)))


@query("best_tau_grid91")
def q_best_tau_grid91(spark, sf):
    return _r(ev.best_threshold(ev.grid_sweep(_scored(spark, sf), "fused_score", "left_flag",
                                              K.grid_91(), inclusive=True)))


@query("tau_unique_scores")
def q_tau_unique_scores(spark, sf):
    return _r(ev.best_distinct_tau(ev.distinct_score_sweep(_hr(spark, sf), "score", "left_flag")))


@query("auroc")
def q_auroc(spark, sf):
    return _r(ev.auroc(_hr(spark, sf), "score", "left_flag"))


@query("average_precision")
def q_average_precision(spark, sf):
    return _r(ev.average_precision(_hr(spark, sf), "score", "left_flag"))


@query("calibration_uniform")
def q_calibration_uniform(spark, sf):
    return _r(ev.calibration_curve(_hr(spark, sf), "score", "left_flag", K.uniform_inner_edges(10)))


@query("calibration_quantile")
def q_calibration_quantile(spark, sf):
    hr = _hr(spark, sf)
    return _r(ev.calibration_curve(hr, "score", "left_flag", ev.quantile_edges(hr, "score", 10)))


@query("brier_score")
def q_brier_score(spark, sf):
    return _r(ev.brier_score(_hr(spark, sf), "score", "left_flag"))


@query("benchmark_table")
def q_benchmark_table(spark, sf):
    scored = _scored(spark, sf)
    return _r(ev.benchmark_table(scored, MODELS, "left_flag", _fused_tau(scored)))


@query("benchmark_enhanced")
def q_benchmark_enhanced(spark, sf):
    return _r(ev.benchmark_enhanced(_scored(spark, sf), MODELS, "left_flag", baseline="supervised_score"))


@query("benchmark_kpi")
def q_benchmark_kpi(spark, sf):
    scored = _scored(spark, sf)
    bench = ev.benchmark_table(scored, MODELS, "left_flag", _fused_tau(scored))
    return _r(scoring.pick_model_row(bench, "fused"))


# ------------------------------------------------------------------ fairness
from tidewatch.operators import fairness  # noqa: E402
from tidewatch.session import checkpointed, scratch_path, stored  # noqa: E402
from tidewatch.sources import files, manifest  # noqa: E402


def _hr_pred(spark, sf):
    return _hr(spark, sf).withColumn("pred", ev.decision(F.col("score"), 0.5, inclusive=False))


def _gp(spark, sf):
    return fixtures.group_preds(spark, sf)


def _audit_tau(df, label="y_true", prob="y_prob"):
    return ev.best_distinct_tau(ev.distinct_score_sweep(df, prob, label)).select(F.struct("tau")).scalar().tau


for _g in ("sales", "salary"):
    def _mk_fair(g):
        QUERIES[f"fairness_parity_{g}"] = lambda spark, sf: _r(
            fairness.demographic_parity(_hr_pred(spark, sf), g, "pred"))
        QUERIES[f"fairness_odds_{g}"] = lambda spark, sf: _r(
            fairness.equalized_odds(_hr_pred(spark, sf), g, "left_flag", "pred"))
        QUERIES[f"fairness_summary_{g}"] = lambda spark, sf: _r(
            fairness.fairness_summary(_hr_pred(spark, sf), g, "left_flag", "pred"))
    _mk_fair(_g)


@query("fairness_parity_lang")
def q_fairness_parity_lang(spark, sf):
    return _r(fairness.demographic_parity(_gp(spark, sf), "grp", "y_pred"))


@query("fairness_odds_lang")
def q_fairness_odds_lang(spark, sf):
    return _r(fairness.equalized_odds(_gp(spark, sf), "grp", "y_true", "y_pred"))


@query("fairness_summary_lang")
def q_fairness_summary_lang(spark, sf):
    return _r(fairness.fairness_summary(_gp(spark, sf), "grp", "y_true", "y_pred"))


@query("bias_report")
def q_bias_report(spark, sf):
    return _r(fairness.bias_report(_hr_pred(spark, sf), "left_flag", "pred",
                                   {"department": "sales", "salary": "salary"}))


@query("bias_report_file")
def q_bias_report_file(spark, sf):
    """The bias report written as JSON lines and read back."""
    path = scratch_path(spark, "bias") + ".json"
    report = fairness.bias_report(_hr_pred(spark, sf), "left_flag", "pred", {"department": "sales", "salary": "salary"})
    files.save_df(report, path)
    return _r(spark.read.schema(report.schema).json(path))


@query("fairness_group_metrics")
def q_fairness_group_metrics(spark, sf):
    gp = _gp(spark, sf)
    return _r(fairness.audit_group_metrics(gp, "grp", "y_true", "y_prob", _audit_tau(gp)))


@query("fairness_overall")
def q_fairness_overall(spark, sf):
    gp = _gp(spark, sf)
    return _r(fairness.audit_overall(gp, "y_true", "y_prob", _audit_tau(gp)))


@query("fairness_fnr_gap")
def q_fairness_fnr_gap(spark, sf):
    gp = _gp(spark, sf)
    return _r(fairness.fnr_gap(fairness.audit_group_metrics(gp, "grp", "y_true", "y_prob", _audit_tau(gp))))


@query("fairness_audit_predictions")
def q_fairness_audit_predictions(spark, sf):
    path = scratch_path(spark, "predictions") + ".csv"
    files.save_df(_gp(spark, sf).select("y_true", "y_prob"), path)
    preds = files.read_predictions_csv(spark, path)
    return _r(fairness.audit_group_metrics(preds, "dept", "y_true", "y_prob", _audit_tau(preds)))


@query("fairness_report_json")
def q_fairness_report_json(spark, sf):
    gp = _gp(spark, sf)
    return fairness.audit_report_json(gp, "grp", "y_true", "y_prob", _audit_tau(gp))


@query("fairness_report_values")
def q_fairness_report_values(spark, sf):
    """The JSON report parsed again: one row for the overall metrics and one per group."""
    gp = _gp(spark, sf)
    report = fairness.audit_report_json(gp, "grp", "y_true", "y_prob", _audit_tau(gp))
    return _r(fairness.parse_audit_report(report, "grp"))


# ------------------------------------------------------------------ every defect at once
def _wide(spark, sf):
    return fixtures.hr_wide_dirty(_hr(spark, sf))


@query("quality_all_rules")
def q_quality_all_rules(spark, sf):
    return quality.all_findings(spark, _wide(spark, sf))


@query("quality_verdict_clean")
def q_quality_verdict_clean(spark, sf):
    return quality.verdict(quality.all_findings(spark, _hr(spark, sf)))


@query("row_sequence_by_week")
def q_row_sequence_by_week(spark, sf):
    from tidewatch.operators.ordering import row_sequence
    return row_sequence(_wide(spark, sf).select("EmployeeID", "weekly_ts"), ["weekly_ts", "EmployeeID"])


@query("cost_curve_dirty")
def q_cost_curve_dirty(spark, sf):
    return _r(ev.grid_sweep(_wide(spark, sf), "score", "left_flag", K.grid_101(), inclusive=True))


@query("bias_report_alerts")
def q_bias_report_alerts(spark, sf):
    skewed = _hr(spark, sf).withColumn("pred", ((F.col("score") > 0.5) | (F.col("sales") == "BUILDING")
                                                | (F.col("salary") == "high")).cast("int"))
    return _r(fairness.bias_report(skewed, "left_flag", "pred", {"department": "sales", "salary": "salary"}))


def _verdict_of(spark, sf, df):
    levels = features.category_levels(_hr(spark, sf), "sales")
    return drift.batch_verdict(df, [c for c, _ in K.REQUIRED_COLUMNS], "weekly_ts", "left_flag",
                               {"salary": K.SALARY_LEVELS, "sales": levels})


@query("batch_verdict_clean")
def q_batch_verdict_clean(spark, sf):
    return _verdict_of(spark, sf, _hr(spark, sf))


@query("batch_verdict_warnings")
def q_batch_verdict_warnings(spark, sf):
    return _verdict_of(spark, sf, _wide(spark, sf))


# ------------------------------------------------------------------ sources
@query("raw_load")
def q_raw_load(spark, sf):
    hr = _hr(spark, sf)
    raw = hr.select(*[F.col(c) for c in ["satisfaction_level", "last_evaluation", "number_project",
                                         "average_montly_hours", "time_spend_company", "Work_accident"]],
                    F.col("left_flag").alias("left"), "promotion_last_5years",
                    F.col("sales").alias("Department"), "salary")
    path = scratch_path(spark, "raw") + ".csv"
    files.save_df(raw, path)
    return _r(files.read_raw_csv(spark, path))


@query("preview_top_rows")
def q_preview_top_rows(spark, sf):
    return _r(files.preview(_hr(spark, sf), ["EmployeeID"], 50))


@query("dataset_manifest")
def q_dataset_manifest(spark, sf):
    from tidewatch.sources.tables import TABLES
    m = files.dataset_manifest({t: read_table(spark, sf, t) for t in TABLES})
    return m.select("dataset", "n_rows", "n_columns")


@query("dataset_changes")
def q_dataset_changes(spark, sf):
    """A table by department, one of which is rewritten: what two manifests of it say has changed, from the top."""
    rows, home = _hr(spark, sf), scratch_path(spark, "manifest")
    rows.repartition("sales").write.partitionBy("sales").parquet(f"{home}/table")
    manifest.updated(spark, f"{home}/table")[0].write.parquet(f"{home}/first")
    before = spark.read.parquet(f"{home}/first")
    edited = rows.where("sales = 'BUILDING'").withColumn("left_flag", 1 - F.col("left_flag"))
    edited.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sales").parquet(f"{home}/table")
    manifest.updated(spark, f"{home}/table", before)[0].write.parquet(f"{home}/second")
    found = manifest.differences(before, spark.read.parquet(f"{home}/second"))
    return found.groupBy("partition", "change").agg(F.count(F.lit(1)).alias("files"), F.sum(F.coalesce("rows_before", "rows_after")).alias("n_rows"))


@query("dataset_fingerprint")
def q_dataset_fingerprint(spark, sf):
    from tidewatch.sources.tables import TABLES, read_table
    return files.dataset_manifest({t: read_table(spark, sf, t) for t in TABLES})


@query("run_manifest")
def q_run_manifest(spark, sf):
    """The run manifest written as one JSON document and read back (its time left out)."""
    from tidewatch.sources.tables import TABLES, read_table
    path = scratch_path(spark, "manifest") + ".json"
    files.write_run_manifest({t: read_table(spark, sf, t) for t in TABLES}, path, {"fn_weight": "10", "fp_weight": "1"})
    back = files.read_run_manifest(spark, path)
    return back.select("dataset", "n_rows", "n_columns", F.col("parameters")["fn_weight"].alias("fn_weight"))


@query("source_checksums")
def q_source_checksums(spark, sf):
    return files.file_checksums(spark, f"{sf.rstrip('/')}/*.parquet")


@query("threshold_lookup")
def q_threshold_lookup(spark, sf):
    path = scratch_path(spark, "metrics") + ".json"
    files.save_df(ev.evaluation_report(_scored(spark, sf), "left_flag", "fused_score", "fused_max_score"), path)
    return files.read_threshold(spark, path)


# ------------------------------------------------------------------ alerts and text
from tidewatch.functions import text as TX  # noqa: E402
from tidewatch.operators import alerts  # noqa: E402


def _alert_ctx(spark, sf):
    scored = _scored(spark, sf)
    return alerts.alert_context(scoring.dept_week_risk(scored), _gold(spark, sf)), scored


def _alerts(spark, sf):
    ctx, scored = _alert_ctx(spark, sf)
    return alerts.alert_records(ctx, _fused_tau(scored))


def _flat_drivers(df, col="top_drivers"):
    return df.withColumn(col, F.array_join(col, "|"))


@query("alert_context")
def q_alert_context(spark, sf):
    return _r(_alert_ctx(spark, sf)[0])


@query("top_drivers")
def q_top_drivers(spark, sf):
    ctx, _ = _alert_ctx(spark, sf)
    return _flat_drivers(alerts.top_drivers(ctx).select("sales", "weekly_ts", "top_drivers"))


@query("alert_records")
def q_alert_records(spark, sf):
    return _r(_flat_drivers(_alerts(spark, sf)))


@query("alert_summaries")
def q_alert_summaries(spark, sf):
    return alerts.with_summary(_alerts(spark, sf)).select("dept", "weekly_ts", "summary")


@query("sanitized_alerts")
def q_sanitized_alerts(spark, sf):
    a = _alerts(spark, sf).withColumn("internal_id", F.xxhash64("dept", "weekly_ts"))
    return _r(_flat_drivers(alerts.sanitize(a)))


@query("driver_phrases")
def q_driver_phrases(spark, sf):
    a = _alerts(spark, sf)
    return a.select("dept", "weekly_ts", F.array_join(TX.driver_phrases(F.col("top_drivers")), "|").alias("phrases"))


@query("summary_lines")
def q_summary_lines(spark, sf):
    a = _alerts(spark, sf)
    return a.select("dept", "weekly_ts", F.posexplode(alerts.summary_lines(F.col("dept"), F.col("weekly_ts"),
                                                                            F.col("top_drivers")))
                    .alias("line_no", "line"))


@query("sanitized_text")
def q_sanitized_text(spark, sf):
    from tidewatch.sources.tables import read_table
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", TX.clip_text(F.col("text")).alias("clipped")).withColumn(
        "clipped_len", F.length("clipped").cast("bigint"))


@query("notices")
def q_notices(spark, sf):
    scored = _scored(spark, sf)
    return _r(alerts.notices(scoring.dept_week_risk(scored), _fused_tau(scored)))


@query("employee_alerts")
def q_employee_alerts(spark, sf):
    scored = _scored(spark, sf)
    return _r(alerts.employee_alerts(scored, _fused_tau(scored)))


# ------------------------------------------------------------------ streaming
from tidewatch.streaming import weekly, windows  # noqa: E402


@query("stream_weekly_risk")
def q_stream_weekly_risk(spark, sf):
    src = f"{sf.rstrip('/')}/events.parquet"
    return _r(weekly.weekly_event_stream(spark, src, "ts", ["event_type"], "value"))


@query("stream_weekly_closing")
def q_stream_weekly_closing(spark, sf):
    """Weekly windows per event type that close by event-time timers."""
    src = f"{sf.rstrip('/')}/events.parquet"
    stream = weekly.file_stream(spark, src, spark.read.parquet(src).schema)
    return _r(windows.closing_weekly_stream(spark, stream, "ts", ["event_type"], "value")[0])


@query("stream_weekly_alerts")
def q_stream_weekly_alerts(spark, sf):
    scored = _scored(spark, sf)
    best = ev.best_threshold(ev.grid_sweep(scored, "fused_score", "left_flag", K.grid_101(), inclusive=True))
    tau = float(best.select("tau").first()["tau"])     # one value; a running stream needs a constant
    out = weekly.weekly_alert_stream(spark, scored, _gold(spark, sf), tau)
    return _r(_flat_drivers(out))


# ------------------------------------------------------------------ models (M1–M12) — rows-only checks
from tidewatch.operators import boosting, iforest, models  # noqa: E402


def _emp_gold(spark, sf):
    hr = _hr(spark, sf)
    dw = _gold(spark, sf)
    return features.employee_gold(hr, dw, features.category_levels(hr, "sales")), dw


@query("stratified_split")
def q_stratified_split(spark, sf):
    return models.stratified_split(_hr(spark, sf).select("EmployeeID", "left_flag"), "EmployeeID", 0.3)


def _iforest_dept(spark, sf):
    dw = iforest.feature_array(_gold(spark, sf), models.ANOMALY_FEATURES)
    nodes, psi = iforest.fit(dw, ["sales", "weekly_ts"], "features", n_trees=100, max_samples=256)
    # scores feed both a one-row subquery (min/max or quantile) and the output: stored, not scored twice
    return checkpointed(iforest.score(spark, dw, ["sales", "weekly_ts"], "features", nodes, psi))


@query("iforest_scores")
def q_iforest_scores(spark, sf):
    return scoring.anomaly_score(_iforest_dept(spark, sf), "decision", "anomaly_score")


@query("iforest_flags")
def q_iforest_flags(spark, sf):
    return iforest.with_contamination(_iforest_dept(spark, sf), 0.1)


@query("iforest_embeddings")
def q_iforest_embeddings(spark, sf):
    from tidewatch.sources.tables import read_table
    emb = read_table(spark, sf, "embeddings").withColumn("features", F.col("embedding").cast("array<double>"))
    nodes, psi = iforest.fit(emb, ["vec_id"], "features", n_trees=100, max_samples=256)
    return iforest.score(spark, emb, ["vec_id"], "features", nodes, psi)


TEST_SHARE = 0.3
ENSEMBLE = ["logreg_score", "gbt_score", "iforest_score", "fused_score"]
VARIANTS = ["gbt_score", "gbt_weighted_score", "calibrated_score", "logreg_score", "fused_score", "fusion_lr_score"]


def _model_scores(spark, sf):
    """Every fitted model's score for every employee, with the train / test split: fitted on the
    training part once per session and stored, as a production bundle would be scored once."""
    def build():
        emp, _ = _emp_gold(spark, sf)
        cols = models.feature_columns(emp, models.SUPERVISED_BASE)
        linear = models.feature_columns(emp, models.LOGISTIC_BASE)
        bundle = scratch_path(spark, "bundle")
        keep = ["EmployeeID", "sales", "salary", "weekly_ts", "left_flag", "split", "violation_density"]
        whole = models.stratified_split(emp, "EmployeeID", TEST_SHARE)
        emp = stored(whole.select(*dict.fromkeys([*keep, *cols, *linear])), "employees")     # every fit reads it many times
        is_train = F.col("split") == "train"
        train = emp.where(is_train)

        def linear_bundle():
            models.save_model(models.fit_logistic(train, linear, "left_flag"), bundle, "logreg")

        def tree_bundle():
            trees = boosting.fit(train, cols, "left_flag", rounds=100, depth=6, step=0.1, subsample=0.8, columns=0.8)
            trees.save(spark, f"{bundle}/gbt")

        def calibrated_scores():
            weighted = F.when(is_train, F.when(F.col("left_flag") == 1, models.class_weight(train, "left_flag")).otherwise(1.0))
            return models.calibrated_gbt_scores(whole, cols, "left_flag", "EmployeeID", train=is_train,
                                                beside={"gbt_weighted_score": weighted})

        # the fits are chains of small jobs that wait for each other; side by side they fill the cluster
        with ThreadPoolExecutor(3) as pool:
            calibrated, *fitted = [pool.submit(f) for f in (calibrated_scores, tree_bundle, linear_bundle)]
            for f in fitted:
                f.result()
            calibrated = calibrated.result()
        out = models.score(models.load_model(bundle, "logreg"), emp, linear, "logreg_score")
        out = boosting.Forest.load(spark, f"{bundle}/gbt").score(out, "gbt_score")
        anomaly = scoring.anomaly_score(_iforest_dept(spark, sf), "decision", "iforest_score").select("sales", "weekly_ts", "iforest_score")
        out = out.select(*keep, "logreg_score", "gbt_score").join(calibrated, "EmployeeID")
        out = scoring.attach_dept_score(out, anomaly, "iforest_score")
        out = out.withColumn("fused_score", scoring.fuse(F.col("gbt_score"), F.col("iforest_score"), K.FUSION_WEIGHT_SUPERVISED))
        out = stored(out, "fitted-scores")
        # the fusion learns from scores of models that have not seen the row: those of its own training fit are too sure
        learned = models.learned_fusion_scores(out, ["cross_fitted_score", "iforest_score", "violation_density"], "left_flag",
                                               "EmployeeID", train=is_train)
        return out.drop("cross_fitted_score").join(learned, "EmployeeID")

    return materialized(spark, sf, "model_scores", build)


for _key, _col in (("logreg_scores", "logreg_score"), ("gbt_scores", "gbt_score"), ("gbt_weighted_scores", "gbt_weighted_score"),
                   ("calibrated_scores", "calibrated_score"), ("fusion_learned_scores", "fusion_lr_score")):
    def _mk_scores(col):
        return lambda spark, sf: _model_scores(spark, sf).select("EmployeeID", "split", col)
    QUERIES[_key] = _mk_scores(_col)


@query("benchmark_models")
def q_benchmark_models(spark, sf):
    """Four fitted models at the naive fusion's threshold of the training part, for that and the held-out part."""
    scores = _model_scores(spark, sf)
    tau = _fused_tau(scores.where("split = 'train'"))
    return _r(ev.by_part(scores, lambda df: ev.benchmark_table(df, ENSEMBLE, "left_flag", tau)))


@query("benchmark_variants")
def q_benchmark_variants(spark, sf):
    """Six variants, each at its cheapest threshold of the training part, for that and the held-out part."""
    return _r(ev.benchmark_heldout(_model_scores(spark, sf), VARIANTS, "left_flag", "gbt_score"))


@query("evaluation_report")
def q_evaluation_report(spark, sf):
    """Naive and learned fusion of fitted models: the five-key metrics file, written as JSON and read back."""
    path = scratch_path(spark, "evaluation") + ".json"
    files.save_df(ev.evaluation_report(_model_scores(spark, sf), "left_flag", "fused_score", "fusion_lr_score"), path)
    return spark.read.json(path)


for _g in ("sales", "salary"):
    def _mk_heldout(g):
        return lambda spark, sf: _r(fairness.fairness_summary(
            _model_scores(spark, sf).where("split = 'test'").withColumn("pred", ev.decision(F.col("gbt_score"), 0.5, False)),
            g, "left_flag", "pred"))
    QUERIES[f"fairness_heldout_{_g}"] = _mk_heldout(_g)


@query("group_folds")
def q_group_folds(spark, sf):
    return models.group_folds(spark, _hr(spark, sf), "sales", 5)


def _cv(spark, sf):
    emp, _ = _emp_gold(spark, sf)
    cols = models.feature_columns(emp, models.SUPERVISED_BASE)
    return materialized(spark, sf, "group_cv", lambda: models.group_cv_metrics(spark, emp, cols, "left_flag", "sales", n_folds=5))


@query("group_cv_metrics")
def q_group_cv_metrics(spark, sf):
    return _r(_cv(spark, sf))


@query("group_cv_summary")
def q_group_cv_summary(spark, sf):
    return _r(models.cv_summary(_cv(spark, sf)))


# ------------------------------------------------------------------ drift
from tidewatch.operators import drift, governance  # noqa: E402

DRIFT_CUT = "1998-05-01"
DRIFT_COLS = K.NUMERIC_PROFILE_COLUMNS + ["score"]


def _periods(spark, sf):
    return drift.split_periods(_hr(spark, sf), "weekly_ts", DRIFT_CUT)


def _cat_drift(spark, sf):
    p = _periods(spark, sf)
    return drift.category_drift(p, "sales").unionByName(drift.category_drift(p, "salary"))


@query("drift_numeric")
def q_drift_numeric(spark, sf):
    return _r(drift.numeric_drift(_periods(spark, sf), DRIFT_COLS))


@query("drift_category")
def q_drift_category(spark, sf):
    return _r(_cat_drift(spark, sf))


@query("drift_rates")
def q_drift_rates(spark, sf):
    s = drift.split_periods(_scored(spark, sf), "weekly_ts", DRIFT_CUT)
    return _r(drift.rate_drift(s, "sales", "left_flag", "fused_score", "anomaly_score"))


@query("drift_distribution")
def q_drift_distribution(spark, sf):
    """KS and Wasserstein distances of three scores between the periods, per department."""
    s = drift.split_periods(_scored(spark, sf), "weekly_ts", DRIFT_CUT)
    long = s.unpivot(["sales", "period"], ["score", "anomaly_score", "fused_score"], "feature", "value")
    return _r(drift.distribution_drift(long, ["feature", "sales"], "value"))


@query("benchmark_heldout")
def q_benchmark_heldout(spark, sf):
    """Two formula scores and their fusion at the cheapest thresholds of employees with an odd key, in both halves."""
    half = _scored(spark, sf).withColumn("split", F.when(F.col("EmployeeID") % 2 == 1, "train").otherwise("test"))
    return _r(ev.benchmark_heldout(half, ["supervised_score", "anomaly_score", "fused_score"], "left_flag", "supervised_score"))


@query("drift_policy")
def q_drift_policy(spark, sf):
    return _r(drift.drift_policy(drift.numeric_drift(_periods(spark, sf), DRIFT_COLS), _cat_drift(spark, sf)))


@query("batch_verdict")
def q_batch_verdict(spark, sf):
    return _verdict_of(spark, sf, _dirty(spark, sf))


@query("promotion_gate")
def q_promotion_gate(spark, sf):
    enh = ev.benchmark_enhanced(_scored(spark, sf), MODELS, "left_flag", baseline="supervised_score")
    return _r(drift.promotion_gate(enh, "supervised_score", "fused_score"))


# ------------------------------------------------------------------ governance
def _scan(spark, sf):
    from tidewatch.sources.tables import read_table
    return governance.secret_scan(read_table(spark, sf, "documents"), "text", ["doc_id", "source"])


def _findings(spark, sf):
    d = _dirty(spark, sf)
    return governance.findings(spark, quality.all_findings(spark, d), quality.missing_summary(d), _scan(spark, sf))


@query("secret_scan")
def q_secret_scan(spark, sf):
    return _scan(spark, sf).withColumn("found", F.array_join("found", "|"))


@query("secret_scan_summary")
def q_secret_scan_summary(spark, sf):
    return governance.secret_summary(_scan(spark, sf), "source")


@query("findings_score")
def q_findings_score(spark, sf):
    return governance.findings_score(_findings(spark, sf))


@query("findings_recommendations")
def q_findings_recommendations(spark, sf):
    return governance.recommendations(spark, _findings(spark, sf))
