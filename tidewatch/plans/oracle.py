"""Independent DuckDB SQL for every query key that has a SQL form."""

from __future__ import annotations

from tidewatch.functions import constants as K
from tidewatch.plans.sql_fixtures import (GOLD_CTES, GROUP_PREDS_CTE, HR_CTES, HR_DIRTY_CTE,
                                          HR_WIDE_CTE,
                                          rounded, with_ctes)

ORACLE: dict[str, str] = {}

DW_DOUBLES = ["attrition_rate", "satisfaction_level_mean", "average_montly_hours_mean",
              "time_spend_company_mean", "violation_density"]
LAG_DOUBLES = ["violation_density_lag1", "attrition_rate_lag1"]


def hr_sql(body: str, *extra: str) -> str:
    return with_ctes(HR_CTES, *extra, body=body)


def gold_sql(body: str, *extra: str) -> str:
    return with_ctes(HR_CTES, GOLD_CTES, *extra, body=body)


# ------------------------------------------------------------------ features
ORACLE["violation_thresholds"] = rounded(
    gold_sql("SELECT * FROM thr"),
    ["p95_hours", "p75_projects", "p25_satisfaction", "p75_tenure", "median_hours"])

ORACLE["threshold_sketches"] = """
SELECT threshold, rank, 2.446e0 / pow(2000, 0.9433e0) AS rank_error, TRUE AS within
FROM (VALUES ('p95_hours', 0.95::DOUBLE), ('p75_projects', 0.75), ('p25_satisfaction', 0.25), ('p75_tenure', 0.75), ('median_hours', 0.5)) t(threshold, rank)"""

ORACLE["violation_flags"] = gold_sql(
    "SELECT EmployeeID, v1_overtime, v2_overload_satisfaction, v3_stagnation, "
    "v4_post_accident_overwork FROM flagged")

ORACLE["dept_week_features"] = rounded(gold_sql("SELECT * FROM dw"), DW_DOUBLES)

ORACLE["dept_week_lags"] = rounded(gold_sql("SELECT * FROM dwl"), DW_DOUBLES + LAG_DOUBLES)

ORACLE["dept_week_incremental"] = ORACLE["dept_week_lags"]

ORACLE["employee_gold"] = rounded(gold_sql("""
SELECT hr.*, dwl.* EXCLUDE (sales, weekly_ts),
  CAST(CASE salary WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 END AS INT) AS salary_ord,
  satisfaction_level * last_evaluation AS satisfaction_x_eval,
  CAST(average_montly_hours * number_project AS BIGINT) AS hours_x_projects,
  CAST(CASE WHEN hr.sales = 'AUTOMOBILE' THEN 1 ELSE 0 END AS INT) AS dept_AUTOMOBILE,
  CAST(CASE WHEN hr.sales = 'BUILDING' THEN 1 ELSE 0 END AS INT) AS dept_BUILDING,
  CAST(CASE WHEN hr.sales = 'FURNITURE' THEN 1 ELSE 0 END AS INT) AS dept_FURNITURE,
  CAST(CASE WHEN hr.sales = 'HOUSEHOLD' THEN 1 ELSE 0 END AS INT) AS dept_HOUSEHOLD,
  CAST(CASE WHEN hr.sales = 'MACHINERY' THEN 1 ELSE 0 END AS INT) AS dept_MACHINERY
FROM hr LEFT JOIN dwl ON hr.sales = dwl.sales AND hr.weekly_ts = dwl.weekly_ts"""),
    ["satisfaction_level", "last_evaluation", "score", "satisfaction_x_eval"] + DW_DOUBLES + LAG_DOUBLES)

_FIXED_STATS = []
for _c in ["satisfaction_level", "last_evaluation", "number_project", "average_montly_hours",
           "time_spend_company"]:
    _FIXED_STATS += [f"AVG({_c}) AS {_c}_mean", f"STDDEV_SAMP({_c}) AS {_c}_std"]
_FIXED_A = f"""
a AS (
  SELECT sales, weekly_ts, {", ".join(_FIXED_STATS)},
    CAST(SUM(Work_accident) AS BIGINT) AS Work_accident_sum,
    CAST(SUM(promotion_last_5years) AS BIGINT) AS promotion_last_5years_sum,
    CAST(SUM(left_flag) AS BIGINT) AS left_flag_sum,
    COUNT(left_flag) AS left_flag_count,
    COUNT(DISTINCT EmployeeID) AS EmployeeID_nunique
  FROM hr WHERE sales IS NOT NULL AND weekly_ts IS NOT NULL GROUP BY sales, weekly_ts)"""
_FIXED_B = """
b AS (
  SELECT *, left_flag_sum AS leavers, EmployeeID_nunique AS headcount,
    CAST(left_flag_sum AS DOUBLE) / CAST(EmployeeID_nunique AS DOUBLE) AS attrition_rate,
    CAST(CASE WHEN average_montly_hours_mean > 200 THEN 1 ELSE 0 END AS INT) AS v1_overtime_sum,
    CAST(CASE WHEN satisfaction_level_mean < 0.3 THEN 1 ELSE 0 END AS INT) AS v2_low_satisfaction_sum,
    CAST(CASE WHEN time_spend_company_mean > 5 AND promotion_last_5years_sum = 0 THEN 1 ELSE 0 END AS INT) AS v3_stagnation_sum,
    CAST(CASE WHEN number_project_mean > 6 THEN 1 ELSE 0 END AS INT) AS v4_overload_sum
  FROM a)"""
ORACLE["dept_week_fixed_rules"] = rounded(hr_sql("""
SELECT *, CAST(v1_overtime_sum + v2_low_satisfaction_sum + v3_stagnation_sum + v4_overload_sum AS DOUBLE)
  / CAST(headcount AS DOUBLE) AS violation_density FROM b""", _FIXED_A, _FIXED_B),
    [f"{c}_{s}" for c in ["satisfaction_level", "last_evaluation", "number_project",
                          "average_montly_hours", "time_spend_company"] for s in ("mean", "std")]
    + ["attrition_rate", "violation_density"])

ORACLE["wide_one_hot"] = """
WITH c AS (SELECT o_custkey::VARCHAR AS v, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS slot FROM c),
top AS (SELECT v, slot FROM s WHERE slot < 500)
SELECT coalesce(t.slot, m.size - 1) AS slot, m.size, count(*) AS n
FROM orders o LEFT JOIN top t ON o.o_custkey::VARCHAR = t.v, (SELECT count(*) + 1 AS size FROM top) m GROUP BY 1, 2"""

ORACLE["infer_department"] = hr_sql("SELECT EmployeeID, COALESCE(sales, 'unknown') AS sales_inferred FROM hr")

# ------------------------------------------------------------------ DPI
DPI_CTES = """
dept AS (
  SELECT sales, AVG(attrition_rate) AS attrition_rate,
    AVG(average_montly_hours_mean) AS average_montly_hours_mean,
    AVG(satisfaction_level_mean) AS satisfaction_level_mean,
    AVG(headcount) AS headcount, AVG(violation_density) AS violation_density
  FROM dwl WHERE sales IS NOT NULL GROUP BY sales),
scored AS (
  SELECT sales, headcount,
    1.0::DOUBLE - attrition_rate AS retention_score,
    (1.0::DOUBLE - average_montly_hours_mean / (SELECT MAX(average_montly_hours_mean) FROM dept)) * 0.5::DOUBLE
      + satisfaction_level_mean * 0.5::DOUBLE AS workload_score,
    CASE WHEN (SELECT MAX(violation_density) FROM dept) > 0
      THEN 1.0::DOUBLE - violation_density / (SELECT MAX(violation_density) FROM dept) ELSE 1.0::DOUBLE END AS compliance_score
  FROM dept),
lb AS (
  SELECT *, retention_score * 0.4::DOUBLE + workload_score * 0.4::DOUBLE + compliance_score * 0.2::DOUBLE AS dpi
  FROM scored),
ranked AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY dpi DESC, sales ASC) AS INT) AS rank, sales, dpi,
    retention_score, workload_score, compliance_score, headcount FROM lb)"""

DPI_DOUBLES = ["dpi", "retention_score", "workload_score", "compliance_score", "headcount"]

ORACLE["dpi_leaderboard"] = rounded(gold_sql("SELECT * FROM ranked", DPI_CTES), DPI_DOUBLES)

ORACLE["dpi_kpis"] = rounded(gold_sql("""
SELECT COUNT(*) AS n_departments, arg_min(sales, rank) AS top_performer, AVG(dpi) AS mean_dpi,
  string_agg(CASE WHEN rank <= 5 THEN sales END, ',' ORDER BY rank) AS top_departments
FROM ranked""", DPI_CTES), ["mean_dpi"])


# ------------------------------------------------------------------ profile
def dirty_sql(body: str, *extra: str) -> str:
    return with_ctes(HR_CTES, HR_DIRTY_CTE, *extra, body=body)


_COERCED = """
coerced AS (
  SELECT EmployeeID, satisfaction_level, hours_text, average_montly_hours,
    NULLIF(salary, '') AS salary, NULLIF(sales, '') AS sales, left_flag, weekly_ts,
    TRY_CAST(hours_text AS DOUBLE) AS hours_text_numeric
  FROM (SELECT DISTINCT * FROM hr_dirty) d WHERE left_flag IS NOT NULL)"""

ORACLE["class_balance"] = hr_sql("SELECT left_flag, COUNT(*) AS n FROM hr GROUP BY left_flag")
ORACLE["attrition_by_dept"] = rounded(dirty_sql(
    "SELECT sales, AVG(left_flag) AS attrition_rate FROM coerced GROUP BY sales", _COERCED), ["attrition_rate"])
ORACLE["attrition_by_salary"] = rounded(dirty_sql("""
SELECT salary, AVG(left_flag) AS attrition_rate,
  CAST(CASE salary WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 4 END AS INT) AS salary_order
FROM coerced GROUP BY salary""", _COERCED), ["attrition_rate"])

_CORR_COLS = ["satisfaction_level", "last_evaluation", "number_project", "average_montly_hours",
              "time_spend_company", "left_flag"]
ORACLE["correlation_matrix"] = rounded(hr_sql("\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM hr"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:])), ["r"])

ORACLE["numeric_describe"] = rounded(hr_sql("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, COUNT({c}) AS count, AVG(CAST({c} AS DOUBLE)) AS mean,
  STDDEV_SAMP(CAST({c} AS DOUBLE)) AS std, CAST(MIN({c}) AS DOUBLE) AS min,
  quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50,
  quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, CAST(MAX({c}) AS DOUBLE) AS max FROM hr"""
    for c in _CORR_COLS)), ["mean", "std", "min", "q25", "q50", "q75", "max"])

for _by, _key in (("left_flag", "left"), ("sales", "sales"), ("salary", "salary")):
    _stats = ", ".join(
        f"AVG(CAST({c} AS DOUBLE)) AS {c}_mean, MEDIAN(CAST({c} AS DOUBLE)) AS {c}_median, "
        f"STDDEV_SAMP(CAST({c} AS DOUBLE)) AS {c}_std" for c in _CORR_COLS[:5])
    ORACLE[f"grouped_summary_{_key}"] = rounded(
        hr_sql(f"SELECT {_by}, {_stats} FROM hr WHERE {_by} IS NOT NULL GROUP BY {_by}"),
        [f"{c}_{s}" for c in _CORR_COLS[:5] for s in ("mean", "median", "std")])

ORACLE["top_attrition_depts"] = rounded(hr_sql("""
SELECT * FROM (
  SELECT sales, AVG(left_flag) AS attrition_rate,
    CAST(ROW_NUMBER() OVER (ORDER BY AVG(left_flag) DESC, sales ASC) AS INT) AS rank
  FROM hr WHERE sales IS NOT NULL GROUP BY sales) t WHERE rank <= 5"""), ["attrition_rate"])

# ------------------------------------------------------------------ quality (Q1–Q7)
_REQ = [("satisfaction_level", "numeric"), ("last_evaluation", "numeric"), ("number_project", "numeric"),
        ("average_montly_hours", "numeric"), ("time_spend_company", "numeric"), ("Work_accident", "numeric"),
        ("promotion_last_5years", "numeric"), ("salary", "text"), ("sales", "text"), ("left_flag", "numeric")]
_REQ_VALUES = ", ".join(f"({i}, '{c}', '{k}')" for i, (c, k) in enumerate(_REQ))
_DTYPE_CASE = """CASE column_type WHEN 'DOUBLE' THEN 'float64' WHEN 'FLOAT' THEN 'float32'
  WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'VARCHAR' THEN 'object'
  WHEN 'TIMESTAMP' THEN 'datetime64[ns]' WHEN 'BOOLEAN' THEN 'bool' ELSE lower(column_type) END"""
_SCHEMA_CTES = f"""
req(seq, column_name, kind) AS (VALUES {_REQ_VALUES}),
described AS (SELECT column_name, column_type FROM (DESCRIBE SELECT * FROM hr_dirty)),
schema_f AS (
  SELECT 'missing' AS check_kind, CAST(r.seq AS INT) AS seq, r.column_name, CAST(NULL AS BIGINT) AS bad_count,
    'missing: ' || r.column_name AS message
  FROM req r LEFT JOIN described d ON r.column_name = d.column_name WHERE d.column_name IS NULL
  UNION ALL
  SELECT 'type', CAST(10 + r.seq AS INT), r.column_name, CAST(NULL AS BIGINT),
    r.column_name || ': bad dtype ' || ({_DTYPE_CASE})
  FROM req r JOIN described d ON r.column_name = d.column_name
  WHERE (r.kind = 'text' AND d.column_type <> 'VARCHAR')
     OR (r.kind = 'numeric' AND d.column_type NOT IN ('DOUBLE','FLOAT','BIGINT','INTEGER','SMALLINT','TINYINT','HUGEINT'))),
range_f AS (
  SELECT 'range' AS check_kind, CAST(seq AS INT) AS seq, column_name, bad_count,
    column_name || ': ' || CAST(bad_count AS VARCHAR) || ' bad' AS message
  FROM (
    SELECT 20 AS seq, 'satisfaction_level' AS column_name,
      CAST(SUM(CASE WHEN satisfaction_level BETWEEN 0 AND 1 THEN 0 ELSE 1 END) AS BIGINT) AS bad_count FROM hr_dirty
    UNION ALL SELECT 23, 'average_montly_hours',
      CAST(SUM(CASE WHEN average_montly_hours BETWEEN 0 AND 400 THEN 0 ELSE 1 END) AS BIGINT) FROM hr_dirty
    UNION ALL SELECT 27, 'salary',
      CAST(SUM(CASE WHEN salary IN ('low','medium','high') THEN 0 ELSE 1 END) AS BIGINT) FROM hr_dirty) x
  WHERE bad_count > 0),
findings AS (SELECT * FROM schema_f UNION ALL SELECT * FROM range_f)"""

ORACLE["quality_findings"] = dirty_sql("SELECT * FROM findings", _SCHEMA_CTES)
ORACLE["quality_range_checks"] = dirty_sql("SELECT * FROM range_f", _SCHEMA_CTES)
ORACLE["quality_verdict"] = dirty_sql("""
SELECT COUNT(*) AS n_errors, COUNT(*) = 0 AS passed,
  COALESCE(string_agg(message, '; ' ORDER BY seq), '') AS errors FROM findings""", _SCHEMA_CTES)

_MISS_COLS = [("EmployeeID", False), ("satisfaction_level", True), ("hours_text", False),
              ("average_montly_hours", False), ("salary", False), ("sales", False),
              ("left_flag", False), ("weekly_ts", False)]
ORACLE["missing_summary"] = rounded(dirty_sql("""
SELECT m.column_name, m.missing_count,
  CAST(m.missing_count AS DOUBLE) * 100e0 / CAST(m.n AS DOUBLE) AS missing_pct, """ + _DTYPE_CASE + """ AS dtype
FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NULL"
    + (f" OR isnan({c})" if isnan else "") + " THEN 1 ELSE 0 END) AS BIGINT) AS missing_count, "
    f"COUNT(*) AS n FROM hr_dirty" for c, isnan in _MISS_COLS) + """) m
JOIN (SELECT column_name, column_type FROM (DESCRIBE SELECT * FROM hr_dirty)) d ON m.column_name = d.column_name"""),
    ["missing_pct"])

ORACLE["outlier_summary"] = rounded(hr_sql("\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, q1, q3, q3 - q1 AS iqr, q1 - (q3 - q1) * 1.5 AS lower_bound, q3 + (q3 - q1) * 1.5 AS upper_bound,
  (SELECT CAST(SUM(CASE WHEN {c} < q1 - (q3 - q1) * 1.5 OR {c} > q3 + (q3 - q1) * 1.5 THEN 1 ELSE 0 END) AS BIGINT) FROM hr) AS outlier_count,
  CAST((SELECT SUM(CASE WHEN {c} < q1 - (q3 - q1) * 1.5 OR {c} > q3 + (q3 - q1) * 1.5 THEN 1 ELSE 0 END) FROM hr) AS DOUBLE)
    * 100e0 / CAST((SELECT COUNT(*) FROM hr) AS DOUBLE) AS outlier_pct
FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM hr) q"""
    for c in _CORR_COLS[:5])), ["q1", "q3", "iqr", "lower_bound", "upper_bound", "outlier_pct"])

ORACLE["cleanup_report"] = dirty_sql("""
SELECT (SELECT COUNT(*) FROM hr_dirty) AS rows_before,
  (SELECT COUNT(*) FROM hr_dirty) - COUNT(*) AS duplicates_removed,
  CAST(SUM(CASE WHEN left_flag IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_missing_left_removed,
  CAST(SUM(CASE WHEN left_flag IS NOT NULL AND sales = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank_sales_to_na,
  CAST(SUM(CASE WHEN left_flag IS NOT NULL AND salary = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank_salary_to_na,
  CAST(SUM(CASE WHEN left_flag IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_after
FROM (SELECT DISTINCT * FROM hr_dirty) d""")

# ------------------------------------------------------------------ cleaning
ORACLE["clean_dedup"] = rounded(dirty_sql("SELECT DISTINCT * FROM hr_dirty"), ["satisfaction_level"])
ORACLE["clean_coerce"] = rounded(dirty_sql("SELECT * FROM coerced", _COERCED),
                                 ["satisfaction_level", "hours_text_numeric"])
ORACLE["clean_strict"] = rounded(dirty_sql("""
SELECT DISTINCT * FROM hr_dirty WHERE EmployeeID IS NOT NULL AND satisfaction_level IS NOT NULL
  AND NOT isnan(satisfaction_level) AND hours_text IS NOT NULL AND average_montly_hours IS NOT NULL
  AND salary IS NOT NULL AND sales IS NOT NULL AND left_flag IS NOT NULL AND weekly_ts IS NOT NULL"""),
    ["satisfaction_level"])
ORACLE["row_sequence"] = hr_sql("SELECT EmployeeID, ROW_NUMBER() OVER (ORDER BY EmployeeID) - 1 AS row_id FROM hr")
ORACLE["synthetic_week"] = hr_sql("""
SELECT EmployeeID, CAST(DATE '2024-01-01' + CAST(((ROW_NUMBER() OVER (ORDER BY EmployeeID) - 1) // 50) * 7 AS INTEGER)
  AS TIMESTAMP) AS synthetic_ts FROM hr""")
ORACLE["synthetic_week_strict"] = dirty_sql("""
SELECT EmployeeID, CAST(DATE '2024-01-01' + CAST(((ROW_NUMBER() OVER (ORDER BY EmployeeID) - 1) // 500) * 7 AS INTEGER)
  AS TIMESTAMP) AS weekly_ts
FROM (SELECT DISTINCT * FROM hr_dirty WHERE EmployeeID IS NOT NULL AND satisfaction_level IS NOT NULL
  AND hours_text IS NOT NULL AND average_montly_hours IS NOT NULL AND salary IS NOT NULL AND sales IS NOT NULL
  AND left_flag IS NOT NULL AND weekly_ts IS NOT NULL) s""")
ORACLE["distinct_weeks"] = hr_sql("SELECT DISTINCT weekly_ts FROM hr WHERE weekly_ts IS NOT NULL")


# ------------------------------------------------------------------ scoring / evaluation
def dbl_list(values) -> str:
    return "[" + ", ".join(f"'{float(v)!r}'::DOUBLE" for v in values) + "]"


SCORED_CTES = """
dwa AS (SELECT sales, weekly_ts, -violation_density AS decision FROM dwl),
dwa2 AS (
  SELECT sales, weekly_ts, CASE WHEN s.mx - s.mn = 0 THEN 0.5::DOUBLE ELSE (decision - s.mn) / (s.mx - s.mn) END AS mm
  FROM dwa, (SELECT MIN(decision) AS mn, MAX(decision) AS mx FROM dwa) s),
anom AS (SELECT sales, weekly_ts, 1e0 - mm AS anomaly_score FROM dwa2),
scored AS (
  SELECT hr.*, COALESCE(anom.anomaly_score, 0.5::DOUBLE) AS anomaly_score, score AS supervised_score,
    score * 0.7e0 + COALESCE(anom.anomaly_score, 0.5::DOUBLE) * (1e0 - 0.7e0) AS fused_score,
    GREATEST(score, COALESCE(anom.anomaly_score, 0.5::DOUBLE)) AS fused_max_score
  FROM hr LEFT JOIN anom ON hr.sales = anom.sales AND hr.weekly_ts = anom.weekly_ts)"""


def scored_sql(body: str, *extra: str) -> str:
    return with_ctes(HR_CTES, GOLD_CTES, SCORED_CTES, *extra, body=body)


def _grid_cte(name: str, grid) -> str:
    return (f"{name} AS (SELECT CAST(i AS INT) AS i, list_extract({dbl_list(grid)}, CAST(i + 1 AS BIGINT)) AS tau "
            f"FROM range(0, {len(grid)}) t(i))")


def _curve_cte(name: str, grid_name: str, score: str, op: str, src: str = "scored") -> str:
    return f"""{name} AS (
  SELECT g.i, g.tau,
    CAST(SUM(CASE WHEN s.{score} {op} g.tau AND s.left_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    CAST(SUM(CASE WHEN s.{score} {op} g.tau AND s.left_flag <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(SUM(CASE WHEN NOT (s.{score} {op} g.tau) AND s.left_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
    CAST(SUM(CASE WHEN NOT (s.{score} {op} g.tau) AND s.left_flag <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM {grid_name} g, {src} s GROUP BY g.i, g.tau),
{name}_c AS (SELECT *, 10e0 * fn + 1e0 * fp AS cost FROM {name})"""


try:
    import numpy as _np
    _G101 = _np.linspace(0.0, 1.0, 101).tolist()
    _G100 = _np.linspace(0.0, 1.0, 100).tolist()
    _G91 = _np.arange(0.05, 0.96, 0.01).tolist()
except ImportError:  # pragma: no cover
    _G101 = _G100 = _G91 = []

_BEST_COLS = "i, tau, tp, fp, fn, tn, cost"
_ROUND_CURVE = ["tau", "cost"]

ORACLE["minmax_scale"] = rounded(gold_sql("""
SELECT sales, weekly_ts, CASE WHEN s.mx - s.mn = 0 THEN 0.5::DOUBLE
  ELSE (average_montly_hours_mean - s.mn) / (s.mx - s.mn) END AS hours_scaled
FROM dwl, (SELECT MIN(average_montly_hours_mean) AS mn, MAX(average_montly_hours_mean) AS mx FROM dwl) s"""),
    ["hours_scaled"])
ORACLE["anomaly_scaled"] = rounded(scored_sql("SELECT sales, weekly_ts, anomaly_score FROM anom"), ["anomaly_score"])
ORACLE["fused_scores"] = rounded(scored_sql(
    "SELECT EmployeeID, supervised_score, anomaly_score, fused_score FROM scored"),
    ["supervised_score", "anomaly_score", "fused_score"])
ORACLE["fused_scores_max"] = rounded(scored_sql("SELECT EmployeeID, fused_max_score FROM scored"),
                                     ["fused_max_score"])
ORACLE["dept_week_risk"] = rounded(scored_sql("""
SELECT sales, weekly_ts, AVG(fused_score) AS risk_score FROM scored
WHERE sales IS NOT NULL AND weekly_ts IS NOT NULL GROUP BY sales, weekly_ts"""), ["risk_score"])
ORACLE["class_weight"] = rounded(hr_sql("""
SELECT neg, pos, GREATEST(1e0, CAST(neg AS DOUBLE) / CAST(GREATEST(pos, 1) AS DOUBLE)) AS scale_pos_weight
FROM (SELECT COUNT(*) FILTER (WHERE left_flag = 0) AS neg, COUNT(*) FILTER (WHERE left_flag = 1) AS pos FROM hr) c"""),
    ["scale_pos_weight"])
ORACLE["decisions_at_tau"] = hr_sql("""
SELECT EmployeeID, CAST(CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS INT) AS decision_strict,
  CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS INT) AS decision_inclusive FROM hr""")

_CONF = """
conf AS (
  SELECT COUNT(*) FILTER (WHERE left_flag = 0 AND NOT score > 0.5) AS tn,
         COUNT(*) FILTER (WHERE left_flag = 0 AND score > 0.5) AS fp,
         COUNT(*) FILTER (WHERE left_flag = 1 AND NOT score > 0.5) AS fn,
         COUNT(*) FILTER (WHERE left_flag = 1 AND score > 0.5) AS tp FROM hr)"""
_METRICS = """CASE WHEN tp + fp = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1_score"""
ORACLE["confusion_counts"] = hr_sql("SELECT * FROM conf", _CONF)
ORACLE["misclassification_cost"] = hr_sql("SELECT *, 10e0 * fn + 1e0 * fp AS cost FROM conf", _CONF)
ORACLE["classification_metrics"] = rounded(hr_sql(f"SELECT *, {_METRICS} FROM conf", _CONF),
                                           ["precision", "recall", "f1_score"])

ORACLE["cost_curve"] = rounded(scored_sql("SELECT * FROM curve_c", _grid_cte("grid", _G101),
                                          _curve_cte("curve", "grid", "fused_score", ">=")), _ROUND_CURVE)
ORACLE["best_tau_grid101"] = rounded(scored_sql(
    f"SELECT {_BEST_COLS} FROM curve_c ORDER BY cost, i LIMIT 1",
    _grid_cte("grid", _G101), _curve_cte("curve", "grid", "fused_score", ">=")), _ROUND_CURVE)
ORACLE["best_tau_grid100"] = rounded(scored_sql(
    f"SELECT {_BEST_COLS} FROM curve_c ORDER BY cost, i LIMIT 1",
    _grid_cte("grid", _G100), _curve_cte("curve", "grid", "fused_score", ">")), _ROUND_CURVE)
ORACLE["best_tau_grid91"] = rounded(scored_sql(
    f"SELECT {_BEST_COLS} FROM curve_c ORDER BY cost, i LIMIT 1",
    _grid_cte("grid", _G91), _curve_cte("curve", "grid", "fused_score", ">=")), _ROUND_CURVE)

_HIST = """
h AS (SELECT score, CAST(SUM(CASE WHEN left_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
              CAST(SUM(CASE WHEN left_flag = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM hr GROUP BY score)"""
ORACLE["tau_unique_scores"] = rounded(hr_sql("""
SELECT tau, fn, fp, 10e0 * fn + 1e0 * fp AS cost FROM (
  SELECT score AS tau, CAST(SUM(pos) OVER (ORDER BY score) - pos AS BIGINT) AS fn,
    CAST((SELECT SUM(neg) FROM h) - (SUM(neg) OVER (ORDER BY score) - neg) AS BIGINT) AS fp FROM h) c
ORDER BY cost, tau LIMIT 1""", _HIST), ["tau", "cost"])
ORACLE["auroc"] = rounded(hr_sql("""
SELECT CAST(SUM(neg * (2 * ((SELECT SUM(pos) FROM h) - cum_pos) + pos)) AS DOUBLE)
  / CAST(2 * (SELECT SUM(pos) FROM h) * (SELECT SUM(neg) FROM h) AS DOUBLE) AS auroc
FROM (SELECT *, SUM(pos) OVER (ORDER BY score) AS cum_pos FROM h) c""", _HIST), ["auroc"])
ORACLE["average_precision"] = rounded(hr_sql("""
SELECT SUM(CASE WHEN pos > 0 THEN CAST(pos AS DOUBLE) * (CAST(tp_ge AS DOUBLE) / CAST(tp_ge + fp_ge AS DOUBLE)) END)
  / CAST((SELECT SUM(pos) FROM h) AS DOUBLE) AS average_precision
FROM (SELECT *, SUM(pos) OVER (ORDER BY score DESC) AS tp_ge, SUM(neg) OVER (ORDER BY score DESC) AS fp_ge FROM h) c""",
    _HIST), ["average_precision"])

_UNI = dbl_list(_np.linspace(0.0, 1.0, 11)[1:-1].tolist())
ORACLE["calibration_uniform"] = rounded(hr_sql(f"""
SELECT CAST(len(list_filter({_UNI}, lambda e: e < score)) AS INT) AS bin, COUNT(*) AS n,
  AVG(score) AS mean_pred, AVG(CAST(left_flag AS DOUBLE)) AS frac_pos FROM hr GROUP BY 1"""),
    ["mean_pred", "frac_pos"])
_QPROBS = "[" + ", ".join(f"'{i / 10!r}'::DOUBLE" for i in range(1, 10)) + "]"
ORACLE["calibration_quantile"] = rounded(hr_sql(f"""
SELECT CAST(len(list_filter(q.edges, lambda e: e < score)) AS INT) AS bin, COUNT(*) AS n,
  AVG(score) AS mean_pred, AVG(CAST(left_flag AS DOUBLE)) AS frac_pos
FROM hr, (SELECT quantile_cont(score, {_QPROBS}) AS edges FROM hr) q GROUP BY 1"""), ["mean_pred", "frac_pos"])
ORACLE["brier_score"] = rounded(hr_sql("""
SELECT CASE WHEN MIN(left_flag) <> MAX(left_flag)
  THEN AVG((score - CAST(left_flag AS DOUBLE)) * (score - CAST(left_flag AS DOUBLE))) END AS brier FROM hr"""),
    ["brier"])

_LONG = """
long_s AS (
  SELECT 'supervised_score' AS model, supervised_score AS s, left_flag FROM scored
  UNION ALL SELECT 'anomaly_score', anomaly_score, left_flag FROM scored
  UNION ALL SELECT 'fused_score', fused_score, left_flag FROM scored)"""
_BENCH = f"""
bt AS (SELECT tau FROM curve_c ORDER BY cost, i LIMIT 1),
bench AS (
  SELECT upper(substr(replace(model, '_score', ''), 1, 1)) || lower(substr(replace(model, '_score', ''), 2)) AS model,
    (SELECT tau FROM bt) AS threshold, {_METRICS}
  FROM (SELECT model,
          COUNT(*) FILTER (WHERE left_flag = 1 AND s > (SELECT tau FROM bt)) AS tp,
          COUNT(*) FILTER (WHERE left_flag <> 1 AND s > (SELECT tau FROM bt)) AS fp,
          COUNT(*) FILTER (WHERE left_flag = 1 AND NOT s > (SELECT tau FROM bt)) AS fn
        FROM long_s GROUP BY model) c)"""
ORACLE["benchmark_table"] = rounded(scored_sql(
    "SELECT * FROM bench", _grid_cte("grid", _G101), _curve_cte("curve", "grid", "fused_score", ">="), _LONG, _BENCH),
    ["threshold", "precision", "recall", "f1_score"])
ORACLE["benchmark_kpi"] = rounded(scored_sql(
    "SELECT * FROM bench WHERE lower(model) = 'fused'", _grid_cte("grid", _G101),
    _curve_cte("curve", "grid", "fused_score", ">="), _LONG, _BENCH),
    ["threshold", "precision", "recall", "f1_score"])
ORACLE["benchmark_enhanced"] = rounded(scored_sql(f"""
SELECT model AS model_variant, tau AS threshold, {_METRICS}, CAST(cost AS BIGINT) AS total_cost,
  CASE WHEN model = 'supervised_score' THEN 0e0
       ELSE ((SELECT cost FROM best WHERE model = 'supervised_score') - cost)
            / (SELECT cost FROM best WHERE model = 'supervised_score') * 100e0 END AS cost_reduction_pct
FROM best""", _grid_cte("grid", _G100), _LONG, """
mcurve AS (
  SELECT s.model, g.i, g.tau,
    CAST(SUM(CASE WHEN s.s > g.tau AND s.left_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    CAST(SUM(CASE WHEN s.s > g.tau AND s.left_flag <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(SUM(CASE WHEN NOT (s.s > g.tau) AND s.left_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM grid g, long_s s GROUP BY s.model, g.i, g.tau),
best AS (
  SELECT model, arg_min(tau, cost * 1000 + i) AS tau, arg_min(tp, cost * 1000 + i) AS tp,
    arg_min(fp, cost * 1000 + i) AS fp, arg_min(fn, cost * 1000 + i) AS fn, MIN(cost) AS cost
  FROM (SELECT *, 10e0 * fn + 1e0 * fp AS cost FROM mcurve) x GROUP BY model)"""),
    ["threshold", "precision", "recall", "f1_score", "cost_reduction_pct"])


# ------------------------------------------------------------------ fairness
def sql_units(expr: str, digits: int) -> str:
    """|expr| * 10**digits to the nearest whole number; ties exact in binary go to the even one."""
    x = f"ABS(ROUND({expr}, 9))"
    s = f"{x} * {10 ** digits}e0"
    bits = f"{x} * {2 ** (digits + 1)}e0"
    return (f"CAST(CASE WHEN {s} - FLOOR({s}) = 0.5e0 AND {bits} = FLOOR({bits}) AND CAST(FLOOR({s}) AS BIGINT) % 2 = 0 "
            f"THEN FLOOR({s}) ELSE FLOOR({s} + 0.5e0) END AS BIGINT)")


def sql_round(expr: str, digits: int) -> str:
    return f"SIGN(ROUND({expr}, 9)) * {sql_units(expr, digits)} / {10 ** digits}e0"


def sql_fixed(expr: str, digits: int) -> str:
    scale = 10 ** digits
    q = sql_units(expr, digits)
    return (f"(CASE WHEN ({expr}) < 0 AND {q} > 0 THEN '-' ELSE '' END || CAST({q} // {scale} AS VARCHAR) || '.' "
            f"|| lpad(CAST({q} % {scale} AS VARCHAR), {digits}, '0'))")


_PRED = "p AS (SELECT *, CAST(CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS INT) AS pred FROM hr)"
_GP_P = "p AS (SELECT *, y_true AS left_flag, y_pred AS pred FROM group_preds)"


def _parity(g: str) -> str:
    return f"""SELECT {g}, AVG(CAST(pred AS DOUBLE)) AS positive_rate,
  ABS(AVG(CAST(pred AS DOUBLE)) - (SELECT AVG(CAST(pred AS DOUBLE)) FROM p)) AS parity_difference,
  COUNT(*) AS sample_size FROM p GROUP BY {g}"""


def _odds(g: str) -> str:
    return f"""SELECT {g},
  CASE WHEN tp + fn = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS true_positive_rate,
  CASE WHEN fp + tn = 0 THEN 0e0 ELSE CAST(fp AS DOUBLE) / CAST(fp + tn AS DOUBLE) END AS false_positive_rate,
  CAST(tp + tn AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy
FROM (SELECT {g}, COUNT(*) AS n,
  COUNT(*) FILTER (WHERE left_flag = 1 AND pred = 1) AS tp, COUNT(*) FILTER (WHERE left_flag = 0 AND pred = 1) AS fp,
  COUNT(*) FILTER (WHERE left_flag = 1 AND pred = 0) AS fn, COUNT(*) FILTER (WHERE left_flag = 0 AND pred = 0) AS tn
  FROM p GROUP BY {g}) c WHERE tp + fn > 0 AND fp + tn > 0"""


def _summary(g: str) -> str:
    return f"""SELECT AVG(CASE WHEN left_flag = pred THEN 1e0 ELSE 0e0 END) AS accuracy,
  AVG(CAST(pred AS DOUBLE)) AS positive_rate, AVG(CAST(left_flag AS DOUBLE)) AS base_rate,
  (SELECT MAX(parity_difference) FROM ({_parity(g)}) x) AS max_parity_difference,
  (SELECT MAX(parity_difference) FROM ({_parity(g)}) x) > 0.05 AS fairness_violation FROM p"""


_PAR_D = ["positive_rate", "parity_difference"]
_ODDS_D = ["true_positive_rate", "false_positive_rate", "accuracy"]
_SUM_D = ["accuracy", "positive_rate", "base_rate", "max_parity_difference"]
for _g in ("sales", "salary"):
    ORACLE[f"fairness_parity_{_g}"] = rounded(hr_sql(_parity(_g), _PRED), _PAR_D)
    ORACLE[f"fairness_odds_{_g}"] = rounded(hr_sql(_odds(_g), _PRED), _ODDS_D)
    ORACLE[f"fairness_summary_{_g}"] = rounded(hr_sql(_summary(_g), _PRED), _SUM_D)

_GP_SQL = lambda body, *extra: with_ctes(GROUP_PREDS_CTE, *extra, body=body)
ORACLE["fairness_parity_lang"] = rounded(_GP_SQL(_parity("grp"), _GP_P), _PAR_D)
ORACLE["fairness_odds_lang"] = rounded(_GP_SQL(_odds("grp"), _GP_P), _ODDS_D)
ORACLE["fairness_summary_lang"] = rounded(_GP_SQL(_summary("grp"), _GP_P), _SUM_D)

_BIAS_ROWS = f"""
dims AS (
  SELECT 'department' AS dimension, max_parity_difference, fairness_violation,
    CASE WHEN fairness_violation THEN 'ALERT: Department bias detected. Max parity difference: '
      || {sql_fixed('max_parity_difference', 3)} END AS recommendation FROM ({_summary('sales')}) a
  UNION ALL
  SELECT 'salary', max_parity_difference, fairness_violation,
    CASE WHEN fairness_violation THEN 'ALERT: Salary-based bias detected. Max parity difference: '
      || {sql_fixed('max_parity_difference', 3)} END FROM ({_summary('salary')}) b)"""
ORACLE["bias_report"] = rounded(hr_sql("""
SELECT * FROM dims UNION ALL
SELECT 'all', CAST(NULL AS DOUBLE), FALSE, 'No significant bias detected. Model meets fairness criteria.'
FROM (SELECT SUM(CAST(fairness_violation AS INT)) AS v FROM dims) s WHERE v = 0""", _PRED, _BIAS_ROWS),
    ["max_parity_difference"])


def _audit_sql(src: str, group_expr: str, group_name: str) -> tuple[str, ...]:
    h = f"""ah AS (SELECT y_prob AS score, CAST(SUM(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
  CAST(SUM(CASE WHEN y_true = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM {src} GROUP BY y_prob)"""
    tau = """atau AS (SELECT tau FROM (
  SELECT score AS tau, 10e0 * (SUM(pos) OVER (ORDER BY score) - pos)
    + 1e0 * ((SELECT SUM(neg) FROM ah) - (SUM(neg) OVER (ORDER BY score) - neg)) AS cost FROM ah) c
  ORDER BY cost, tau LIMIT 1)"""
    counts = f"""ac AS (
  SELECT {group_expr} AS {group_name}, COUNT(*) AS n,
    COUNT(*) FILTER (WHERE y_true = 1 AND y_prob >= (SELECT tau FROM atau)) AS tp,
    COUNT(*) FILTER (WHERE y_true = 0 AND y_prob >= (SELECT tau FROM atau)) AS fp,
    COUNT(*) FILTER (WHERE y_true = 1 AND NOT y_prob >= (SELECT tau FROM atau)) AS fn,
    COUNT(*) FILTER (WHERE y_true = 0 AND NOT y_prob >= (SELECT tau FROM atau)) AS tn,
    CASE WHEN MIN(y_true) <> MAX(y_true) THEN AVG((y_prob - CAST(y_true AS DOUBLE)) * (y_prob - CAST(y_true AS DOUBLE))) END AS brier
  FROM {src} GROUP BY 1)"""
    metrics = f"""am AS (
  SELECT {group_name}, n,
    CASE WHEN n = 0 THEN 0e0 ELSE CAST(tp + fn AS DOUBLE) / CAST(n AS DOUBLE) END AS prevalence,
    CASE WHEN tp + fn = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS recall,
    1e0 - CASE WHEN tp + fn = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS fnr,
    CASE WHEN tp + fp = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS precision,
    CAST(fp AS DOUBLE) / CAST(GREATEST(fp + tn, 1) AS DOUBLE) AS fpr, brier FROM ac)"""
    return h, tau, counts, metrics


_AUD_D = ["prevalence", "recall", "fnr", "precision", "fpr", "brier"]
ORACLE["fairness_group_metrics"] = rounded(_GP_SQL("SELECT * FROM am", *_audit_sql("group_preds", "grp", "grp")),
                                           _AUD_D)
ORACLE["fairness_overall"] = rounded(_GP_SQL("SELECT recall, fnr, precision, fpr, brier FROM am",
                                             *_audit_sql("group_preds", "'all'", "grp")), _AUD_D[1:])
ORACLE["fairness_fnr_gap"] = rounded(_GP_SQL(
    "SELECT MAX(fnr) - MIN(fnr) AS fnr_gap, COALESCE(MAX(fnr) - MIN(fnr) > 0.05, FALSE) AS failed FROM am",
    *_audit_sql("group_preds", "grp", "grp")), ["fnr_gap"])
ORACLE["fairness_audit_predictions"] = rounded(_GP_SQL(
    "SELECT * FROM am", *_audit_sql("group_preds", "'unknown'", "dept")), _AUD_D)

# ------------------------------------------------------------------ sources
ORACLE["raw_load"] = rounded(hr_sql("""
SELECT satisfaction_level, last_evaluation, number_project, average_montly_hours, time_spend_company,
  Work_accident, left_flag, promotion_last_5years, sales, salary FROM hr"""),
    ["satisfaction_level", "last_evaluation"])
ORACLE["preview_top_rows"] = rounded(hr_sql(
    "SELECT *, (SELECT COUNT(*) FROM hr) AS n_rows FROM hr ORDER BY EmployeeID LIMIT 50"),
    ["satisfaction_level", "last_evaluation", "score"])
_TABLE_COLS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
               "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
               "conversations": 4}
ORACLE["dataset_manifest"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, COUNT(*) AS n_rows, "
    f"(SELECT CAST(COUNT(*) AS INT) FROM (DESCRIBE SELECT * FROM {t})) AS n_columns FROM {t}"
    for t in _TABLE_COLS)
ORACLE["run_manifest"] = f"SELECT *, '10' AS fn_weight FROM ({ORACLE['dataset_manifest']}) m"
ORACLE["bias_report_file"] = ORACLE["bias_report"]


ORACLE["threshold_lookup"] = rounded(scored_sql(
    "SELECT tau AS threshold FROM curve_c ORDER BY cost, i LIMIT 1", _grid_cte("grid", _G101),
    _curve_cte("curve", "grid", "fused_score", ">=")), ["threshold"])
ORACLE["stratified_split"] = hr_sql("""
SELECT EmployeeID, left_flag, CASE WHEN place <= ROUND(size * 0.3e0) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT EmployeeID, left_flag, COUNT(*) OVER (PARTITION BY left_flag) AS size,
    ROW_NUMBER() OVER (PARTITION BY left_flag ORDER BY md5('42|' || CAST(EmployeeID AS VARCHAR)), EmployeeID) AS place
  FROM hr) x""")
# biggest group first, each to the lightest fold so far: one recursion step per group
ORACLE["dataset_changes"] = hr_sql("""
SELECT 'sales=BUILDING' AS partition, change, 1::BIGINT AS files, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM hr, (VALUES ('removed'), ('added')) t(change) WHERE sales = 'BUILDING' GROUP BY change""")

ORACLE["group_folds"] = "WITH RECURSIVE " + hr_sql("""
SELECT sales, CAST(fold AS INT) AS fold, n FROM deal WHERE place > 0""", """
sizes AS (SELECT sales, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, sales) AS place FROM hr GROUP BY sales),
deal AS (
  SELECT CAST(NULL AS VARCHAR) AS sales, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS place, CAST(-1 AS BIGINT) AS fold,
         [CAST(0 AS BIGINT), 0, 0, 0, 0] AS load
  UNION ALL
  SELECT s.sales, s.n, s.place, list_position(d.load, list_min(d.load)) - 1,
         list_transform(d.load, lambda x, i: CASE WHEN i = list_position(d.load, list_min(d.load)) THEN x + s.n ELSE x END)
  FROM deal d JOIN sizes s ON s.place = d.place + 1)""")[5:]


# ------------------------------------------------------------------ every defect at once
_RULES = [("satisfaction_level", "BETWEEN 0 AND 1"), ("last_evaluation", "BETWEEN 0 AND 1"), ("number_project", "BETWEEN 0 AND 20"),
          ("average_montly_hours", "BETWEEN 0 AND 400"), ("time_spend_company", "BETWEEN 0 AND 50"), ("Work_accident", "IN (0, 1)"),
          ("promotion_last_5years", "IN (0, 1)"), ("salary", "IN ('low', 'medium', 'high')")]
ORACLE["quality_all_rules"] = hr_sql("""
SELECT 'range' AS check_kind, CAST(seq AS INT) AS seq, column_name, bad_count,
  column_name || ': ' || CAST(bad_count AS VARCHAR) || ' bad' AS message FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT {20 + i} AS seq, '{c}' AS column_name, COUNT(*) FILTER (WHERE ({c} {rule}) IS NOT TRUE) AS bad_count FROM hr_wide"
    for i, (c, rule) in enumerate(_RULES)) + ") x WHERE bad_count > 0", HR_WIDE_CTE)
ORACLE["quality_verdict_clean"] = hr_sql("SELECT CAST(0 AS BIGINT) AS n_errors, TRUE AS passed, '' AS errors FROM (SELECT COUNT(*) FROM hr) x")
ORACLE["row_sequence_by_week"] = hr_sql("""
SELECT EmployeeID, weekly_ts, ROW_NUMBER() OVER (ORDER BY weekly_ts ASC NULLS FIRST, EmployeeID) - 1 AS row_id FROM hr_wide""",
                                        HR_WIDE_CTE)
_PASSES = "(s.score IS NOT NULL AND NOT isnan(s.score) AND s.score >= g.tau)"
ORACLE["cost_curve_dirty"] = rounded(hr_sql(f"""
SELECT *, 10e0 * fn + 1e0 * fp AS cost FROM (
  SELECT g.i, g.tau, COUNT(*) FILTER (WHERE {_PASSES} AND left_flag = 1) AS tp, COUNT(*) FILTER (WHERE {_PASSES} AND left_flag = 0) AS fp,
    COUNT(*) FILTER (WHERE NOT {_PASSES} AND left_flag = 1) AS fn, COUNT(*) FILTER (WHERE NOT {_PASSES} AND left_flag = 0) AS tn
  FROM grid g, hr_wide s GROUP BY g.i, g.tau) c""", HR_WIDE_CTE, _grid_cte("grid", _G101)), ["tau", "cost"])
_SKEWED = "p AS (SELECT *, CAST(CASE WHEN score > 0.5 OR sales = 'BUILDING' OR salary = 'high' THEN 1 ELSE 0 END AS INT) AS pred FROM hr)"
ORACLE["bias_report_alerts"] = rounded(hr_sql("SELECT * FROM dims", _SKEWED, _BIAS_ROWS), ["max_parity_difference"])


def _batch_sql(src: str, *extra: str) -> str:
    return hr_sql(f"""
SELECT *, '' AS missing_columns, CASE WHEN worst > 0.05e0 THEN 'rejected' WHEN issues > 0 THEN 'accepted with warnings' ELSE 'accepted' END AS outcome
FROM (SELECT n_rows, null_timestamps, null_labels, unknown_salary, unknown_sales, duplicate_rows FROM b) x
CROSS JOIN (SELECT null_timestamps + null_labels + unknown_salary + unknown_sales + duplicate_rows AS issues,
  GREATEST(null_timestamps, null_labels, unknown_salary, unknown_sales, duplicate_rows) / CAST(n_rows AS DOUBLE) AS worst FROM b) y""", *extra, f"""
b AS (SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE weekly_ts IS NULL) AS null_timestamps,
    COUNT(*) FILTER (WHERE left_flag IS NULL) AS null_labels,
    COUNT(*) FILTER (WHERE NOT COALESCE(salary IN ('low', 'medium', 'high'), FALSE)) AS unknown_salary,
    COUNT(*) FILTER (WHERE NOT COALESCE(sales IN (SELECT DISTINCT sales FROM hr WHERE sales IS NOT NULL), FALSE)) AS unknown_sales,
    CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {src}) d) AS BIGINT) AS duplicate_rows FROM {src})""")


ORACLE["batch_verdict_clean"] = f"SELECT * EXCLUDE (issues, worst) FROM ({_batch_sql('hr')}) z"
ORACLE["batch_verdict_warnings"] = f"SELECT * EXCLUDE (issues, worst) FROM ({_batch_sql('hr_wide', HR_WIDE_CTE)}) z"
ORACLE["fairness_report_values"] = rounded(_GP_SQL("""
SELECT (SELECT tau FROM atau) AS tau, 10e0 AS fn_weight, 'overall' AS grp, o.n, o.recall, o.fnr, o.precision, o.fpr, o.brier FROM (
  SELECT CAST(NULL AS BIGINT) AS n, recall, fnr, precision, fpr, brier FROM am_all) o
UNION ALL
SELECT (SELECT tau FROM atau), 10e0, grp, n, recall, fnr, precision, fpr, brier FROM am""",
    *_audit_sql("group_preds", "grp", "grp"),
    _audit_sql("group_preds", "'all'", "grp")[2].replace("ac AS (", "ac_all AS (", 1),
    _audit_sql("group_preds", "'all'", "grp")[3].replace("am AS (", "am_all AS (", 1).replace("FROM ac)", "FROM ac_all)")),
    ["tau", "recall", "fnr", "precision", "fpr", "brier"])


# ------------------------------------------------------------------ alerts and text
_PHRASES = [("v1_overtime_sum", "overtime pressure"),
            ("v2_overload_satisfaction_sum", "high workload with low satisfaction"),
            ("v3_stagnation_sum", "career stagnation"),
            ("v4_post_accident_overwork_sum", "post-accident overwork pattern"),
            ("violation_density", "elevated violation density"),
            ("average_montly_hours_mean", "high average monthly hours"),
            ("time_spend_company_mean", "long tenure concentration"),
            ("satisfaction_level_mean", "lower average satisfaction"),
            ("attrition_rate", "elevated attrition rate"),
            ("leavers", "higher number of leavers")]
_PHRASE_CASE = "CASE lower(d) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _PHRASES) + \
    " ELSE replace(lower(d), '_', ' ') END"

_ALERT_CTES = f"""
risk AS (SELECT sales, weekly_ts, AVG(fused_score) AS risk_score FROM scored
         WHERE sales IS NOT NULL AND weekly_ts IS NOT NULL GROUP BY sales, weekly_ts),
ctx AS (SELECT risk.*, dwl.headcount, dwl.leavers, dwl.attrition_rate, dwl.satisfaction_level_mean,
          dwl.average_montly_hours_mean, dwl.time_spend_company_mean, dwl.v1_overtime_sum,
          dwl.v2_overload_satisfaction_sum, dwl.v3_stagnation_sum, dwl.v4_post_accident_overwork_sum,
          dwl.violation_density
        FROM risk LEFT JOIN dwl ON risk.sales = dwl.sales AND risk.weekly_ts = dwl.weekly_ts),
drv AS (SELECT *, list_filter([
    CASE WHEN ROUND(CAST(attrition_rate AS DOUBLE), 9) >= 0.25 THEN 'attrition_rate' END,
    CASE WHEN ROUND(CAST(average_montly_hours_mean AS DOUBLE), 9) >= 210 THEN 'average_montly_hours_mean' END,
    CASE WHEN ROUND(CAST(satisfaction_level_mean AS DOUBLE), 9) <= 0.45 THEN 'satisfaction_level_mean' END,
    CASE WHEN ROUND(CAST(time_spend_company_mean AS DOUBLE), 9) >= 4 THEN 'time_spend_company_mean' END,
    CASE WHEN ROUND(CAST(v1_overtime_sum AS DOUBLE), 9) > 0 THEN 'v1_overtime_sum' END,
    CASE WHEN ROUND(CAST(v2_overload_satisfaction_sum AS DOUBLE), 9) > 0 THEN 'v2_overload_satisfaction_sum' END,
    CASE WHEN ROUND(CAST(v3_stagnation_sum AS DOUBLE), 9) > 0 THEN 'v3_stagnation_sum' END,
    CASE WHEN ROUND(CAST(v4_post_accident_overwork_sum AS DOUBLE), 9) > 0 THEN 'v4_post_accident_overwork_sum' END,
    CASE WHEN ROUND(CAST(violation_density AS DOUBLE), 9) > 0 THEN 'violation_density' END], lambda x: x IS NOT NULL) AS hits FROM ctx),
drv2 AS (SELECT *, CASE WHEN len(hits) = 0 THEN ['fused_score_pattern'] ELSE hits[1:5] END AS top_drivers FROM drv),
bt AS (SELECT tau FROM curve_c ORDER BY cost, i LIMIT 1),
alerts AS (
  SELECT sales AS dept, strftime(weekly_ts, '%Y-%m-%d') AS weekly_ts, CAST(headcount AS BIGINT) AS headcount,
    CAST(leavers AS BIGINT) AS leavers, CAST(attrition_rate AS DOUBLE) AS attrition_rate,
    {sql_round("risk_score", 4)} AS risk_score,
    {sql_round("(SELECT tau FROM bt)", 4)} AS threshold,
    top_drivers, risk_score > (SELECT tau FROM bt) AS warning,
    'Simulated weekly monitoring on HR prototype data.' AS notes
  FROM drv2),
phr AS (SELECT *, list_transform(top_drivers[1:5], lambda d: {_PHRASE_CASE}) AS phrases FROM alerts)"""


def _alert_sql(body: str) -> str:
    return scored_sql(body, _grid_cte("grid", _G101), _curve_cte("curve", "grid", "fused_score", ">="), _ALERT_CTES)


_SUMMARY = ("'Department ' || dept || ' for week ' || weekly_ts || ' was scored by the early-warning layer.'"
            " || chr(10) || 'Risk score is ' || " + sql_fixed("risk_score", 3) + " || ' against threshold ' || "
            + sql_fixed("threshold", 3) + " || '. Warning status: ' || CASE WHEN warning THEN 'triggered' "
            "ELSE 'not triggered' END || '.'"
            " || COALESCE(chr(10) || 'Context: ' || array_to_string(list_filter(["
            "'headcount ' || CAST(headcount AS VARCHAR), 'leavers ' || CAST(leavers AS VARCHAR), "
            "CASE WHEN attrition_rate IS NOT NULL THEN 'attrition rate ' || " + sql_fixed("attrition_rate * 100e0", 1)
            + " || '%' END], lambda x: x IS NOT NULL), ', ') || '.', '')"
            " || CASE WHEN len(phrases) = 1 THEN chr(10) || 'Primary driver appears to be ' || phrases[1] || '.'"
            " WHEN len(phrases) > 1 THEN chr(10) || 'Main drivers appear to be ' || array_to_string(phrases[1:len(phrases)-1], ', ')"
            " || ', and ' || phrases[len(phrases)] || '.' ELSE '' END"
            " || chr(10) || 'Additional note: ' || notes"
            " || chr(10) || 'This summary is advisory only. Any HR action requires human review and confirmation.'")

_ALERT_D = ["attrition_rate", "risk_score", "threshold"]
ORACLE["alert_context"] = rounded(_alert_sql("SELECT * FROM ctx"),
                                  ["risk_score", "attrition_rate", "satisfaction_level_mean",
                                   "average_montly_hours_mean", "time_spend_company_mean", "violation_density"])
ORACLE["top_drivers"] = _alert_sql("SELECT sales, weekly_ts, array_to_string(top_drivers, '|') AS top_drivers FROM drv2")
ORACLE["alert_records"] = rounded(_alert_sql(
    "SELECT * REPLACE (array_to_string(top_drivers, '|') AS top_drivers) FROM alerts"), _ALERT_D)
ORACLE["sanitized_alerts"] = ORACLE["alert_records"]
ORACLE["driver_phrases"] = _alert_sql("SELECT dept, weekly_ts, array_to_string(phrases, '|') AS phrases FROM phr")
ORACLE["alert_summaries"] = _alert_sql(f"SELECT dept, weekly_ts, {_SUMMARY} AS summary FROM phr")
ORACLE["summary_lines"] = _alert_sql("""
SELECT dept, weekly_ts, CAST(UNNEST(range(len(lines))) AS INT) AS line_no, UNNEST(lines) AS line FROM (
  SELECT dept, weekly_ts, [
    'Department ' || dept || ' for week ' || weekly_ts || ' was scored by the early-warning layer.',
    'Risk score is n/a against threshold n/a. Warning status: triggered.',
    CASE WHEN len(phrases) = 1 THEN 'Primary driver appears to be ' || phrases[1] || '.'
         ELSE 'Main drivers appear to be ' || array_to_string(phrases[1:len(phrases)-1], ', ')
              || ', and ' || phrases[len(phrases)] || '.' END,
    'This summary is advisory only. Any HR action requires human review and confirmation.'] AS lines
  FROM phr) x""")
ORACLE["notices"] = rounded(_alert_sql(f"""
SELECT sales AS dept, strftime(weekly_ts, '%Y-%m-%d') AS week,
  {sql_round("risk_score", 4)} AS score, risk_score > (SELECT tau FROM bt) AS notice
FROM risk"""), ["score"])
ORACLE["employee_alerts"] = rounded(_alert_sql("""
SELECT EmployeeID AS employee_id, sales AS department, strftime(weekly_ts, '%Y-%m-%d') AS week,
  fused_score, (SELECT tau FROM bt) AS threshold,
  CASE WHEN fused_score > (SELECT tau FROM bt) THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level,
  fused_score > (SELECT tau FROM bt) AS action_required
FROM scored WHERE fused_score > (SELECT tau FROM bt) * 0.8e0"""), ["fused_score", "threshold"])

_WS = ("[\\x{0009}-\\x{000D}\\x{001C}-\\x{0020}\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}"
       "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
ORACLE["sanitized_text"] = f"""
SELECT doc_id, clipped, CAST(length(clipped) AS BIGINT) AS clipped_len FROM (
  SELECT doc_id, substring(regexp_replace(replace(replace(text, chr(13), ' '), chr(10), ' '),
    '^{_WS}+|{_WS}+$', '', 'g'), 1, 500) AS clipped FROM documents) x"""


# ------------------------------------------------------------------ streaming
ORACLE["stream_weekly_risk"] = rounded("""
SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start, event_type, COUNT(*) AS n,
  AVG(value) AS avg_value, SUM(value) AS sum_value
FROM events GROUP BY 1, 2""", ["avg_value", "sum_value"])
ORACLE["stream_weekly_closing"] = rounded("""
SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start, event_type, COUNT(*) AS n,
  AVG(value) AS avg_value, SUM(value) AS sum_value,
  date_trunc('week', ts) + INTERVAL 7 DAY <= (SELECT date_trunc('millisecond', MAX(ts)) FROM events) AS closed
FROM events GROUP BY ALL""", ["avg_value", "sum_value"])
ORACLE["stream_weekly_alerts"] = rounded(_alert_sql(f"""
SELECT * EXCLUDE (phrases) REPLACE (array_to_string(top_drivers, '|') AS top_drivers) FROM (
  SELECT alerts.*, {_SUMMARY} AS summary FROM phr AS alerts) a"""), _ALERT_D)


# ------------------------------------------------------------------ drift
_PER = "per AS (SELECT *, CASE WHEN weekly_ts < TIMESTAMP '1998-05-01' THEN 'baseline' ELSE 'current' END AS period FROM hr)"
_DCOLS = ["satisfaction_level", "last_evaluation", "number_project", "average_montly_hours", "time_spend_company",
          "score"]


def _b(c):
    return f"CASE WHEN period = 'baseline' THEN CAST({c} AS DOUBLE) END"


def _c(c):
    return f"CASE WHEN period = 'current' THEN CAST({c} AS DOUBLE) END"


_NUM_DRIFT = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, bm AS baseline_mean, cm AS current_mean, bs AS baseline_std, cs AS current_std,
  cm - bm AS mean_diff, CASE WHEN ABS(bm) = 0 THEN NULL ELSE (cm - bm) / ABS(bm) END AS rel_change,
  CASE WHEN bs = 0 THEN NULL ELSE cs / bs END AS std_ratio
FROM (SELECT AVG({_b(c)}) AS bm, STDDEV_SAMP({_b(c)}) AS bs, AVG({_c(c)}) AS cm, STDDEV_SAMP({_c(c)}) AS cs FROM per) x"""
    for c in _DCOLS)
ORACLE["drift_numeric"] = rounded(hr_sql(_NUM_DRIFT, _PER),
                                  ["baseline_mean", "current_mean", "baseline_std", "current_std", "mean_diff",
                                   "rel_change", "std_ratio"])


def _cat_sql(col: str) -> str:
    return f"""
SELECT '{col}' AS feature, category, n_base, n_cur,
  CAST(n_base AS DOUBLE) / CAST(tb AS DOUBLE) AS baseline_share, CAST(n_cur AS DOUBLE) / CAST(tc AS DOUBLE) AS current_share,
  (GREATEST(CAST(n_cur AS DOUBLE) / CAST(tc AS DOUBLE), 1e-6) - GREATEST(CAST(n_base AS DOUBLE) / CAST(tb AS DOUBLE), 1e-6))
  * ln(GREATEST(CAST(n_cur AS DOUBLE) / CAST(tc AS DOUBLE), 1e-6) / GREATEST(CAST(n_base AS DOUBLE) / CAST(tb AS DOUBLE), 1e-6)) AS psi_term
FROM (SELECT COALESCE({col}, '<null>') AS category, COUNT(*) FILTER (WHERE period = 'baseline') AS n_base,
        COUNT(*) FILTER (WHERE period = 'current') AS n_cur FROM per GROUP BY 1) g,
     (SELECT COUNT(*) FILTER (WHERE period = 'baseline') AS tb, COUNT(*) FILTER (WHERE period = 'current') AS tc FROM per) t"""


_CAT = f"cat AS ({_cat_sql('sales')} UNION ALL {_cat_sql('salary')})"
ORACLE["drift_category"] = rounded(hr_sql("SELECT * FROM cat", _PER, _CAT),
                                   ["baseline_share", "current_share", "psi_term"])
ORACLE["drift_policy"] = rounded(hr_sql("""
SELECT feature, metric, value,
  CASE WHEN value > 0.25 THEN 'high' WHEN value > 0.1 THEN 'moderate' ELSE 'low' END AS level,
  CASE WHEN value > 0.25 THEN 'retrain and re-validate' WHEN value > 0.1 THEN 'review features and thresholds'
       ELSE 'monitor' END AS action
FROM (SELECT feature, 'rel_change' AS metric, ABS(rel_change) AS value FROM num
      UNION ALL SELECT feature, 'psi', SUM(psi_term) FROM cat GROUP BY feature) x""",
    _PER, _CAT, f"num AS ({_NUM_DRIFT})"), ["value"])
ORACLE["drift_distribution"] = rounded(scored_sql("""
SELECT feature, sales, n_base, n_cur, ks, ks_at, wasserstein, ks_critical, ks > ks_critical AS shifted FROM (
  SELECT feature, sales, CAST(any_value(nb) AS BIGINT) AS n_base, CAST(any_value(nc) AS BIGINT) AS n_cur, max(gap) AS ks,
    arg_min(x, (-round(gap, 12), x)) AS ks_at, sum(area) AS wasserstein,
    1.3581015157406195 * sqrt((any_value(nb) + any_value(nc))::DOUBLE / (any_value(nb)::DOUBLE * any_value(nc)::DOUBLE)) AS ks_critical
  FROM (
    SELECT *, gap * (coalesce(lead(x) OVER (PARTITION BY feature, sales ORDER BY x), x) - x) AS area FROM (
      SELECT feature, sales, x, sum(b) OVER g AS nb, sum(c) OVER g AS nc,
        abs(sum(b) OVER o / sum(b) OVER g - sum(c) OVER o / sum(c) OVER g) AS gap
      FROM (
        SELECT feature, sales, x, count(*) FILTER (WHERE period = 'baseline')::DOUBLE AS b, count(*) FILTER (WHERE period = 'current')::DOUBLE AS c
        FROM (
          SELECT sales, unnest(['score', 'anomaly_score', 'fused_score']) AS feature, unnest([score, anomaly_score, fused_score]::DOUBLE[]) AS x,
            CASE WHEN weekly_ts < TIMESTAMP '1998-05-01' THEN 'baseline' ELSE 'current' END AS period FROM scored) u
        WHERE x IS NOT NULL AND sales IS NOT NULL GROUP BY feature, sales, x) h
      WINDOW g AS (PARTITION BY feature, sales), o AS (PARTITION BY feature, sales ORDER BY x ROWS UNBOUNDED PRECEDING)) f) a
  GROUP BY feature, sales) t"""), ["ks", "ks_at", "wasserstein", "ks_critical"])

ORACLE["benchmark_heldout"] = rounded(scored_sql("""
SELECT part, model_variant, threshold, precision, recall, f1_score, CAST(cost AS BIGINT) AS total_cost,
  CASE WHEN model_variant = 'supervised_score' THEN 0e0
    ELSE (max(CASE WHEN model_variant = 'supervised_score' THEN cost END) OVER (PARTITION BY part) - cost)
      / max(CASE WHEN model_variant = 'supervised_score' THEN cost END) OVER (PARTITION BY part) * 100e0 END AS cost_reduction_pct
FROM (
  SELECT part, model_variant, threshold, 10e0 * fn + fp AS cost, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS recall,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END AS f1_score
  FROM (
    SELECT part, model_variant, threshold, count(*) FILTER (WHERE left_flag = 1 AND x > threshold) AS tp,
      count(*) FILTER (WHERE left_flag = 0 AND x > threshold) AS fp, count(*) FILTER (WHERE left_flag = 1 AND NOT x > threshold) AS fn
    FROM halves JOIN taus USING (model_variant) GROUP BY ALL) c) m""", """
halves AS (
  SELECT CASE WHEN EmployeeID % 2 = 1 THEN 'train' ELSE 'test' END AS part, left_flag,
    unnest(['supervised_score', 'anomaly_score', 'fused_score']) AS model_variant, unnest([supervised_score, anomaly_score, fused_score]) AS x
  FROM scored)""", _grid_cte("heldout_grid", K.grid_100()), """
taus AS (
  SELECT model_variant, arg_min(tau, (cost, i)) AS threshold FROM (
    SELECT model_variant, i, tau, 10 * count(*) FILTER (WHERE left_flag = 1 AND NOT x > tau) + count(*) FILTER (WHERE left_flag = 0 AND x > tau) AS cost
    FROM halves, heldout_grid WHERE part = 'train' GROUP BY model_variant, i, tau) t GROUP BY model_variant)"""),
    ["threshold", "precision", "recall", "f1_score", "cost_reduction_pct"])

ORACLE["drift_rates"] = rounded(scored_sql("""
SELECT *, attrition_cur - attrition_base AS attrition_shift, score_cur - score_base AS score_shift,
  anomaly_rate_cur - anomaly_rate_base AS anomaly_rate_shift FROM (
  SELECT sales,
    AVG(CASE WHEN period = 'baseline' THEN CAST(left_flag AS DOUBLE) END) AS attrition_base,
    AVG(CASE WHEN period = 'current' THEN CAST(left_flag AS DOUBLE) END) AS attrition_cur,
    AVG(CASE WHEN period = 'baseline' THEN fused_score END) AS score_base,
    AVG(CASE WHEN period = 'current' THEN fused_score END) AS score_cur,
    AVG(CASE WHEN period = 'baseline' THEN CASE WHEN anomaly_score >= 0.5 THEN 1e0 ELSE 0e0 END END) AS anomaly_rate_base,
    AVG(CASE WHEN period = 'current' THEN CASE WHEN anomaly_score >= 0.5 THEN 1e0 ELSE 0e0 END END) AS anomaly_rate_cur
  FROM (SELECT *, CASE WHEN weekly_ts < TIMESTAMP '1998-05-01' THEN 'baseline' ELSE 'current' END AS period FROM scored) s
  WHERE sales IS NOT NULL GROUP BY sales) g"""),
    ["attrition_base", "attrition_cur", "score_base", "score_cur", "anomaly_rate_base", "anomaly_rate_cur",
     "attrition_shift", "score_shift", "anomaly_rate_shift"])
ORACLE["batch_verdict"] = dirty_sql("""
SELECT *, 'last_evaluation,number_project,time_spend_company,Work_accident,promotion_last_5years' AS missing_columns,
  'rejected' AS outcome FROM (
  SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE weekly_ts IS NULL) AS null_timestamps,
    COUNT(*) FILTER (WHERE left_flag IS NULL) AS null_labels,
    COUNT(*) FILTER (WHERE NOT COALESCE(salary IN ('low', 'medium', 'high'), FALSE)) AS unknown_salary,
    COUNT(*) FILTER (WHERE NOT COALESCE(sales IN (SELECT DISTINCT sales FROM hr WHERE sales IS NOT NULL), FALSE)) AS unknown_sales,
    CAST((SELECT COUNT(*) FROM hr_dirty) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM hr_dirty) d) AS BIGINT) AS duplicate_rows
  FROM hr_dirty) x""")

# ------------------------------------------------------------------ governance
_KW = ["password", "secret", "key", "token", "api_key", "private_key", "credential", "auth"]
_SCAN = ("scan AS (SELECT doc_id, source, list_filter([" + ", ".join(f"'{k}'" for k in _KW)
         + "], lambda k: contains(lower(text), k)) AS found FROM documents)")
ORACLE["secret_scan"] = with_ctes(_SCAN, body=(
    "SELECT doc_id, source, array_to_string(found, '|') AS found FROM scan WHERE len(found) > 0"))
ORACLE["secret_scan_summary"] = with_ctes(_SCAN, body=(
    "SELECT source, keyword, COUNT(*) AS hits FROM (SELECT source, UNNEST(found) AS keyword FROM scan) u "
    "GROUP BY source, keyword"))

_MISS_CTE = "miss AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, SUM(CASE WHEN {c} IS NULL" + (f" OR isnan({c})" if isnan else "")
    + " THEN 1 ELSE 0 END) AS missing_count FROM hr_dirty" for c, isnan in _MISS_COLS) + ")"
_FND = """
fnd AS (
  SELECT CASE check_kind WHEN 'missing' THEN 'missing_column' WHEN 'type' THEN 'bad_type' ELSE 'domain_rule' END AS category,
         CASE check_kind WHEN 'missing' THEN 'CRITICAL' ELSE 'HIGH' END AS priority FROM findings
  UNION ALL SELECT 'missing_values', 'MEDIUM' FROM miss WHERE missing_count > 0
  UNION ALL SELECT 'secret_keyword', 'CRITICAL' FROM (SELECT DISTINCT UNNEST(found) AS k FROM scan) s)"""
ORACLE["findings_score"] = dirty_sql("""
SELECT *, CASE WHEN security_score < 50 THEN 'CRITICAL' WHEN security_score < 70 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level
FROM (SELECT critical, high, total,
        CAST(GREATEST(0, 100 - (critical * 20 + high * 10 + (total - critical - high) * 5)) AS INT) AS security_score
      FROM (SELECT COUNT(*) FILTER (WHERE priority = 'CRITICAL') AS critical,
                   COUNT(*) FILTER (WHERE priority = 'HIGH') AS high, COUNT(*) AS total FROM fnd) a) b""",
    _SCHEMA_CTES, _MISS_CTE, _SCAN, _FND)
ORACLE["findings_recommendations"] = dirty_sql("""
SELECT f.category, r.priority, f.n, replace(r.template, '%d', CAST(f.n AS VARCHAR)) AS recommendation
FROM (SELECT category, COUNT(*) AS n FROM fnd GROUP BY category) f
JOIN (VALUES
  ('missing_column', 'CRITICAL', '%d required columns are missing: fix the extract before loading'),
  ('secret_keyword', 'CRITICAL', '%d secret keywords occur in text: move secrets out of the data'),
  ('bad_type', 'HIGH', '%d columns have the wrong type: cast at ingestion'),
  ('domain_rule', 'HIGH', '%d columns break domain rules: quarantine the failing rows'),
  ('missing_values', 'MEDIUM', '%d columns contain missing values: define imputation')) r(category, priority, template)
  ON f.category = r.category WHERE f.n > 0""", _SCHEMA_CTES, _MISS_CTE, _SCAN, _FND)
ORACLE["promotion_gate"] = rounded(scored_sql("""
SELECT 'supervised_score' AS production, 'fused_score' AS candidate,
  (SELECT CAST(cost AS BIGINT) FROM bx WHERE model = 'supervised_score') AS production_cost,
  (SELECT CAST(cost AS BIGINT) FROM bx WHERE model = 'fused_score') AS candidate_cost,
  (SELECT f1_score FROM bx WHERE model = 'supervised_score') AS production_f1,
  (SELECT f1_score FROM bx WHERE model = 'fused_score') AS candidate_f1,
  CASE WHEN (SELECT cost FROM bx WHERE model = 'fused_score') < (SELECT cost FROM bx WHERE model = 'supervised_score')
        AND (SELECT f1_score FROM bx WHERE model = 'fused_score') >= (SELECT f1_score FROM bx WHERE model = 'supervised_score') - 0e0
       THEN 'promote' ELSE 'keep production' END AS decision""",
    _grid_cte("grid", _G100), _LONG, """
mcurve AS (
  SELECT s.model, g.i, g.tau,
    CAST(SUM(CASE WHEN s.s > g.tau AND s.left_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    CAST(SUM(CASE WHEN s.s > g.tau AND s.left_flag <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(SUM(CASE WHEN NOT (s.s > g.tau) AND s.left_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM grid g, long_s s GROUP BY s.model, g.i, g.tau),
bx AS (
  SELECT model, MIN(cost) AS cost, arg_min(CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0
      ELSE CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END, cost * 1000 + i) AS f1_score
  FROM (SELECT *, 10e0 * fn + 1e0 * fp AS cost FROM mcurve) x GROUP BY model)"""),
    ["production_f1", "candidate_f1"])
