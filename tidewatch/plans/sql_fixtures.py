"""DuckDB-side definitions of the fixture projections (independent of the Spark code).

Used only to build the oracle SQL texts in :mod:`tidewatch.plans.oracle`.
"""

HR_CTES = """
li AS (
  SELECT l_orderkey, COUNT(*) AS n,
         SUM(CAST(ROUND(l_discount*100) AS BIGINT)) AS disc_pct,
         SUM(CAST(ROUND(l_tax*100) AS BIGINT)) AS tax_pct,
         SUM(CAST(l_quantity AS BIGINT)) AS qty
  FROM lineitem GROUP BY l_orderkey),
f AS (
  SELECT CAST(o_orderkey AS BIGINT) AS EmployeeID,
    FLOOR(CAST(disc_pct AS DOUBLE)*1e1/CAST(n AS DOUBLE))/1e2 AS satisfaction_level,
    FLOOR(CAST(tax_pct AS DOUBLE)*1e2/(8e0*CAST(n AS DOUBLE)))/1e2 AS last_evaluation,
    CAST(n AS INT) AS number_project,
    CAST(96 + (qty % 215) AS INT) AS average_montly_hours,
    CAST(2 + (o_custkey % 9) AS INT) AS time_spend_company,
    CAST(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS INT) AS Work_accident,
    CAST(CASE WHEN o_custkey % 50 = 0 THEN 1 ELSE 0 END AS INT) AS promotion_last_5years,
    c_mktsegment AS sales,
    CASE WHEN o_totalprice < 250000 THEN 'low' WHEN o_totalprice < 450000 THEN 'medium' ELSE 'high' END AS salary,
    o_orderstatus, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN li ON l_orderkey = o_orderkey),
hr AS (
  SELECT EmployeeID, satisfaction_level, last_evaluation, number_project, average_montly_hours,
    time_spend_company, Work_accident, promotion_last_5years, sales, salary,
    CAST(CASE WHEN (satisfaction_level < 0.45 AND o_orderstatus <> 'P')
           OR (average_montly_hours > 250 AND o_orderstatus = 'F') THEN 1 ELSE 0 END AS INT) AS left_flag,
    CAST(DATE_TRUNC('week', o_orderdate) AS TIMESTAMP) AS weekly_ts,
    CAST(ROUND(7e1*(1e2 - satisfaction_level*1e2) + 3e1*((average_montly_hours-96)*1e2/214e0)) AS BIGINT)/1e4 AS score
  FROM f)"""

HR_DIRTY_CTE = """
hr_dirty AS (
  SELECT EmployeeID,
    CASE WHEN EmployeeID % 101 = 0 THEN NULL WHEN EmployeeID % 211 = 0 THEN satisfaction_level + 1 ELSE satisfaction_level END AS satisfaction_level,
    CASE WHEN EmployeeID % 103 = 0 THEN 'n/a' ELSE CAST(average_montly_hours AS VARCHAR) END AS hours_text,
    CASE WHEN EmployeeID % 89 = 0 THEN average_montly_hours + 400 ELSE average_montly_hours END AS average_montly_hours,
    CASE WHEN EmployeeID % 107 = 0 THEN '' WHEN EmployeeID % 109 = 0 THEN 'exec' ELSE salary END AS salary,
    CASE WHEN EmployeeID % 113 = 0 THEN '' WHEN EmployeeID % 127 = 0 THEN NULL ELSE sales END AS sales,
    CASE WHEN EmployeeID % 131 = 0 THEN NULL ELSE left_flag END AS left_flag, weekly_ts
  FROM (SELECT * FROM hr UNION ALL SELECT * FROM hr WHERE EmployeeID % 97 = 0) u)"""

HR_WIDE_CTE = """
hr_wide AS (
  SELECT * REPLACE (
    CASE WHEN EmployeeID % 101 = 0 THEN NULL WHEN EmployeeID % 211 = 0 THEN satisfaction_level + 1 ELSE satisfaction_level END AS satisfaction_level,
    CASE WHEN EmployeeID % 61 = 0 THEN last_evaluation + 2 ELSE last_evaluation END AS last_evaluation,
    CAST(CASE WHEN EmployeeID % 67 = 0 THEN 99 ELSE number_project END AS INT) AS number_project,
    CAST(CASE WHEN EmployeeID % 89 = 0 THEN average_montly_hours + 400 ELSE average_montly_hours END AS INT) AS average_montly_hours,
    CAST(CASE WHEN EmployeeID % 71 = 0 THEN -1 ELSE time_spend_company END AS INT) AS time_spend_company,
    CAST(CASE WHEN EmployeeID % 73 = 0 THEN 2 ELSE Work_accident END AS INT) AS Work_accident,
    CAST(CASE WHEN EmployeeID % 79 = 0 THEN 5 ELSE promotion_last_5years END AS INT) AS promotion_last_5years,
    CASE WHEN EmployeeID % 109 = 0 THEN 'exec' ELSE salary END AS salary,
    CASE WHEN EmployeeID % 131 = 0 THEN NULL ELSE left_flag END AS left_flag,
    CASE WHEN EmployeeID % 83 = 0 THEN NULL ELSE weekly_ts END AS weekly_ts,
    CASE WHEN EmployeeID % 59 = 0 THEN NULL WHEN EmployeeID % 53 = 0 THEN CAST('NaN' AS DOUBLE) ELSE score END AS score)
  FROM hr)"""

GROUP_PREDS_CTE = """
group_preds AS (
  SELECT d.doc_id, d.lang AS grp, l.toxic AS y_true, 1 - l.quality AS y_pred,
         CAST((d.doc_id*7919) % 1000 AS DOUBLE)/1e3 AS y_prob
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

# Violation thresholds, flags, department-week aggregate and its lags.
GOLD_CTES = """
thr AS (
  SELECT quantile_cont(average_montly_hours, 0.95) AS p95_hours,
         quantile_cont(number_project, 0.75) AS p75_projects,
         quantile_cont(satisfaction_level, 0.25) AS p25_satisfaction,
         quantile_cont(time_spend_company, 0.75) AS p75_tenure,
         quantile_cont(average_montly_hours, 0.5) AS median_hours
  FROM hr),
flagged AS (
  SELECT hr.*,
    CAST(CASE WHEN average_montly_hours > p95_hours THEN 1 ELSE 0 END AS INT) AS v1_overtime,
    CAST(CASE WHEN number_project >= p75_projects AND satisfaction_level < p25_satisfaction THEN 1 ELSE 0 END AS INT) AS v2_overload_satisfaction,
    CAST(CASE WHEN time_spend_company >= p75_tenure AND promotion_last_5years = 0 AND average_montly_hours > median_hours THEN 1 ELSE 0 END AS INT) AS v3_stagnation,
    CAST(CASE WHEN Work_accident = 1 AND average_montly_hours > p95_hours THEN 1 ELSE 0 END AS INT) AS v4_post_accident_overwork
  FROM hr, thr),
dw AS (
  SELECT sales, weekly_ts,
    CAST(SUM(left_flag) AS BIGINT) AS leavers,
    AVG(left_flag) AS attrition_rate,
    AVG(satisfaction_level) AS satisfaction_level_mean,
    AVG(average_montly_hours) AS average_montly_hours_mean,
    AVG(time_spend_company) AS time_spend_company_mean,
    CAST(SUM(v1_overtime) AS BIGINT) AS v1_overtime_sum,
    CAST(SUM(v2_overload_satisfaction) AS BIGINT) AS v2_overload_satisfaction_sum,
    CAST(SUM(v3_stagnation) AS BIGINT) AS v3_stagnation_sum,
    CAST(SUM(v4_post_accident_overwork) AS BIGINT) AS v4_post_accident_overwork_sum,
    COUNT(EmployeeID) AS headcount,
    CAST(SUM(v1_overtime) + SUM(v2_overload_satisfaction) + SUM(v3_stagnation) + SUM(v4_post_accident_overwork) AS DOUBLE)
      / CAST(COUNT(EmployeeID) AS DOUBLE) AS violation_density
  FROM flagged WHERE sales IS NOT NULL AND weekly_ts IS NOT NULL
  GROUP BY sales, weekly_ts),
dwl AS (
  SELECT dw.*,
    LAG(v1_overtime_sum) OVER w AS v1_overtime_sum_lag1,
    LAG(v2_overload_satisfaction_sum) OVER w AS v2_overload_satisfaction_sum_lag1,
    LAG(v3_stagnation_sum) OVER w AS v3_stagnation_sum_lag1,
    LAG(v4_post_accident_overwork_sum) OVER w AS v4_post_accident_overwork_sum_lag1,
    LAG(violation_density) OVER w AS violation_density_lag1,
    LAG(attrition_rate) OVER w AS attrition_rate_lag1
  FROM dw WINDOW w AS (PARTITION BY sales ORDER BY weekly_ts))"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def rounded(inner: str, cols: list[str], digits: int = 9) -> str:
    """Wrap a query so the listed double columns are rounded like the Spark side."""
    if not cols:
        return inner
    repl = ", ".join(f"ROUND({c}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{inner}\n) _r"
