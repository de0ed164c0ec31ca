"""The two fixtures of the original unit tests, checked by value (not only shape)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import features

EMP = [(0.5, 0.7, 3, 150, 2, 0, 0, "low", "IT", 0),
       (0.8, 0.9, 5, 200, 4, 1, 1, "high", "sales", 1),
       (0.3, 0.4, 2, 120, 1, 0, 0, "medium", "hr", 0)]
EMP_SCHEMA = ("satisfaction_level double, last_evaluation double, number_project int, average_montly_hours int, "
              "time_spend_company int, Work_accident int, promotion_last_5years int, salary string, sales string, "
              "left_flag int")


def test_employee_features(spark):
    df = spark.createDataFrame(EMP, EMP_SCHEMA).withColumn("id", F.monotonically_increasing_id())
    levels = features.category_levels(df, "sales")
    out = features.employee_features(df, levels).orderBy("id").collect()
    assert len(out) == 3
    assert [r.salary_ord for r in out] == [1, 3, 2]
    assert [round(r.satisfaction_x_eval, 6) for r in out] == [0.35, 0.72, 0.12]
    assert [r.hours_x_projects for r in out] == [450, 1000, 240]
    for r, dept in zip(out, ["IT", "sales", "hr"]):
        assert sum(r[f"dept_{x}"] for x in levels) == 1 and r[f"dept_{dept}"] == 1


DW = [(1, 0.5, 0.7, 3, 150, 2, 0, 0, "IT", dt.datetime(2024, 1, 1), 0),
      (2, 0.8, 0.9, 5, 200, 4, 1, 1, "IT", dt.datetime(2024, 1, 1), 1),
      (3, 0.3, 0.4, 2, 120, 1, 0, 0, "sales", dt.datetime(2024, 1, 8), 0),
      (4, 0.6, 0.8, 4, 180, 3, 0, 0, "sales", dt.datetime(2024, 1, 8), 1)]
DW_SCHEMA = ("EmployeeID long, satisfaction_level double, last_evaluation double, number_project int, "
             "average_montly_hours int, time_spend_company int, Work_accident int, promotion_last_5years int, "
             "sales string, weekly_ts timestamp_ntz, left_flag int")


def test_dept_week_features(spark):
    df = spark.createDataFrame(DW, DW_SCHEMA)
    t = features.violation_thresholds(df).first()
    assert (t.p95_hours, t.p75_projects, t.p75_tenure, t.median_hours) == (197.0, 4.25, 3.25, 165.0)
    assert t.p25_satisfaction == pytest.approx(0.45)
    gold = {r.sales: r for r in features.dept_week_gold(df).collect()}
    assert len(gold) == 2
    it, sa = gold["IT"], gold["sales"]
    assert (it.leavers, it.attrition_rate, it.headcount, it.v1_overtime_sum, it.v4_post_accident_overwork_sum,
            it.violation_density) == (1, 0.5, 2, 1, 1, 1.0)
    assert (sa.leavers, sa.attrition_rate, sa.headcount, sa.violation_density) == (1, 0.5, 2, 0.0)
    assert it.v2_overload_satisfaction_sum == 0 and it.v3_stagnation_sum == 0
    assert all(getattr(r, "violation_density_lag1") is None for r in gold.values())


def test_lag_is_previous_present_week(spark):
    rows = [(i, 0.5, 0.5, 3, 150, 2, 0, 0, "IT", dt.datetime(2024, 1, 1) + dt.timedelta(weeks=w), w % 2)
            for i, w in enumerate([0, 2, 3])]
    g = features.dept_week_gold(spark.createDataFrame(rows, DW_SCHEMA)).orderBy("weekly_ts").collect()
    assert [r.attrition_rate_lag1 for r in g] == [None, 0.0, 0.0]


def test_infer_department_unknown(spark):
    df = spark.createDataFrame([(1, 0, 0), (0, 0, 1), (0, 0, 0)], "dept_a int, dept_b int, dept_c int")
    out = features.infer_department(df, ["dept_a", "dept_b", "dept_c"]).collect()
    assert [r.sales_inferred for r in out] == ["a", "c", "unknown"]


def test_wide_categories_are_sparse(spark):
    """100,000 levels and a hot one: no dense columns, no error; unknown and NULL share the last slot."""
    df = spark.range(150_000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id = 1 then null else concat('c', id) end as c")
    vocabulary = features.wide_vocabulary(df, "c")
    first = vocabulary.orderBy("slot").limit(2).collect()
    assert [(r.value, r.n, r.slot) for r in first] == [("hot", 50_000, 0), ("c10", 1, 1)] and vocabulary.count() == 100_000
    out = features.sparse_one_hot(df, "c", vocabulary, "v")
    assert out.columns == ["id", "c", "v"] and out.count() == 150_000
    got = {r.id: r.v for r in out.where("id in (0, 1, 10)").collect()}
    assert [(v.size, v.indices.tolist(), v.values.tolist()) for v in (got[0], got[1], got[10])] == [
        (100_001, [0], [1.0]), (100_001, [100_000], [1.0]), (100_001, [1], [1.0])]
    few = features.sparse_one_hot(df, "c", features.wide_vocabulary(df, "c", 1), "v").where("id in (0, 10)").collect()
    assert sorted((r.id, r.v.size, r.v.indices[0]) for r in few) == [(0, 2, 0), (10, 2, 1)]
    none = features.wide_vocabulary(df.limit(0), "c")
    assert none.count() == 0 and features.sparse_one_hot(df, "c", none, "v").first().v.size == 1
