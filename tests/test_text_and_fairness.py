"""Alert text, clipping and fairness edge cases."""
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import text as TX
from tidewatch.functions.exprs import fixed_decimals
from tidewatch.operators import alerts, fairness


def test_clip_text(spark):
    raw = "\t " + "a\r\nb" + "x" * 600 + "  "
    got = spark.createDataFrame([(raw,)], "t string").select(TX.clip_text(F.col("t")).alias("c")).first().c
    assert got == (raw.replace("\r", " ").replace("\n", " ").strip())[:500]


def test_clip_list_and_phrases(spark):
    df = spark.createDataFrame([([f" item{i}\n" for i in range(21)], ["V1_OVERTIME_SUM", "some_code"])],
                               "l array<string>, d array<string>")
    r = df.select(TX.clip_list("l").alias("l"), TX.driver_phrases("d").alias("p")).first()
    assert len(r.l) == 20 and r.l[0] == "item0"
    assert r.p == ["overtime pressure", "some code"]


def test_fixed_decimals(spark):
    df = spark.createDataFrame([(0.4575,), (-1.2344,), (None,)], "x double")
    assert [r.s for r in df.select(fixed_decimals("x", 3).alias("s")).collect()] == ["0.458", "-1.234", None]


def test_summary_grammar(spark):
    df = spark.createDataFrame([("IT", "2024-01-01", ["attrition_rate"]), ("HR", "2024-01-08", ["a_b", "c", "d"])],
                               "dept string, week string, drivers array<string>")
    lines = df.select(alerts.summary_lines(F.col("dept"), F.col("week"), F.col("drivers")).alias("l")).collect()
    assert lines[0].l[2] == "Primary driver appears to be elevated attrition rate."
    assert lines[1].l[2] == "Main drivers appear to be a b, c, and d."
    assert lines[0].l[1] == "Risk score is n/a against threshold n/a. Warning status: triggered."


def test_top_drivers_cap_and_fallback(spark):
    row_all = (0.5, 300.0, 0.1, 9.0, 1, 1, 1, 1, 0.5)
    row_none = (0.0, 100.0, 0.9, 1.0, 0, 0, 0, 0, 0.0)
    schema = ("attrition_rate double, average_montly_hours_mean double, satisfaction_level_mean double, "
              "time_spend_company_mean double, v1_overtime_sum long, v2_overload_satisfaction_sum long, "
              "v3_stagnation_sum long, v4_post_accident_overwork_sum long, violation_density double")
    out = alerts.top_drivers(spark.createDataFrame([row_all, row_none], schema)).collect()
    assert out[0].top_drivers == ["attrition_rate", "average_montly_hours_mean", "satisfaction_level_mean",
                                  "time_spend_company_mean", "v1_overtime_sum"]
    assert out[1].top_drivers == ["fused_score_pattern"]


def test_equalized_odds_skips_single_class_group(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 0), ("b", 1, 1), ("b", 1, 0)], "g string, y int, p int")
    assert [r.g for r in fairness.equalized_odds(df, "g", "y", "p").collect()] == ["a"]
    par = {r.g: r for r in fairness.demographic_parity(df, "g", "p").collect()}
    assert par["a"].parity_difference == 0.0 and par["a"].sample_size == 2


@pytest.mark.parametrize("value,digits,text", [
    (6.25, 1, "6.2"), (6.35, 1, "6.4"), (0.0625, 3, "0.062"), (0.1875, 3, "0.188"), (2.5, 0, "2"), (3.5, 0, "4"),
    (-0.125, 2, "-0.12"), (-0.04, 1, "0.0"), (0.9996, 3, "1.000"), (12.0, 2, "12.00")])
def test_number_formats(spark, value, digits, text):
    from tidewatch.functions.exprs import fixed_decimals
    assert spark.range(1).select(fixed_decimals(F.lit(value), digits).alias("t")).first().t == text


def test_clipping_of_lists_and_maps(spark):
    from tidewatch.functions import text as TX
    df = spark.createDataFrame([({f"k{i:02d}": f" v{i}\n" for i in range(21)}, [f"x{i}" for i in range(30)])],
                               "m map<string,string>, l array<string>")
    r = df.select(TX.clip_map("m").alias("m"), TX.clip_list("l").alias("l")).first()
    assert len(r.m) == 20 and all(v == v.strip() for v in r.m.values()) and len(r.l) == 20


def test_csv_is_read_by_header_name(spark, tmp_path):
    from tidewatch.operators import quality
    from tidewatch.sources import files
    path = tmp_path / "raw.csv"
    path.write_text("Department,salary,left,average_montly_hours,satisfaction_level\nsales,low,1,150,0.4\nhr,high,0,oops,0.9\n")
    df = files.read_raw_csv(spark, str(path))
    assert sorted(map(tuple, df.select("sales", "left_flag", "average_montly_hours").collect()), key=str) == [("hr", 0, None), ("sales", 1, 150)]
    missing = {r.column_name for r in quality.schema_findings(spark, df).collect() if r.check_kind == "missing"}
    assert missing == {"last_evaluation", "number_project", "time_spend_company", "Work_accident", "promotion_last_5years"}


def test_gold_layer_round_trip(spark):
    from tidewatch.plans import catalog
    from tidewatch.session import scratch_path
    from tidewatch.sources import files
    sf = "/root/testdata/sf0.001"
    gold, emp = catalog._gold(spark, sf), catalog._hr(spark, sf)
    paths = files.write_gold(gold, emp, scratch_path(spark, "gold"))
    back = files.read_parquet(spark, paths["emp"], ["EmployeeID", "sales"])
    assert back.columns == ["EmployeeID", "sales"] and back.count() == emp.count()
    dept = files.read_parquet(spark, paths["dept"])
    assert dept.count() == gold.count() and set(dept.columns) == set(gold.columns)


def test_plans_read_each_layer_once_or_twice(spark):
    """Reports scan their stored input a few times at most (before exchange reuse)."""
    from tidewatch.plans import catalog
    sf = "/root/testdata/sf0.001"
    for key, most in (("bias_report", 1), ("fairness_summary_sales", 1), ("secret_scan", 1), ("fairness_parity_sales", 1),
                      ("promotion_gate", 2), ("benchmark_enhanced", 2), ("alert_context", 2), ("auroc", 0)):
        plan = catalog.QUERIES[key](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") <= most, (key, plan.count("Relation ["))
