"""Project the driver tables onto the employee-style inputs the operators expect.

``hr``          one employee per order that has line items (raw HR schema + label,
                real weekly timestamp and a basis-point stand-in model score)
``hr_dirty``    ``hr`` with injected duplicates, nulls, blanks and out-of-domain values
``group_preds`` documents joined to labels: real 0/1 outcomes with a group column

All three are lazy DataFrames; nothing is collected.  At scale the only shuffles
are the line-item aggregate and the joins on order / customer key (AQE turns the
customer join into a broadcast when the customer side is small at run time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.tables import read_table


def _floor_div100(num: Column) -> Column:
    return F.floor(num).cast("double") / F.lit(100.0)


def hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")

    per_order = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("disc_pct"),
        F.sum(F.round(F.col("l_tax") * 100).cast("bigint")).alias("tax_pct"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
    )
    n = F.col("n").cast("double")
    base = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(per_order, per_order.l_orderkey == orders.o_orderkey)
        .select(
            F.col("o_orderkey").cast("bigint").alias("EmployeeID"),
            _floor_div100(F.col("disc_pct").cast("double") * 10.0 / n).alias("satisfaction_level"),
            _floor_div100(F.col("tax_pct").cast("double") * 100.0 / (8.0 * n)).alias("last_evaluation"),
            F.col("n").cast("int").alias("number_project"),
            (F.lit(96) + F.col("qty") % 215).cast("int").alias("average_montly_hours"),
            (F.lit(2) + F.col("o_custkey") % 9).cast("int").alias("time_spend_company"),
            F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0).cast("int").alias("Work_accident"),
            F.when(F.col("o_custkey") % 50 == 0, 1).otherwise(0).cast("int").alias("promotion_last_5years"),
            F.col("c_mktsegment").alias("sales"),
            F.when(F.col("o_totalprice") < 250000, "low")
            .when(F.col("o_totalprice") < 450000, "medium")
            .otherwise("high").alias("salary"),
            "o_orderstatus",
            "o_orderdate",
        )
    )
    sat = F.col("satisfaction_level")
    hours = F.col("average_montly_hours")
    status = F.col("o_orderstatus")
    left = ((sat < 0.45) & (status != "P")) | ((hours > 250) & (status == "F"))
    score_bp = F.round(
        F.lit(70.0) * (F.lit(100.0) - sat * 100.0)
        + F.lit(30.0) * ((hours - 96) * 100.0 / 214.0)
    ).cast("bigint")
    return base.select(
        "EmployeeID", "satisfaction_level", "last_evaluation", "number_project",
        "average_montly_hours", "time_spend_company", "Work_accident",
        "promotion_last_5years", "sales", "salary",
        F.when(left, 1).otherwise(0).cast("int").alias("left_flag"),
        F.date_trunc("week", F.col("o_orderdate")).cast("timestamp_ntz").alias("weekly_ts"),
        (score_bp.cast("double") / 1e4).alias("score"),
    )


def hr_dirty(spark: SparkSession, sf_dir: str, hr_df: DataFrame | None = None) -> DataFrame:
    """``hr`` (or a stored copy of it, ``hr_df``) with injected data-quality defects."""
    h = hr_df if hr_df is not None else hr(spark, sf_dir)
    doubled = h.unionByName(h.filter(F.col("EmployeeID") % 97 == 0))
    eid = F.col("EmployeeID")
    return doubled.select(
        "EmployeeID",
        F.when(eid % 101 == 0, F.lit(None).cast("double"))
        .when(eid % 211 == 0, F.col("satisfaction_level") + 1)
        .otherwise(F.col("satisfaction_level")).alias("satisfaction_level"),
        F.when(eid % 103 == 0, F.lit("n/a"))
        .otherwise(F.col("average_montly_hours").cast("string")).alias("hours_text"),
        F.when(eid % 89 == 0, F.col("average_montly_hours") + 400)
        .otherwise(F.col("average_montly_hours")).alias("average_montly_hours"),
        F.when(eid % 107 == 0, F.lit("")).when(eid % 109 == 0, F.lit("exec"))
        .otherwise(F.col("salary")).alias("salary"),
        F.when(eid % 113 == 0, F.lit("")).when(eid % 127 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("sales")).alias("sales"),
        F.when(eid % 131 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("left_flag")).alias("left_flag"),
        "weekly_ts",
    )


def hr_wide_dirty(h: DataFrame) -> DataFrame:
    """All required columns of ``h`` with defects in each: every domain rule is broken somewhere,
    weeks, labels and scores are missing, and some scores are NaN."""
    eid = F.col("EmployeeID")
    bad = {"satisfaction_level": [(101, None), (211, F.col("satisfaction_level") + 1)],
           "last_evaluation": [(61, F.col("last_evaluation") + 2)], "number_project": [(67, F.lit(99))],
           "average_montly_hours": [(89, F.col("average_montly_hours") + 400)], "time_spend_company": [(71, F.lit(-1))],
           "Work_accident": [(73, F.lit(2))], "promotion_last_5years": [(79, F.lit(5))], "salary": [(109, F.lit("exec"))],
           "left_flag": [(131, None)], "weekly_ts": [(83, None)], "score": [(59, None), (53, F.lit(float("nan")))]}
    out = []
    for f in h.schema.fields:
        c = F.col(f.name)
        for k, v in reversed(bad.get(f.name, [])):
            c = F.when(eid % k == 0, F.lit(None) if v is None else v).otherwise(c)
        out.append(c.cast(f.dataType).alias(f.name))
    return h.select(*out)


def group_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = read_table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select(
        "doc_id",
        F.col("lang").alias("grp"),
        F.col("toxic").alias("y_true"),
        (F.lit(1) - F.col("quality")).alias("y_pred"),
        ((F.col("doc_id") * 7919) % 1000).cast("double").__truediv__(F.lit(1e3)).alias("y_prob"),
    )
