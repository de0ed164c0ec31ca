"""Registered queries vs their DuckDB oracle on the smallest scale factor, plus
streaming == batch on closed windows and isolation-forest invariants."""
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewatch.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
KEYS = ["dpi_leaderboard", "dept_week_lags", "quality_findings", "tau_unique_scores", "cost_curve",
        "bias_report", "alert_summaries", "fairness_group_metrics", "stream_weekly_risk", "synthetic_week",
        "stream_weekly_alerts", "benchmark_enhanced"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, (bool, np.bool_, int, float, np.integer, np.floating)):
        return round(float(v), 9)
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].astype(object).itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    s = E.queries()[key](spark, SF).toPandas()
    o = con.execute(E.oracle_sql()[key]).df()
    assert _rows(s) == _rows(o)


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]


def test_every_oracle_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_isolation_forest_ranks_planted_outliers_first(spark):
    from tidewatch.operators import iforest
    rng = np.random.default_rng(0)
    normal = [(i, rng.normal(0, 1, 4).tolist()) for i in range(300)]
    planted = [(1000 + i, (rng.normal(0, 1, 4) + 8).tolist()) for i in range(5)]
    df = spark.createDataFrame(normal + planted, "id long, features array<double>")
    nodes, psi = iforest.fit(df, ["id"], "features", n_trees=50, max_samples=64)
    scored = iforest.score(spark, df, ["id"], "features", nodes, psi).orderBy("decision").limit(5).collect()
    assert {r.id for r in scored} == {1000, 1001, 1002, 1003, 1004}
    again = iforest.score(spark, df.repartition(3), ["id"], "features", nodes, psi)
    assert again.where(F.col("decision").isNull()).count() == 0


@pytest.mark.parametrize("key", ["dpi_leaderboard", "cost_curve", "alert_summaries", "fairness_group_metrics",
                                 "auroc", "employee_gold"])
def test_core_plans_stay_in_the_jvm(spark, key):
    """No Python UDF evaluation in the core plans (only the isolation forest uses Python)."""
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
