"""Governance scan over data: secret keywords in text, severity roll-up, recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import constants as K

# FIXED VALUES — recommendation rules: category → (priority, text template with the count)
RULES = [
    ("missing_column", "CRITICAL", "%d required columns are missing: fix the extract before loading"),
    ("secret_keyword", "CRITICAL", "%d secret keywords occur in text: move secrets out of the data"),
    ("bad_type", "HIGH", "%d columns have the wrong type: cast at ingestion"),
    ("domain_rule", "HIGH", "%d columns break domain rules: quarantine the failing rows"),
    ("missing_values", "MEDIUM", "%d columns contain missing values: define imputation"),
]


def secret_scan(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """G1: keywords (in fixed order) contained in the lower-cased text; rows with a hit.

    One case-insensitive pattern picks the few texts with a hit; only those are lower-cased,
    once (the generated code shares the common expression), and tested by keyword.
    """
    hits = docs.where(F.col(text_col).rlike("(?iu)" + "|".join(K.SECRET_KEYWORDS)))
    low = F.lower(F.col(text_col))
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(k)), k) for k in K.SECRET_KEYWORDS]))
    return hits.select(*keep, found.alias("found")).where(F.size("found") > 0)


def secret_summary(scan: DataFrame, by: str) -> DataFrame:
    """Hits per (source, keyword) over all matching rows."""
    return scan.select(by, F.explode("found").alias("keyword")).groupBy(by, "keyword") \
        .agg(F.count(F.lit(1)).alias("hits"))


def findings(spark: SparkSession, quality_findings: DataFrame, missing: DataFrame, scan: DataFrame) -> DataFrame:
    """All findings as (category, priority, subject)."""
    kind = {"missing": ("missing_column", "CRITICAL"), "type": ("bad_type", "HIGH"), "range": ("domain_rule", "HIGH")}
    q = quality_findings.select(
        F.coalesce(*[F.when(F.col("check_kind") == k, F.lit(v[0])) for k, v in kind.items()]).alias("category"),
        F.coalesce(*[F.when(F.col("check_kind") == k, F.lit(v[1])) for k, v in kind.items()]).alias("priority"),
        F.col("column_name").alias("subject"))
    m = missing.where(F.col("missing_count") > 0).select(
        F.lit("missing_values").alias("category"), F.lit("MEDIUM").alias("priority"),
        F.col("column_name").alias("subject"))
    s = scan.select(F.explode("found").alias("subject")).distinct().select(
        F.lit("secret_keyword").alias("category"), F.lit("CRITICAL").alias("priority"), "subject")
    return q.unionByName(m).unionByName(s)


def findings_score(all_findings: DataFrame) -> DataFrame:
    """score = max(0, 100 − 20·critical − 10·high − 5·other); CRITICAL < 50 ≤ HIGH < 70 ≤ MEDIUM."""
    p = F.col("priority")
    agg = all_findings.agg(F.count_if(p == "CRITICAL").alias("critical"), F.count_if(p == "HIGH").alias("high"),
                           F.count(F.lit(1)).alias("total"))
    pen = K.SEVERITY_PENALTY
    score = F.greatest(F.lit(0), F.lit(100) - (F.col("critical") * pen["CRITICAL"] + F.col("high") * pen["HIGH"]
                                               + (F.col("total") - F.col("critical") - F.col("high")) * pen["MEDIUM"]))
    return agg.withColumn("security_score", score.cast("int")).withColumn(
        "risk_level", F.when(F.col("security_score") < 50, "CRITICAL")
        .when(F.col("security_score") < 70, "HIGH").otherwise("MEDIUM"))


def recommendations(spark: SparkSession, all_findings: DataFrame) -> DataFrame:
    """The rule table joined to finding counts; only categories with findings."""
    rules = spark.createDataFrame(RULES, "category string, priority string, template string")
    counts = all_findings.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(rules).join(counts, "category").where(F.col("n") > 0).select(
        "category", "priority", "n",
        F.replace(F.col("template"), F.lit("%d"), F.col("n").cast("string")).alias("recommendation"))
