"""Distributed model jobs: logistic (MLlib), boosted trees (``operators.boosting``), calibration, folds, CV.

Loops in this module run over a handful of folds, never over rows; the models of all
folds are grown side by side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.exprs import scalar_row
from tidewatch.operators import boosting
from tidewatch.operators import evaluation as ev
from tidewatch.operators.isotonic import isotonic_fit, isotonic_scores
from tidewatch.operators.ordering import running_sums
from tidewatch.session import checkpointed

# FIXED VALUES — feature lists shared by fit and score
SUPERVISED_BASE = ["satisfaction_level", "last_evaluation", "number_project", "average_montly_hours",
                   "time_spend_company", "Work_accident", "promotion_last_5years", "salary_ord",
                   "satisfaction_x_eval", "hours_x_projects"]
LOGISTIC_BASE = SUPERVISED_BASE[:8]
ANOMALY_FEATURES = ["leavers", "attrition_rate", "headcount", "satisfaction_level_mean",
                    "average_montly_hours_mean", "time_spend_company_mean", "v1_overtime_sum",
                    "v2_overload_satisfaction_sum", "v3_stagnation_sum", "v4_post_accident_overwork_sum",
                    "violation_density", "v1_overtime_sum_lag1", "v2_overload_satisfaction_sum_lag1",
                    "v3_stagnation_sum_lag1", "v4_post_accident_overwork_sum_lag1", "violation_density_lag1",
                    "attrition_rate_lag1"]


def feature_columns(df: DataFrame, base: Sequence[str]) -> list[str]:
    return [c for c in base if c in df.columns] + sorted(c for c in df.columns if c.startswith("dept_"))


def _prepared(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols)).withColumns({c: F.col(c).cast("double") for c in cols})


def _prob(df: DataFrame, out: str) -> DataFrame:
    return df.withColumn(out, vector_to_array("probability")[1])


# --------------------------------------------------------------------- M10
def hash_split(df: DataFrame, key: str, test_fraction: float, seed: int = 42, out: str = "split") -> DataFrame:
    """Deterministic split from a hash of the key: reproducible, no shuffle; shares hold in
    expectation within every class (the hash does not depend on the label)."""
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000))
    return df.withColumn(out, F.when(u < int(test_fraction * 1_000_000), "test").otherwise("train"))


def stratified_split(df: DataFrame, key: str, test_fraction: float, label: str = "left_flag", seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Exact share per class: rows of a class ordered by a seeded digest of the key, the first
    ``round(share * class size)`` of them are the test part.  Ranks come from the two-phase
    prefix sum, so a class of any size is never one task."""
    rows = df.withColumns({"_digest": F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), "_one": F.lit(1)})
    ranked = running_sums(rows, [label, "_digest", key], ["_one"], prefix="_upto")
    ends = ranked.groupBy(label).agg(F.min("_upto_one").alias("_first"), F.count(F.lit(1)).alias("_size"))
    ends = ends.withColumnRenamed(label, "_class")
    both = ranked.join(F.broadcast(ends), F.col(label).eqNullSafe(F.col("_class")))          # one row per class
    test = F.col("_upto_one") - F.col("_first") < F.round(F.col("_size") * test_fraction)
    return both.withColumn(out, F.when(test, "test").otherwise("train")).select(*df.columns, out)


# --------------------------------------------------------------------- M8
def fit_logistic(train: DataFrame, cols: Sequence[str], label: str, C: float = 1.0) -> PipelineModel:
    """Standardise then L2 logistic regression with sklearn's C mapped to regParam = 1/(C·n)."""
    n = train.count()
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(cols), outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (C * max(n, 1)),
                           elasticNetParam=0.0, standardization=False, maxIter=100),
    ])
    return pipe.fit(_prepared(train, cols).withColumn(label, F.col(label).cast("double")))


# --------------------------------------------------------------------- M1 / M2
def fit_gbt(train: DataFrame, cols: Sequence[str], label: str, rounds: int = 500, depth: int = 4,
            step: float = 0.05, subsample: float = 0.9, columns: float = 0.9, weight_col: str | None = None,
            seed: int = 42) -> PipelineModel:
    """Boosted trees by MLlib (first order, no leaf penalty) on row and column samples; every round runs.
    The registered queries use ``boosting.fit``."""
    kw = dict(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step,
              subsamplingRate=subsample, featureSubsetStrategy="all" if columns >= 1 else str(columns), seed=seed)
    if weight_col:
        kw["weightCol"] = weight_col
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep"),
                            GBTClassifier(**kw)])
    return pipe.fit(_prepared(train, cols).withColumn(label, F.col(label).cast("double")))


def class_weight(df: DataFrame, label: str) -> Column:
    """Scalar subquery: max(1, negatives / positives) of ``df``."""
    y = F.col(label)
    w = df.agg(F.greatest(F.lit(1.0), F.count_if(y == 0).cast("double")
                          / F.greatest(F.count_if(y == 1), F.lit(1)).cast("double")).alias("w"))
    return w.select(F.struct("w")).scalar().w


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Per-row weight: positives get max(1, neg/pos), negatives 1 (scalar subquery)."""
    return df.withColumn(out, F.when(F.col(label) == 1, class_weight(df, label)).otherwise(F.lit(1.0)))


def score(model: PipelineModel, df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Batch scoring; the positive-class probability as a double column beside those of ``df``."""
    return _prob(model.transform(_prepared(df, cols)), out).select(*df.columns, out)


# --------------------------------------------------------------------- M11
def save_model(model: PipelineModel, bundle: str, variant: str = "model") -> str:
    """Save a fitted model as ``<bundle>/<variant>``; a bundle holds a model per variant name."""
    path = f"{bundle.rstrip('/')}/{variant}"
    model.write().overwrite().save(path)
    return path


def load_model(bundle: str, variant: str = "model") -> PipelineModel:
    return PipelineModel.load(f"{bundle.rstrip('/')}/{variant}")


# --------------------------------------------------------------------- M4
def _deal_equal(loads: list[int], size: int, count: int) -> tuple[list[tuple[int, list[int]]], list[int]]:
    """``count`` groups of one ``size``, each to the lightest fold: ``(first rank, folds in turn)`` and the new loads.

    Fold f takes its j-th group when ``load + j * size`` is least, so in round ``load // size + j`` and,
    within a round, by ``load % size``.  The folds that take part only change where a round
    reaches a further fold's first one: at most as many stretches as folds, whatever the count.
    """
    turn = sorted(range(len(loads)), key=lambda f: (loads[f] % size, f))
    starts = sorted({load // size for load in loads})
    runs, rank, loads = [], 0, list(loads)
    rounds = [load // size for load in loads]
    for i, start in enumerate(starts):
        active = [f for f in turn if rounds[f] <= start]
        left = count - rank
        most = left if i + 1 == len(starts) else min(left, (starts[i + 1] - start) * len(active))
        if most:
            runs.append((rank, active))
            for place, f in enumerate(active):
                loads[f] += size * (most // len(active) + (place < most % len(active)))
            rank += most
    return runs, loads


def group_folds(spark: SparkSession, df: DataFrame, group: str, n_folds: int = 5) -> DataFrame:
    """Group-to-fold table ``(group, fold, n)``: biggest group first, each to the currently lightest fold.

    Greedy at every number of groups.  The placement is made on the table of (size, number of groups of
    that size), whose rows are at most sqrt(2 * rows): distinct sizes add up to no more than the rows.
    Groups of one size take their folds by rank (equal sizes by name), from a two-phase
    prefix sum, so neither many groups nor a size that most of them share meet in one place.

    A NULL group is a group; an empty table gives no rows.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).withColumn("_one", F.lit(1))
    ranked = running_sums(sizes, ["n", group], ["_one"], prefix="_to")
    classes = ranked.groupBy("n").agg(F.min("_to_one").alias("_first"), F.count(F.lit(1)).alias("_count"))
    classes = checkpointed(classes)
    loads, rows = [0] * n_folds, []
    for r in classes.orderBy(F.desc("n")).collect():                                         # <= sqrt(2 * rows)
        runs, loads = _deal_equal(loads, r["n"], r["_count"])
        rows.append((r["n"], r["_first"], runs))
    plan = spark.createDataFrame(rows, "n bigint, _first bigint, _runs array<struct<start:bigint,folds:array<int>>>")
    placed = ranked.join(plan, "n").withColumn("_rank", F.col("_to_one") - F.col("_first"))
    run = F.element_at(F.filter("_runs", lambda x: x.start <= F.col("_rank")), -1)
    fold = F.get(run.folds, F.pmod(F.col("_rank") - run.start, F.size(run.folds)).cast("int"))
    return placed.select(group, fold.alias("fold"), "n")


# --------------------------------------------------------------------- M3
def group_cv_metrics(spark: SparkSession, df: DataFrame, cols: Sequence[str], label: str, group: str,
                     n_folds: int = 5, rounds: int = 500) -> DataFrame:
    """Per fold: AUROC and average precision of cost-weighted trees fitted on the other folds (all grown in one pass)."""
    folds = group_folds(spark, df, group, n_folds).select(F.col(group).alias("_group"), F.col("fold").alias("_fold"))
    data = checkpointed(df.join(folds, F.col(group).eqNullSafe(F.col("_group"))).drop("_group"))
    scale = [class_weight(data.where(F.col("_fold") != k), label) for k in range(n_folds)]
    weights = {str(k): F.when(F.col("_fold") != k, F.when(F.col(label) == 1, scale[k]).otherwise(1.0)) for k in range(n_folds)}
    forest = boosting.fit(data, cols, label, weights, rounds=rounds)
    scored = checkpointed(data.withColumn("p", F.get(forest.scores(), F.col("_fold"))).select("p", label, "_fold"))
    out = None
    for k in range(n_folds):
        held = scored.where(F.col("_fold") == k).select("p", label)
        auc = scalar_row(ev.auroc(held, "p", label)).auroc
        ap = scalar_row(ev.average_precision(held, "p", label)).average_precision
        row = spark.range(1).select(F.lit(k + 1).alias("fold"), ap.alias("auprc"), auc.alias("auroc"), scale[k].alias("scale_pos_weight"))
        out = row if out is None else out.unionByName(row)
    return out


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and sample standard deviation over the folds, one row per metric."""
    long = folds.unpivot("fold", ["auroc", "auprc"], "metric", "value")
    return long.groupBy("metric").agg(F.count("value").alias("folds"), F.avg("value").alias("mean"),
                                      F.stddev_samp("value").alias("std"))


# --------------------------------------------------------------------- M5
def calibrated_gbt_scores(df: DataFrame, cols: Sequence[str], label: str, key: str, folds: int = 3,
                          rounds: int = 500, seed: int = 42, out: str = "calibrated_score",
                          train: Column | None = None, group: str | None = None,
                          beside: Mapping[str, Column] | None = None) -> DataFrame:
    """Isotonic calibration of cost-weighted trees with ``folds``-fold cross-fitting, averaged over folds.

    The fold models and their calibrations are applied as columns of one table.  The isotonic
    step (``operators.isotonic``) pools the histogram of held-out scores in a tree.  ``train`` (a condition)
    limits what is fitted on; every row is scored.  Folds go by a hash of ``key``, or, with
    ``group``, whole groups go to one fold (``group_folds``), so no group is on both sides.
    ``beside`` names further models by their row weights; they grow in the same jobs and their scores are
    columns of the result under those names.  ``cross_fitted_score`` is the uncalibrated score by models that
    have not seen the row: of its own fold for a row of ``train``, the folds' mean for any other.
    """
    rows = df.withColumn("_train", F.lit(True) if train is None else F.coalesce(train, F.lit(False)))
    if group is None:
        rows = rows.withColumn("_fold", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(folds)))
    else:
        dealt = group_folds(df.sparkSession, rows.where("_train"), group, folds)
        dealt = dealt.select(F.col(group).alias("_group"), F.col("fold").alias("_fold"))
        rows = rows.join(dealt, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")
    rows = checkpointed(rows)
    weights = dict(beside or {})
    for k in range(folds):
        fitted = F.col("_train") & (F.col("_fold") != k)
        scale = class_weight(rows.where(fitted), label)
        weights[f"_fold {k}"] = F.when(fitted, F.when(F.col(label) == 1, scale).otherwise(1.0))
    forest = boosting.fit(rows, cols, label, weights, rounds=rounds, seed=seed)
    scored = checkpointed(rows.withColumn("_ps", forest.scores()).select(key, label, "_train", "_fold", "_ps"))
    res = scored
    for k in range(folds):
        p = F.col("_ps")[len(weights) - folds + k]
        blocks = isotonic_fit(scored.where(F.col("_train") & (F.col("_fold") == k)).select(p.alias("_p"), label), "_p", label)
        res = isotonic_scores(res.withColumn("_p", p), "_p", blocks, f"_c{k}").drop("_p")
    mean = sum((F.col(f"_c{k}") for k in range(folds)), F.lit(0.0)) / folds
    raw = [F.col("_ps")[len(weights) - folds + k] for k in range(folds)]
    unseen = F.when(F.col("_train"), F.get(F.array(*raw), F.col("_fold").cast("int"))).otherwise(sum(raw, F.lit(0.0)) / folds)
    return res.select(key, mean.alias(out), unseen.alias("cross_fitted_score"), *[F.col("_ps")[i].alias(c) for i, c in enumerate(beside or {})])


# --------------------------------------------------------------------- M9
def learned_fusion_scores(df: DataFrame, cols: Sequence[str], label: str, key: str,
                          out: str = "fusion_lr_score", train: Column | None = None) -> DataFrame:
    """Min-max scale the meta-features, fit a logistic regression on the rows of ``train`` (a
    condition; by default a stratified 70 % split), score every row."""
    prepared = _prepared(df, cols).withColumn(label, F.col(label).cast("double"))
    if train is None:
        prepared = stratified_split(prepared, key, 0.3, label, out="_split")
        train = F.col("_split") == "train"
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="_raw"),
                            MinMaxScaler(inputCol="_raw", outputCol="features"),
                            LogisticRegression(featuresCol="features", labelCol=label)])
    model = pipe.fit(prepared.where(train))
    return _prob(model.transform(prepared), out).select(key, out)
