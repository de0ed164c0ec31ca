"""Classification evaluation: confusion counts, cost, threshold sweeps, ranking metrics.

Two building blocks, each a single shuffle of the scored rows whatever the
number of thresholds:

* **grid bins** — every distinct score is mapped to ``k`` = number of grid
  thresholds it passes (JVM binary search, :class:`Bucketizer`); a histogram over
  ``k`` (≤ grid size + 1 rows per group) yields FN/FP for every threshold with a
  window over that tiny table;
* **distinct-score histogram** — positives / negatives per distinct score with
  two-phase running sums (:mod:`tidewatch.operators.ordering`) for the
  threshold-per-distinct-score sweep, AUROC and average precision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.functions.exprs import nan_to_null, safe_ratio, scalar_row, zero_if_undefined
from tidewatch.operators.ordering import DEFAULT_BUCKETS, exact_quantiles, label_histogram, running_sums


# --------------------------------------------------------------------- E1–E3, X5
def decision(score: Column, tau, inclusive: bool) -> Column:
    """1 when the score passes the threshold (``>=`` if inclusive, else ``>``); NULL and NaN do not."""
    t = tau if isinstance(tau, Column) else F.lit(float(tau))
    score = nan_to_null(score)
    return F.when(score >= t if inclusive else score > t, 1).otherwise(0).cast("int")


def confusion_counts(df: DataFrame, score: str, label: str, tau, inclusive: bool = False,
                     by: Sequence[str] = ()) -> DataFrame:
    """Tn, fp, fn, tp (per group when ``by`` is given)."""
    yhat = decision(F.col(score), tau, inclusive)
    y = F.col(label)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (yhat == 0)).alias("tn"),
        F.count_if((y == 0) & (yhat == 1)).alias("fp"),
        F.count_if((y == 1) & (yhat == 0)).alias("fn"),
        F.count_if((y == 1) & (yhat == 1)).alias("tp"),
    )


def with_cost(counts: DataFrame, fn_w: float = K.FN_WEIGHT, fp_w: float = K.FP_WEIGHT) -> DataFrame:
    """cost = fn_w·FN + fp_w·FP."""
    return counts.withColumn("cost", F.lit(float(fn_w)) * F.col("fn") + F.lit(float(fp_w)) * F.col("fp"))


def with_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 with 0 for an undefined ratio."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": zero_if_undefined(tp, tp + fp),
        "recall": zero_if_undefined(tp, tp + fn),
        "f1_score": zero_if_undefined(tp * 2, tp * 2 + fp + fn),
    })


# --------------------------------------------------------------------- grid bins
def passed_count(df: DataFrame, col: str, edges: Sequence[float], inclusive: bool, out: str) -> DataFrame:
    """``out`` = number of sorted ``edges`` e with e <= x (inclusive) or e < x (strict); 0 for NULL and NaN."""
    edges = [float(e) for e in edges]
    x = nan_to_null(F.col(col).cast("double"))
    # count(e < x) = n - count(-e <= -x)
    splits = [float("-inf"), *(edges if inclusive else sorted(-e for e in edges)), float("inf")]
    b = Bucketizer(splits=splits, inputCol="_tw_x", outputCol="_tw_b", handleInvalid="keep")
    res = b.transform(df.withColumn("_tw_x", x if inclusive else -x))
    passed = F.col("_tw_b") if inclusive else F.lit(len(edges)) - F.col("_tw_b")
    return res.withColumn(out, F.when(F.col("_tw_x").isNull(), 0).otherwise(passed).cast("int")).drop("_tw_x", "_tw_b")


def grid_sweep(df: DataFrame, score: str, label: str, grid: Sequence[float], inclusive: bool,
               fn_w: float = K.FN_WEIGHT, fp_w: float = K.FP_WEIGHT, by: Sequence[str] = ()) -> DataFrame:
    """H1–H3 cost curve: one row per (group, grid index) with tau, tp, fp, fn, tn, cost.

    FN(i) = positives whose score does not pass tau_i; FP(i) = negatives that do.
    """
    grid = [float(g) for g in grid]
    n = len(grid)
    hist = label_histogram(df, score, label, by)
    binned = passed_count(hist, score, grid, inclusive, "k")
    per_k = binned.groupBy(*by, "k").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint"))
    totals = per_k.groupBy(*by).agg(total("pos").alias("P"), total("neg").alias("N"))
    dense = totals.select(*by, "P", "N", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    joined = dense.join(per_k.withColumnRenamed("k", "i"), [*by, "i"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*by).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow) \
        if by else Window.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = joined.withColumns({"fn": F.sum("pos").over(w), "_cneg": F.sum("neg").over(w)})
    grid_arr = F.array(*[F.lit(g) for g in grid])
    out = cum.select(
        *by, F.col("i").cast("int").alias("i"), F.element_at(grid_arr, F.col("i") + 1).alias("tau"),
        (F.col("P") - F.col("fn")).alias("tp"), (F.col("N") - F.col("_cneg")).alias("fp"),
        F.col("fn").cast("bigint").alias("fn"), F.col("_cneg").cast("bigint").alias("tn"))
    return with_cost(out, fn_w, fp_w)


def best_threshold(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First minimum of the cost curve (lowest grid index among equal costs)."""
    best = F.min_by(F.struct("i", "tau", "tp", "fp", "fn", "tn", "cost"), F.struct("cost", "i"))
    return curve.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


# --------------------------------------------------------------------- H4 / W4
def distinct_score_sweep(df: DataFrame, score: str, label: str, fn_w: float = K.FN_WEIGHT,
                         fp_w: float = K.FP_WEIGHT, n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Cost at every distinct score used as an inclusive threshold (``>=``); unscored rows pass none."""
    hist = label_histogram(df, score, label)
    cum = running_sums(hist, [score], ["pos", "neg"], prefix="cum_", n_buckets=n_buckets)
    tot = cum.agg(F.max("cum_neg").alias("N")).select(F.struct("N")).scalar().getField("N")
    fn = F.col("cum_pos") - F.col("pos")                 # positives strictly below tau
    fp = tot - (F.col("cum_neg") - F.col("neg"))         # negatives at or above tau
    return cum.where(F.col(score).isNotNull()).select(F.col(score).alias("tau"), fn.cast("bigint").alias("fn"), fp.cast("bigint").alias("fp"),
                      (F.lit(float(fn_w)) * fn + F.lit(float(fp_w)) * fp).alias("cost"))


def best_distinct_tau(sweep: DataFrame, default: float = 0.5) -> DataFrame:
    """Lowest cost; among equal costs the lowest threshold; ``default`` when empty."""
    best = sweep.agg(F.min_by(F.struct("tau", "fn", "fp", "cost"), F.struct("cost", "tau")).alias("b"))
    return best.select(F.coalesce(F.col("b.tau"), F.lit(default)).alias("tau"),
                       F.col("b.fn").alias("fn"), F.col("b.fp").alias("fp"), F.col("b.cost").alias("cost"))


# --------------------------------------------------------------------- E4 / E5
def auroc(df: DataFrame, score: str, label: str, n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Tie-aware ROC AUC = Σ neg·(pos above + ½·pos tied) / (P·N).

    With cum_pos the inclusive running count of positives in ascending score
    order, the numerator ×2 is 2PN − 2Σ neg·cum_pos + Σ neg·pos: plain sums,
    exact in decimal(38,0) (no overflow at 10^12 rows), one division at the end.
    Rows without a score rank below all others, as they pass no threshold.
    """
    hist = label_histogram(df, score, label)
    cum = running_sums(hist, [score], ["pos"], prefix="cum_", n_buckets=n_buckets)
    d = "decimal(38,0)"
    s = cum.agg(F.sum(F.col("pos").cast(d)).alias("P"), F.sum(F.col("neg").cast(d)).alias("N"),
                F.sum(F.col("neg").cast(d) * F.col("cum_pos").cast(d)).alias("A"),
                F.sum(F.col("neg").cast(d) * F.col("pos").cast(d)).alias("B"))
    two_pn = F.col("P") * F.col("N") * 2
    return s.select(safe_ratio((two_pn - F.col("A") * 2 + F.col("B")).cast("double"),
                               two_pn.cast("double")).alias("auroc"))


def average_precision(df: DataFrame, score: str, label: str, n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Σ over distinct thresholds of ΔRecall · Precision (step-wise, not trapezoidal).

    Running sums in *descending* score order give TP(≥t) and FP(≥t) directly;
    AP = Σ pos(t)·TP(≥t)/(TP(≥t)+FP(≥t)) / P.  Positives without a score are never found.
    """
    hist = label_histogram(df, score, label).withColumns(
        {"_none": F.col(score).isNull(), "_desc": -F.col(score).cast("double")})
    cum = running_sums(hist, ["_none", "_desc"], ["pos", "neg"], prefix="cum_", n_buckets=n_buckets)
    prec = F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg")).cast("double")
    s = cum.agg(F.sum(F.when((F.col("pos") > 0) & ~F.col("_none"), F.col("pos").cast("double") * prec)).alias("s"),
                F.sum("pos").alias("P"))
    return s.select(safe_ratio(F.col("s"), F.col("P")).alias("average_precision"))


# --------------------------------------------------------------------- E6–E8
def calibration_curve(df: DataFrame, prob: str, label: str, inner_edges: Sequence[float | Column]) -> DataFrame:
    """Reliability curve: bin = number of distinct inner edges strictly below p; empty bins absent.

    ``inner_edges`` are numbers, or ascending columns such as ``quantile_edges``.  Rows without a
    probability or a label are left out; an empty table has no bins.
    """
    scored = df.withColumn(prob, nan_to_null(prob)).where(F.col(prob).isNotNull() & F.col(label).isNotNull())
    if any(isinstance(e, Column) for e in inner_edges):
        below = [(e < F.col(prob).cast("double")) & (e > before if before is not None else F.lit(True))
                 for before, e in zip([None, *inner_edges], inner_edges)]
        binned = scored.withColumn("bin", sum((F.when(b, 1).otherwise(0) for b in below), F.lit(0)))
    else:
        binned = passed_count(scored, prob, sorted(set(float(e) for e in inner_edges)), False, "bin")
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(prob).alias("mean_pred"),
                                     F.avg(F.col(label).cast("double")).alias("frac_pos"))


def quantile_edges(df: DataFrame, prob: str, n_bins: int = 10) -> list[Column]:
    """Inner quantile edges (exact, linear interpolation): ``n_bins - 1`` values of one scalar subquery."""
    probs = [i / n_bins for i in range(1, n_bins)]
    edges = exact_quantiles(df, prob, probs).select(F.struct("q")).scalar().q
    return [F.get(edges, F.lit(i)) for i in range(n_bins - 1)]


def brier_score(df: DataFrame, prob: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean squared error of the probability; NULL when only one class is present."""
    y = F.col(label).cast("double")
    return df.groupBy(*by).agg(
        F.when(F.min(label) != F.max(label), F.avg((F.col(prob) - y) * (F.col(prob) - y))).alias("brier"))


# --------------------------------------------------------------------- H5 / H6 / H7
def long_scores(df: DataFrame, score_cols: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot score columns to (model, score) in one pass (no union of N scans)."""
    return df.unpivot([*keep, label], list(score_cols), "model", "score")


def model_name(col: Column) -> Column:
    return F.initcap(F.regexp_replace(col, "_score$", ""))


def benchmark_table(df: DataFrame, score_cols: Sequence[str], label: str, tau) -> DataFrame:
    """H5: every model at one shared threshold (strict ``>``)."""
    lg = long_scores(df, score_cols, label)
    t = tau if isinstance(tau, Column) else F.lit(float(tau))
    counts = confusion_counts(lg, "score", label, t, inclusive=False, by=["model"])
    return with_metrics(counts).select(model_name(F.col("model")).alias("model"), t.alias("threshold"),
                                       "precision", "recall", "f1_score")


def benchmark_enhanced(df: DataFrame, score_cols: Sequence[str], label: str, baseline: str,
                       grid: Sequence[float] | None = None) -> DataFrame:
    """H6 + H7: own best threshold per model on the 100-point grid (strict ``>``),
    metrics there, total cost and the cost change against the baseline model."""
    grid = grid if grid is not None else K.grid_100()
    lg = long_scores(df, score_cols, label)
    best = with_metrics(best_threshold(grid_sweep(lg, "score", label, grid, inclusive=False, by=["model"]),
                                       by=["model"]))
    models = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)      # one row per model
    base_cost = F.max(F.when(F.col("model") == baseline, F.col("cost"))).over(models)
    return best.select(
        F.col("model").alias("model_variant"), F.col("tau").alias("threshold"), "precision", "recall",
        "f1_score", F.col("cost").cast("bigint").alias("total_cost"),
        F.when(F.col("model") == baseline, F.lit(0.0))
        .otherwise(safe_ratio(base_cost - F.col("cost"), base_cost) * 100.0).alias("cost_reduction_pct"))


# --------------------------------------------------------------------- evaluation flow
def benchmark_heldout(df: DataFrame, score_cols: Sequence[str], label: str, baseline: str, split: str = "split",
                      grid: Sequence[float] | None = None) -> DataFrame:
    """H6 + H7 with thresholds fixed on the training part: each model's cheapest threshold there, and its
    metrics and cost in both parts; the cost change is against the baseline in the same part."""
    grid = grid if grid is not None else K.grid_100()
    lg = long_scores(df, score_cols, label, keep=[split])
    train = lg.where(F.col(split) == "train")
    tau = best_threshold(grid_sweep(train, "score", label, grid, inclusive=False, by=["model"]), by=["model"]).select("model", "tau")
    counts = confusion_counts(lg.join(F.broadcast(tau), "model"), "score", label, F.col("tau"), by=[split, "model", "tau"])     # one row per model
    scored = with_metrics(with_cost(counts))
    part = Window.partitionBy(split)                                                          # one row per model
    base = F.max(F.when(F.col("model") == baseline, F.col("cost"))).over(part)
    return scored.select(
        F.col(split).alias("part"), F.col("model").alias("model_variant"), F.col("tau").alias("threshold"), "precision", "recall",
        "f1_score", F.col("cost").cast("bigint").alias("total_cost"),
        F.when(F.col("model") == baseline, F.lit(0.0)).otherwise(safe_ratio(base - F.col("cost"), base) * 100.0).alias("cost_reduction_pct"))


def by_part(df: DataFrame, report, split: str = "split") -> DataFrame:
    """``report`` over the training part and the held-out part, with a ``part`` column."""
    parts = [report(df.where(F.col(split) == p)).withColumn("part", F.lit(p)) for p in ("train", "test")]
    return parts[0].unionByName(parts[1])


def evaluation_report(df: DataFrame, label: str, naive: str, learned: str) -> DataFrame:
    """One row of five keys: each fusion's cheapest threshold (101 points, ``>=``), its cost there (``>``), and how cost counts."""
    def one(score: str):
        tau = best_threshold(grid_sweep(df, score, label, K.grid_101(), inclusive=True)).select(F.struct("tau")).scalar().tau
        return tau, scalar_row(with_cost(confusion_counts(df, score, label, tau)).select("cost")).cost.cast("bigint")

    (naive_tau, naive_cost), (learned_tau, learned_cost) = one(naive), one(learned)
    return df.sparkSession.range(1).select(
        naive_tau.alias("optimal_threshold"), learned_tau.alias("fusion_lr_threshold"), naive_cost.alias("naive_fusion_cost"),
        learned_cost.alias("learned_fusion_cost"),
        F.lit(f"{K.FN_WEIGHT:g}*FN + {K.FP_WEIGHT:g}*FP").alias("cost_fn"))
