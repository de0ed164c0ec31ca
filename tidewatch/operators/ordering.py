"""Order-dependent operators without a global single-task window.

A ``Window`` with ``orderBy`` but no ``partitionBy`` moves every row into one
task.  The operators here use a two-phase prefix sum instead, the same at every size:

1. rows are range-partitioned on *all* ordering columns (Spark samples the bounds and
   compares whole tuples, so any orderable type works, NULLs are a value that sorts
   first, NaN one that sorts last, and a hot first column is split by the next ones),
   numbered by partition and stored once under the shared folder, which keeps the
   numbers stable under retries;
2. per-partition totals (one row per partition) → exclusive cumulative offsets with a
   window over that tiny table → broadcast-joined back (size bounded by the partitions);
3. a window *partitioned by that number* gives the running sum inside, plus the offset.

The number of partitions is Spark's (``spark.sql.shuffle.partitions`` and adaptive
coalescing by size) unless a caller fixes it.  Rows that are equal in every ordering
column stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.exprs import nan_to_null
from tidewatch.session import checkpointed

DEFAULT_BUCKETS = None            # Spark's own number of partitions


def ranged(df: DataFrame, order_by: Sequence[str], n_buckets: int | None, out: str) -> DataFrame:
    """``df`` stored in key ranges, ``out`` = number of the range."""
    cols = [F.col(c) for c in order_by]
    parted = df.repartitionByRange(*cols) if n_buckets is None else df.repartitionByRange(n_buckets, *cols)
    return checkpointed(parted.withColumn(out, F.spark_partition_id()))


def running_sums(df: DataFrame, order_by: Sequence[str], value_cols: Sequence[str],
                 prefix: str = "cum_", n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ascending ``order_by`` order (NULLs first).

    Adds ``{prefix}{col}`` for each value column.  The result reads the stored copy, so
    further steps on it do not run the input again.
    """
    b = "_tw_bucket"
    bucketed = ranged(df, order_by, n_buckets, b)
    totals = bucketed.groupBy(b).agg(*[F.sum(c).alias(f"_tot_{c}") for c in value_cols])
    w_off = Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        b, *[F.coalesce(F.sum(f"_tot_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}") for c in value_cols]
    )
    w_in = (Window.partitionBy(b).orderBy(*[F.col(c) for c in order_by])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = bucketed.join(F.broadcast(offsets), b)
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_{c}") + F.sum(c).over(w_in)).alias(f"{prefix}{c}") for c in value_cols],
    )


def row_sequence(df: DataFrame, order_by: Sequence[str], name: str = "row_id",
                 n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """0-based sequential id in ``order_by`` order, computed without a global window."""
    one = "_tw_one"
    out = running_sums(df.withColumn(one, F.lit(1)), order_by, [one], prefix="_c", n_buckets=n_buckets)
    return out.withColumn(name, (F.col(f"_c{one}") - 1).cast("bigint")).drop(one, f"_c{one}")


def label_histogram(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct (group, score): positives and negatives.

    Rows without a label are left out.  A NULL or NaN score passes no threshold;
    such rows are counted under a NULL score.  One partial+final hash aggregate; a
    hot score value collapses map-side.
    """
    y = F.col(label)
    scored = df.where(y.isNotNull()).withColumn(score, nan_to_null(score))
    return scored.groupBy(*by, score).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(y == 1, 0).otherwise(1)).cast("bigint").alias("neg"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def grouped_quantiles(df: DataFrame, by: Sequence[str], col: str, probs: Sequence[float],
                      n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """``(*by, q)``: linear-interpolated exact quantiles of every group (NULL values left out, no NULL keys).

    One histogram of (group, value) and one running count over it serve all groups, so
    neither a hot group nor many distinct values meet in one task.
    """
    hist = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("cnt"))
    return histogram_quantiles(hist, by, col, probs, n_buckets)


def histogram_quantiles(hist: DataFrame, by: Sequence[str], col: str, probs: Sequence[float],
                        n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """``grouped_quantiles`` of a histogram ``(*by, col, cnt)`` that is there already, one row per value."""
    cum = running_sums(hist, [*by, col], ["cnt"], prefix="cum_", n_buckets=n_buckets)
    ends = cum.groupBy(*by).agg(F.min(F.col("cum_cnt") - F.col("cnt")).alias("_base"), F.sum("cnt").alias("_n"))
    ranked = cum.join(ends, list(by)).withColumn("_to", F.col("cum_cnt") - F.col("_base"))
    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        aggs += [F.min(F.when(F.col("_to") > F.floor(pos), F.col(col).cast("double"))).alias(f"_lo{i}"),
                 F.min(F.when(F.col("_to") > F.ceil(pos), F.col(col).cast("double"))).alias(f"_hi{i}"),
                 F.max(pos - F.floor(pos)).alias(f"_part{i}")]
    q = [F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}") for i in range(len(probs))]
    return ranked.groupBy(*by).agg(*aggs).select(*by, F.array(*q).alias("q"))


# ---------------------------------------------------------------- approximate quantiles
SKETCH_K = 2000


def rank_error(k: int = SKETCH_K) -> float:
    """Published normalised rank error (99 % confidence) of all quantiles of a KLL sketch of size ``k`` at once."""
    return 2.446 / k ** 0.9433


def quantile_sketches(df: DataFrame, by: Sequence[str], col: str, k: int = SKETCH_K) -> DataFrame:
    """``(*by, n, sketch)``: a KLL sketch of each group's values, NULL and NaN left out.

    Sketches merge (``merged_sketches``), so they are kept per day or week and a new one costs only
    its own rows.  Their size does not grow with the values.
    """
    x = nan_to_null(F.col(col).cast("double"))
    rows = df.select(*by, x.alias("_x")).where("_x is not null")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_x", F.lit(k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of finer groups added up to those of ``by``."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(*by, q)``: approximate quantiles, each within ``rank_error`` of its rank."""
    return sketches.select(*by, F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs]).alias("q"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Linear-interpolated exact quantiles (numpy / pandas default) as one row.

    Works on the distinct-value histogram with two-phase cumulative counts, so
    no task holds more than one bucket of distinct values.  Output: one row,
    column ``q`` = array of quantiles in ``probs`` order.
    """
    hist = value_counts(df, col)
    cum = running_sums(hist, [col], ["cnt"], prefix="cum_", n_buckets=n_buckets)
    n = cum.agg(F.max("cum_cnt").alias("n")).select(F.struct("n")).scalar().getField("n")
    rows = []
    for i, p in enumerate(probs):
        pos = (n - 1).cast("double") * F.lit(float(p))
        lo = F.floor(pos).cast("bigint")
        hi = F.ceil(pos).cast("bigint")
        # value at 0-based rank r: cum_cnt - cnt <= r < cum_cnt
        first = F.col("cum_cnt") - F.col("cnt")
        rows.append(F.struct(
            F.lit(i).alias("i"),
            F.min(F.when((first <= lo) & (lo < F.col("cum_cnt")), F.col(col))).alias("v_lo"),
            F.min(F.when((first <= hi) & (hi < F.col("cum_cnt")), F.col(col))).alias("v_hi"),
            (pos - lo.cast("double")).alias("frac"),
        ))
    agg = cum.agg(F.array(*rows).alias("parts"))
    return agg.select(F.transform(
        "parts", lambda s: s["v_lo"].cast("double")
        + (s["v_hi"].cast("double") - s["v_lo"].cast("double")) * s["frac"]
    ).alias("q"))
