"""Isotonic regression of 0/1 labels on a score, pooled in blocks and merged in a tree.

1. Rows collapse into positives and negatives per distinct score (partial aggregation).
2. The histogram is range-partitioned by score; every range pools its adjacent violators by itself.
3. Neighbouring ranges' blocks meet ``FAN_IN`` at a time, level by level, and pool on.  Pooling is
   associative: blocks pooled early would be pooled in the end, as the fit is the lower hull of the
   cumulative sums, and a hull of hulls is the hull.  Counts are integers, so ties are exact.

The last level holds the blocks of the fit, of which there are far fewer than rows: their corners are
lattice points of a convex curve in (rows, positives), at most about 3 * (rows * positives) ** (1/3).

Scores map to the fit by linear interpolation between blocks, and to the end blocks outside them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.exprs import nan_to_null
from tidewatch.operators.ordering import label_histogram, ranged
from tidewatch.session import checkpointed

FAN_IN = 16
#: A fit of at most so many blocks goes to the tasks as two arrays; a longer one is joined by range.
FEW_BLOCKS = 20_000
BLOCK = "part long, lo double, hi double, pos long, n long"


def pooled(lo, hi, pos, n) -> list[tuple]:
    """Adjacent blocks in score order, pooled while a block's rate is not above that of the one before."""
    out: list[list] = []
    for block in zip(lo, hi, pos, n):
        block = list(block)
        while out and out[-1][2] * block[3] >= block[2] * out[-1][3]:
            last = out.pop()
            block = [last[0], block[1], last[2] + block[2], last[3] + block[3]]
        out.append(block)
    return out


def _pool(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("lo")
    rows = pooled(*(table[c].to_pylist() for c in ("lo", "hi", "pos", "n")))
    lo, hi, pos, n = zip(*rows)
    part = pa.array([key[0].as_py()] * len(rows), pa.int64())
    return pa.table({"part": part, "lo": pa.array(lo, pa.float64()), "hi": pa.array(hi, pa.float64()), "pos": pa.array(pos, pa.int64()),
                     "n": pa.array(n, pa.int64())})


def isotonic_fit(df: DataFrame, score: str, label: str, n_buckets: int | None = None) -> DataFrame:
    """``(lo, hi, value, n)``: the blocks of the fit, ``value`` rising strictly from block to block.

    Rows without a score or a label are left out; an empty table has no blocks.
    """
    hist = label_histogram(df, score, label).where(F.col(score).isNotNull())
    hist = hist.select(F.col(score).cast("double").alias("lo"), F.col(score).cast("double").alias("hi"), "pos", (F.col("pos") + F.col("neg")).alias("n"))
    parts = ranged(hist, ["lo"], n_buckets, "part")
    count = (parts.agg(F.max("part")).first()[0] or 0) + 1
    blocks = parts.select(F.col("part").cast("long").alias("part"), "lo", "hi", "pos", "n").groupBy("part").applyInArrow(_pool, BLOCK)
    while count > 1:
        blocks = blocks.groupBy(F.expr(f"part div {FAN_IN}").alias("upper")).applyInArrow(_pool, BLOCK)
        count = -(-count // FAN_IN)
    return blocks.select("lo", "hi", (F.col("pos") / F.col("n")).alias("value"), "n")


def isotonic_scores(df: DataFrame, score: str, blocks: DataFrame, out: str) -> DataFrame:
    """``df`` with the fitted value of ``score``; NULL for a NULL or NaN score, or without a fit."""
    blocks = checkpointed(blocks)
    if blocks.limit(FEW_BLOCKS + 1).count() > FEW_BLOCKS:
        return _joined_scores(df, score, blocks, out)
    rows = sorted((r.lo, r.hi, r.value) for r in blocks.collect())                            # <= FEW_BLOCKS
    x = np.array([e for lo, hi, _ in rows for e in (lo, hi)])
    y = np.array([v for *_, v in rows for _ in range(2)])

    def apply(scores: pa.Array) -> pa.Array:
        s = scores.to_numpy(zero_copy_only=False).astype(float)
        return pa.array(np.interp(s, x, y), mask=np.isnan(s)) if len(x) else pa.nulls(len(s), pa.float64())

    return df.withColumn(out, F.arrow_udf(apply, "double")(nan_to_null(F.col(score).cast("double"))))


def _joined_scores(df: DataFrame, score: str, blocks: DataFrame, out: str, n_buckets: int | None = None) -> DataFrame:
    """The same by two-phase look-behind and look-ahead over distinct scores and block ends in score order."""
    s = nan_to_null(F.col(score).cast("double"))
    point = F.struct(F.col("x"), F.col("value").alias("y"))
    ends = blocks.select(F.explode(F.array("lo", "hi")).alias("x"), "value").distinct().select("x", F.lit(0).alias("kind"), point.alias("point"))
    asked = df.select(s.alias("x")).where("x is not null").distinct().select("x", F.lit(1).alias("kind"), F.lit(None).cast(ends.schema["point"].dataType).alias("point"))
    line = ranged(ends.unionByName(asked), ["x", "kind"], n_buckets, "part")
    seen = line.groupBy("part").agg(F.max_by("point", F.when(F.col("point").isNotNull(), F.col("x"))).alias("last"),
                                    F.min_by("point", F.when(F.col("point").isNotNull(), F.col("x"))).alias("first"))
    parts = Window.orderBy("part")                                                            # one row per range
    seen = seen.select("part", F.last("last", True).over(parts.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
                       F.first("first", True).over(parts.rowsBetween(1, Window.unboundedFollowing)).alias("later"))
    inside = Window.partitionBy("part").orderBy("x", "kind")
    near = line.join(F.broadcast(seen), "part").select(
        "x", "kind", F.coalesce(F.last("point", True).over(inside.rowsBetween(Window.unboundedPreceding, 0)), "earlier").alias("a"),
        F.coalesce(F.first("point", True).over(inside.rowsBetween(0, Window.unboundedFollowing)), "later").alias("b")).where("kind = 1")
    a, b = F.col("a"), F.col("b")
    value = (F.when(a.isNull(), b.y).when(b.isNull() | (a.x == F.col("x")), a.y)
             .otherwise(a.y + (b.y - a.y) * (F.col("x") - a.x) / (b.x - a.x)))
    fitted = near.select(F.col("x").alias("_x"), value.alias(out))
    return df.join(fitted, s == F.col("_x"), "left").drop("_x")
