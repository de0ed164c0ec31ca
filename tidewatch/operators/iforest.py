"""Isolation forest (Liu, Ting & Zhou, 2008) as Spark jobs — MLlib has none.

Fit
  1. a *pool* of rows is drawn by a keyed hash filter (expected size
     ``pool_factor · n_trees · psi``, independent of the table size);
  2. the pool is exploded over tree ids; each tree keeps the ``psi`` rows with the
     smallest hash of (seed, tree, key) — a window partitioned by tree over at most
     the pool, so no task ever sees the whole table;
  3. ``groupBy(tree).applyInPandas`` grows one tree per group (numpy, ≤ psi rows).
Score
  the node table (≤ n_trees · (2·psi − 1) rows, bounded by construction) is
  broadcast and every partition is scored with vectorised numpy in
  ``mapInPandas`` — Arrow batches, no per-row Python.

Decision value follows the common convention: ``score_samples = −2^(−E[h]/c(psi))``
and, for the automatic offset, ``decision = score_samples + 0.5`` (negative =
outlier).  A contamination share instead sets the offset to that quantile of
``score_samples`` over the scored table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"


def average_path_length(n):
    """c(n): mean path length of an unsuccessful search in a binary search tree."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow_tree(X: np.ndarray, tree: int, seed: int, psi: int) -> list[tuple]:
    rng = np.random.default_rng([seed, tree])
    limit = int(math.ceil(math.log2(max(psi, 2))))
    rows, stack = [], [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        node, idx, depth = stack.pop()
        sub = X[idx]
        if depth >= limit or len(idx) <= 1:
            rows.append((tree, node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            rows.append((tree, node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= thr
        left, right = next_id, next_id + 1
        next_id += 2
        rows.append((tree, node, f, thr, left, right, len(idx), depth))
        stack.append((right, idx[~go_left], depth + 1))
        stack.append((left, idx[go_left], depth + 1))
    return rows


def fit(df: DataFrame, key_cols: Sequence[str], features: str, n_trees: int = 100, max_samples: int = 256,
        seed: int = 42, pool_factor: float = 2.0) -> tuple[pd.DataFrame, int]:
    """Grow the forest; returns the node table (bounded size) and the sub-sample size psi."""
    n = df.count()
    psi = int(min(max_samples, n))
    p = min(1.0, pool_factor * n_trees * psi / max(n, 1))
    keys = [F.col(c) for c in key_cols]
    pool = df.where(F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 62)) <= int(p * ((1 << 62) - 1))).select(*key_cols, features)
    # keys are ranked per tree first; features follow for the sampled keys only (<= n_trees * psi rows)
    exploded = pool.select(*key_cols).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(
        F.xxhash64(F.lit(seed), F.col("tree"), *keys), *keys))
    chosen = exploded.withColumn("_r", rank).where(F.col("_r") <= psi)
    chosen = chosen.select("tree", *[F.col(c).alias(f"_k_{c}") for c in key_cols])
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key_cols]
    sample = pool.join(F.broadcast(chosen), reduce(and_, same)).select("tree", features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        X = np.vstack(pdf[features].to_numpy()).astype(float)
        t = int(pdf["tree"].iloc[0])
        return pd.DataFrame(_grow_tree(X, t, seed, psi),
                            columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])

    nodes = sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    return nodes, psi


def _pack(nodes: pd.DataFrame) -> list[dict]:
    packed = []
    for _, t in nodes.groupby("tree"):
        t = t.sort_values("node")
        m = int(t["node"].max()) + 1
        arr = {k: np.full(m, -1, dtype=np.int64) for k in ("feature", "left", "right")}
        thr = np.zeros(m)
        leaf_value = np.zeros(m)
        ids = t["node"].to_numpy()
        for k in arr:
            arr[k][ids] = t[k].to_numpy()
        thr[ids] = t["threshold"].to_numpy()
        leaf_value[ids] = t["depth"].to_numpy() + average_path_length(t["size"].to_numpy())
        packed.append({"feature": arr["feature"], "left": arr["left"], "right": arr["right"],
                       "threshold": thr, "leaf_value": leaf_value})
    return packed


def score(spark: SparkSession, df: DataFrame, key_cols: Sequence[str], features: str,
          nodes: pd.DataFrame, psi: int) -> DataFrame:
    """Adds ``score_samples`` and ``decision`` (automatic offset) per row."""
    bc = spark.sparkContext.broadcast(_pack(nodes))
    c_psi = float(average_path_length(np.array([psi]))[0]) or 1.0
    fields = [df.schema[c] for c in key_cols]
    out_schema = T.StructType(fields + [T.StructField("score_samples", T.DoubleType()),
                                        T.StructField("decision", T.DoubleType())])

    def run(batches):
        trees = bc.value
        for pdf in batches:
            X = np.vstack(pdf[features].to_numpy()).astype(float) if len(pdf) else np.zeros((0, 1))
            total = np.zeros(len(pdf))
            rows = np.arange(len(pdf))
            for t in trees:
                node = np.zeros(len(pdf), dtype=np.int64)
                while True:
                    f = t["feature"][node]
                    internal = f >= 0
                    if not internal.any():
                        break
                    r = rows[internal]
                    nd = node[internal]
                    go_left = X[r, f[internal]] <= t["threshold"][nd]
                    node[internal] = np.where(go_left, t["left"][nd], t["right"][nd])
                total += t["leaf_value"][node]
            mean_h = total / max(len(trees), 1)
            s = -np.power(2.0, -mean_h / c_psi)
            res = pdf[list(key_cols)].copy()
            res["score_samples"] = s
            res["decision"] = s + 0.5
            yield res

    return df.select(*key_cols, features).mapInPandas(run, out_schema)


def with_contamination(scored: DataFrame, share: float) -> DataFrame:
    """M7: offset = ``share`` quantile of ``score_samples``; flag rows below it."""
    from tidewatch.operators.ordering import exact_quantiles
    q = exact_quantiles(scored, "score_samples", [share]).select(F.struct(F.col("q")[0].alias("o"))).scalar().o
    return scored.withColumns({"decision": F.col("score_samples") - q,
                               "is_outlier": F.col("score_samples") - q < 0})


def feature_array(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Pack numeric columns (NULL → 0) into one ``array<double>`` column."""
    return df.withColumn(out, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]))
