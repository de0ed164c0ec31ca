"""Exact metric range join of vectors by pivots, and the near-duplicate components it links.

Vectors are compared with those of the same label (and dimension) only.  On the unit
sphere a cosine of at least ``c`` is a distance of at most ``sqrt(2 - 2c)``.  Pivots, one
for about ``CELL`` vectors of a label, cut the label into the cells of their nearest
pivot.  By the triangle inequality a vector can only have a partner in another cell if
that cell's pivot is at most two radii farther than its own; the distance to the two
pivots' bisecting plane says it more tightly.  Such boundary vectors are copied to the
cell of smaller number, so every pair of partners meets in exactly one cell, and cells
join independently.

Vectors meet pivots in groups of about ``DEAL`` vectors and ``TILE`` pivots, once to find
the nearest pivot and once to find the cells to be copied to, so a task's memory does not
grow with a label.

Equal vectors collapse to one class first, with a count.  A cell is worked on in pairs of
blocks of ``BLOCK`` vectors, so a hot cell is many groups; a group returns each vector's
number of links and a spanning forest of them, never pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows with a null label, link with nothing and are kept; repeated rows are vectors of
their own that link at cosine 1; other columns are not read, whatever their names; an
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.components import connected, forest
from tidewatch.session import checkpointed

COSINE = 0.93
CELL, BLOCK, DEAL, TILE = 2000, 1024, 8192, 2048
SEED = 31


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def classes(vectors: DataFrame, id: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the key of their class, and the distinct usable vectors with id, count and smallest row id."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col(label).isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    key = lambda n: F.when(usable, F.xxhash64(F.lit(n), v))
    rows = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), v.alias("v"),
                          key(SEED).alias("h1"), key(SEED + 1).alias("h2"))
    distinct = (rows.where("h1 is not null").groupBy("label", "h1", "h2")
                .agg(F.first("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("least"))
                .withColumn("dim", F.size("v")).withColumn("c", F.monotonically_increasing_id()))
    return rows.drop("v"), checkpointed(distinct)


def _dealt(distinct: DataFrame, cell: int, deal: int, tile: int) -> tuple[DataFrame, DataFrame]:
    """Vectors with their deal and their label's number of tiles, and pivots by (label, dim, deal, tile)."""
    sizes = distinct.groupBy("label", "dim").agg(F.count("*").alias("m")).withColumn("k", F.ceil(F.col("m") / cell))
    sizes = sizes.withColumn("deals", F.ceil(F.col("m") / deal)).withColumn("tiles", F.ceil(F.col("k") / tile))
    # a fraction of k / m of each label by hash, so pivots need no sort of a label; a label may have none
    dealt = (distinct.join(sizes, ["label", "dim"]).withColumn("label", F.col("label").cast("string"))
             .withColumn("pick", F.pmod(F.xxhash64(F.lit(SEED), "h1", "h2"), F.lit(1 << 32))))
    pivots = (dealt.where(F.col("pick") < F.col("k") / F.col("m") * float(1 << 32))
              .withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)))
              .select(F.col("label").alias("p_label"), F.col("dim").alias("p_dim"), F.col("deal").alias("p_deal"),
                      F.pmod(F.xxhash64("h2"), F.col("tiles")).alias("p_tile"), F.col("c").alias("p_c"), F.col("v").alias("p")))
    rows = dealt.withColumn("deal", F.pmod(F.xxhash64("h1"), F.col("deals"))).select("label", "dim", "deal", "tiles", "c", "n", "v")
    return rows, pivots


def _unit(column) -> np.ndarray:
    x = _matrix(column)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cells(distinct: DataFrame, radius: float, cell: int = CELL, deal: int = DEAL, tile: int = TILE) -> DataFrame:
    """``(label, dim, cell, home, c, n, v)``: every vector in its own cell and, where it may have partners, in others.

    A cell is named by its pivot's ``c``; the cell of a label without pivots is -1.
    """
    rows, pivots = _dealt(distinct, cell, deal, tile)
    place = ["label", "dim", "deal", "tile"]
    keyed = pivots.groupBy("p_label", "p_dim", "p_deal", "p_tile")
    tiled = lambda df: df.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).groupBy(*place)

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        m = left.num_rows
        near, own, pivot = np.full(m, np.inf), np.full(m, -1, np.int64), pa.nulls(m, pa.list_(pa.float64()))
        if m and right.num_rows:
            u, p, best = _unit(left["v"]), _unit(right["p"]), np.zeros(m, np.int64)
            for at in range(0, m, BLOCK):
                square = np.maximum(2 - 2 * u[at:at + BLOCK] @ p.T, 0)             # squared distances to the pivots
                best[at:at + BLOCK] = square.argmin(axis=1)
                near[at:at + BLOCK] = square.min(axis=1)
            own, pivot = right["p_c"].to_numpy()[best], right["p"].take(pa.array(best))
        kept = [left[name] for name in ("label", "dim", "deal", "tiles", "c", "n", "v")]
        return pa.table([*kept, pa.array(near), pa.array(own), pivot],
                        ["label", "dim", "deal", "tiles", "c", "n", "v", "near", "own", "p"])

    def reached(left: pa.Table, right: pa.Table) -> pa.Table:
        m = left.num_rows
        counts, found = np.zeros(m, np.int64), [np.zeros(0, np.int64)]
        own = left["own"].to_numpy() if m else np.zeros(0, np.int64)
        first = bool(m) and left["tile"][0].as_py() == 0   # the first tile's group also gives the own cell
        if m and right.num_rows:
            x, o, p, name = _unit(left["v"]), _unit(left["p"]), _unit(right["p"]), right["p_c"].to_numpy()
            near = left["near"].to_numpy()
        for at in range(0, m, BLOCK):
            some = slice(at, at + BLOCK)
            reach = np.zeros((len(own[some]), 0), bool)
            if right.num_rows:
                square = np.maximum(2 - 2 * x[some] @ p.T, 0)
                apart = np.sqrt(np.maximum(2 - 2 * o[some] @ p.T, 0))
                # distance to the bisecting plane times twice the pivots' distance, with room for rounding
                reach = (square - near[some, None]) <= 2 * apart * radius + 1e-9
                reach &= name[None, :] < own[some, None]
            there = np.concatenate([np.full((len(reach), int(first)), True), reach], axis=1)
            who, where = np.nonzero(there)
            counts[some] = there.sum(axis=1)
            of = where - int(first)
            found.append(np.where(of < 0, own[some][who], name[of] if right.num_rows else -1))
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int64)))
        out = pa.table([*[left[k] for k in ("label", "dim", "own", "c", "n", "v")], lists], ["label", "dim", "own", "c", "n", "v", "cells"])
        return out.filter(pa.array(counts > 0))

    vector = "label string, dim int, deal long, tiles long, c long, n long, v array<double>"
    met = tiled(rows).cogroup(keyed).applyInArrow(nearest, f"{vector}, near double, own long, p array<double>")
    homes = (met.groupBy("c").agg(*[F.first(k).alias(k) for k in ("label", "dim", "deal", "tiles", "n", "v")],
                                  F.min_by(F.struct("near", "own", "p"), F.struct("near", "own")).alias("best"))
             .select("label", "dim", "deal", "tiles", "c", "n", "v", "best.*"))
    copies = tiled(homes).cogroup(keyed).applyInArrow(reached, "label string, dim int, own long, c long, n long, v array<double>, cells array<long>")
    return (copies.withColumn("cell", F.explode("cells"))
            .select("label", "dim", "cell", (F.col("cell") == F.col("own")).alias("home"), "c", "n", "v"))


def links(assigned: DataFrame, cosine: float, block: int = BLOCK) -> DataFrame:
    """``(a, b, links)``: vector ``a`` has so many further links (copies counted), and hangs together with ``b``."""
    cell = ["label", "dim", "cell"]
    sizes = assigned.groupBy(*cell).agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("guests"))
    sizes = (sizes.withColumn("nh", F.ceil(F.col("homes") / block)).withColumn("ng", F.ceil(F.col("guests") / block))
             .select(*cell, "nh", "ng"))
    rows = assigned.join(sizes, cell).withColumn("part", F.when(F.col("home"), F.pmod(F.xxhash64("c"), F.col("nh")))
                                                 .otherwise(F.pmod(F.xxhash64("c"), F.greatest("ng", F.lit(1))) + F.col("nh")))
    # a home block meets the home blocks and the guest blocks; guests meet the home blocks
    others = F.when(F.col("home"), F.sequence(F.lit(0).cast("long"), F.col("nh") + F.col("ng") - 1)).otherwise(
        F.when(F.col("nh") > 0, F.sequence(F.lit(0).cast("long"), F.col("nh") - 1)))
    rows = (rows.withColumn("other", F.explode(others))
            .withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other")))

    def join(group: pa.Table) -> pa.Table:
        part, lo, hi = (group[k].to_numpy() for k in ("part", "lo", "hi"))
        c, n, x = group["c"].to_numpy(), group["n"].to_numpy(), _matrix(group["v"])
        norm = np.sqrt((x * x).sum(axis=1))
        left, right = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
        same = lo[0] == hi[0]
        counts = np.zeros(len(c), np.int64)
        edge_a, edge_b = [c[:0]], [c[:0]]
        for at in range(0, len(left), block):               # a block's size is only about ``block``
            some = left[at:at + block]
            close = x[some] @ x[right].T / (norm[some, None] * norm[None, right]) >= cosine
            i, j = np.nonzero(close)
            i, j = some[i], right[j]
            if same:
                i, j = i[i != j], j[i != j]
            np.add.at(counts, i, n[j])
            if not same:
                np.add.at(counts, j, n[i])
            a, b = forest(c[i], c[j])
            edge_a.append(a)
            edge_b.append(b)
        a, b = forest(np.concatenate(edge_a), np.concatenate(edge_b))
        linked = np.flatnonzero(counts)
        return pa.table([pa.array(np.concatenate([c[linked], a])), pa.array(np.concatenate([c[linked], b])),
                         pa.array(np.concatenate([counts[linked], np.zeros(len(a), np.int64)]))], ["a", "b", "links"])

    keyed = rows.select(*cell, "lo", "hi", "part", "c", "n", "v")
    return keyed.groupBy(*cell, "lo", "hi").applyInArrow(join, "a long, b long, links long")


def near_duplicates(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = COSINE, cell: int = CELL, block: int = BLOCK, deal: int = DEAL, tile: int = TILE) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id`` (smallest linked id) and ``kept``."""
    rows, distinct = classes(vectors, id, vector, label)
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    assigned = checkpointed(cells(distinct, radius, cell, deal, tile))
    found = checkpointed(links(assigned, cosine, block))
    roots = connected(found.select("a", "b"))
    counted = found.groupBy(F.col("a").alias("c")).agg(F.sum("links").alias("links"))
    named = (distinct.select("label", "h1", "h2", "c", "n", "least")
             .join(roots.withColumnRenamed("node", "c"), "c", "left").join(counted, "c", "left")
             .withColumn("root", F.coalesce("root", "c")))
    best = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(best, "root").select(F.col("label").alias("l"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), "component",
                                            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    out = rows.join(named, (F.col("label") == F.col("l")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    component = F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
