"""Whitening of embeddings by shifted Cholesky QR.

Vectors become integer grid vectors ``floor(scale * c)``; each distinct one counts once.  The centred
rows are made orthonormal without ever meeting in one place: a pass sums each task's Gram matrix, a
tree of bounded groups adds these up, and the driver factors the one d x d sum.  The first factor is of
the Gram matrix plus a shift above its rounding error, so it exists for any data; every further
pass sends the rows through the triangular solves of all factors so far and factors what comes out,
until that is orthonormal to rounding.  The product of the factors is R of the rows; its singular
value decomposition has the covariance's eigenvectors and, squared over n, its eigenvalues.  So
no square of the condition number enters, as it would by eigenvectors of the Gram matrix.

The driver holds d x d numbers, whatever the number of rows.  The distinct vectors are stored once
in the shared folder; a lost executor costs its tasks of one pass.

Defined cases: a row whose vector is null, or holds a null or non-finite entry, gives no rows; so does a vector
shorter than the longest (it lacks entries); repeated rows and ids are rows of their own, but one in the
fit; directions without variance are no components, so there may be fewer than asked for (none where all vectors
are equal, or there are none); an empty table gives an empty table; entries count up to 2**53 / scale, larger ones as
that; a ``deviation`` beyond a long is null; only the id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import checkpointed

SCALE, COMPONENTS = 256, 4
#: Partial sums that are added in one task.
FAN_IN = 16
#: Rows worked on together in a task.
ROWS = 4096
MOST_PASSES = 6
LARGEST = 1 << 53
UNIT = float(np.finfo(np.float64).eps) / 2


def grid(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(id, x)`` of the whole rows: ``x`` holds ``floor(scale * c)`` as longs."""
    v = F.col(f"`{vector}`").cast("array<double>")
    out = vectors.select(F.col(f"`{id}`").alias("id"), v.alias("v")).where("v is not null")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    out = out.where(F.forall("v", finite))
    most = lambda c: F.greatest(F.least(F.floor(c * scale), F.lit(LARGEST)), F.lit(-LARGEST))
    return out.select("id", F.transform("v", most).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _blocks(batches, d: int):
    for batch in batches:
        x = _matrix(batch.column(batch.schema.get_field_index("x")), d)
        for a in range(0, len(x), ROWS):
            yield x[a:a + ROWS]


def summed(rows: DataFrame, part, shape: tuple, whole: bool = False) -> np.ndarray:
    """The sum of ``part(block)`` over all blocks of ``rows (x)``, added up in groups of ``FAN_IN`` partial sums.

    With ``whole`` the parts are exact integers (Python's, of any size); else doubles.
    """
    d = shape[-1]

    def pack(total: np.ndarray) -> bytes:
        return "|".join(map(str, total.ravel().tolist())).encode() if whole else total.tobytes()

    def unpack(raw: bytes) -> np.ndarray:
        return np.array([int(v) for v in raw.split(b"|")], object) if whole else np.frombuffer(raw)

    def first(batches):
        from pyspark import TaskContext
        total = np.zeros(shape, object if whole else float)
        for x in _blocks(batches, d):
            total = total + part(x)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([pack(total)], pa.binary())],
                                         ["part", "total"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        parts = sorted(zip(table["part"].to_pylist(), table["total"].to_pylist()))      # one order of additions
        total = sum((unpack(raw) for _, raw in parts[1:]), unpack(parts[0][1]))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "total": pa.array([pack(total)], pa.binary())})

    out = rows.select("x").mapInArrow(first, "part long, total binary")
    count = rows.rdd.getNumPartitions()                    # known without a job: the rows are stored
    while count > FAN_IN:
        out = out.groupBy(F.expr(f"part div {FAN_IN}").alias("k")).applyInArrow(add, "part long, total binary")
        count = -(-count // FAN_IN)
    parts = sorted((r.part, bytes(r.total)) for r in out.collect())                       # at most FAN_IN
    return sum((unpack(raw) for _, raw in parts), np.zeros(int(np.prod(shape)), object if whole else float)).reshape(shape)


def solved(x: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``x`` times the inverse of each upper triangular factor in turn, by substitution."""
    for r in factors:
        q = np.empty_like(x)
        for j in range(len(r)):
            q[:, j] = (x[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        x = q
    return x


def factored(gram_of, d: int, n: int) -> tuple[np.ndarray, int]:
    """R, and the rank, of the rows whose Gram matrix, after solves by given factors, ``gram_of(factors)`` sums.

    Passes end when the rows are orthonormal to rounding but for directions that hold none.
    """
    factors: list[np.ndarray] = []
    for _ in range(MOST_PASSES):
        gram = gram_of(factors)
        gram = (gram + gram.T) / 2
        values = np.linalg.eigvalsh(gram)
        if factors and (np.minimum(np.abs(values - 1), np.abs(values)) < 64 * d * UNIT).all():
            break
        norm = float(max(values[-1], 0.0))
        shift = 11 * (n * d + d * (d + 1)) * UNIT * norm
        for _ in range(60):
            lift = 0.0 if factors and values[0] > 0.25 else max(shift, np.finfo(float).tiny)
            try:
                factors.append(np.linalg.cholesky(gram + lift * np.eye(d)).T)
                break
            except np.linalg.LinAlgError:
                shift *= 4
    r = np.eye(d)
    for f in factors:
        r = f @ r
    return r, int(np.count_nonzero(values > 0.5))


def components(r: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, falling, eigenvectors (columns) and trace of the covariance, from R."""
    _, s, vt = np.linalg.svd(r)
    values = s * s / n
    return values, vt.T, float(values.sum())


def whitened(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
             components_: int = COMPONENTS) -> DataFrame:
    """A row per whole vector and component: ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    ``n`` is the number of distinct grid vectors, ``deviation`` the exact squared length of
    ``n * x - sum``, ``identity_error`` the largest entry of the fit's whitened covariance minus the identity.
    """
    names = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    kind = vectors.schema[id].dataType.simpleString()
    schema = f"id {kind}, {names}"
    rows = grid(vectors, id, vector, scale)
    d = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.where(F.size("x") == d)
    empty = vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id)
    if not d:
        return empty
    fit = checkpointed(rows.select("x").distinct())
    n = fit.count()

    def exact(x: np.ndarray) -> np.ndarray:                # halves, so that sums of a block stay within a long
        high = (x >> 32).sum(0).astype(object)
        return high * (1 << 32) + (x & 0xFFFFFFFF).sum(0).astype(object)

    sums = summed(fit, exact, (d,), whole=True)
    mean = np.array([v / n for v in sums], float)          # Python's division of integers is rounded once

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            q = solved(x - mean, factors)
            return q.T @ q
        return summed(fit, part, (d, d))

    r, rank = factored(gram_of, d, n)
    values, axes, trace = components(r, n)
    rounding = 8 * d * UNIT * (np.sqrt(values[0]) + np.abs(mean).max())       # of centred entries: no direction below is real
    k = min(components_, rank, int(np.count_nonzero(np.sqrt(values) > rounding)))
    if not k:
        return empty
    project = axes[:, :k] / np.sqrt(values[:k])
    share = values[:k] / trace

    def moments(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ project
        out = np.zeros((k + 1, d))                         # the Gram matrix, and below it the sums
        out[:k, :k] = w.T @ w
        out[k, :k] = w.sum(0)
        return out

    m = summed(fit, moments, (k + 1, d))
    centre = m[k, :k] / n
    error = float(np.abs(m[:k, :k] / n - np.outer(centre, centre) - np.eye(k)).max())

    def deviations(x: np.ndarray) -> list:
        far = [abs(int(v)) for v in sums]
        if (n * int(np.abs(x).max(initial=0)) + max(far)) ** 2 * d < 1 << 63:
            out = n * x - np.array(sums, np.int64)
            return (out * out).sum(1).tolist()
        out = ((n * x.astype(object) - sums) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in out]

    def show(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                piece = batch.slice(a, ROWS)
                x = _matrix(piece.column(1), d)
                w = (x - mean) @ project
                row = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(row), n, np.int64)), pa.array(deviations(x), pa.int64()).take(pa.array(row)), pa.array(w.ravel()),
                     pa.array(np.tile(share, len(x))), pa.array(np.full(len(row), error))],
                    ["id", *[part.split()[0] for part in names.split(", ")]])

    return rows.select("id", "x").mapInArrow(show, schema).withColumnRenamed("id", id)
