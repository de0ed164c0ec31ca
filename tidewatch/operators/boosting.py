"""Second-order boosted trees on Spark: gradient and hessian histograms, all rounds in a few barrier stages.

The features become bin numbers once (edges from approximate percentiles of one aggregate) and are stored
in the shared folder.  A tree grows level by level: every task adds the first and second derivatives of
its rows to one histogram per (model, node, feature, bin), the histograms are added in a tree of
``FAN_IN``, and the first task picks the splits.  What a task sends is models x nodes x features x
bins numbers, however many rows there are; a leaf's value follows from its parent's histogram.

A level is little work, so a Spark job for each would mostly wait: ``RESTART_EVERY`` rounds are one barrier
stage, whose tasks run together, hold their rows as numpy chunks and leave each other their histograms and the splits
as small files in the shared folder (``BarrierTaskContext.allGather`` looks for answers once a second only).  A stage that
loses a task starts again as a whole, from the trees of the stages before it, in a folder of its own.  It needs as many free slots
as tasks, so Spark's dynamic allocation must be off.

Several models on the rows of one table (folds, class weights) grow side by side: a model is a
weight per row, 0 keeps a row out of it.  So five folds cost as many levels as one.

Derivatives are added as integers of ``1 / UNIT``: the sums, and with them the trees, do not depend on how
rows lie in partitions or on their order, nor on tasks that run again.
So of two sister nodes only the one of fewer rows is counted (the other is the exact difference), and features of few
bins share a histogram that is summed up to theirs at the end of a task.

Rows of a task that need more than ``HELD_BYTES`` lie in mapped temporary files of their executor instead of its memory.

Defined cases: rows with a null label or a null or zero weight take no part; null and NaN features count
as 0; a table without rows, or of one class only, gives trees of single leaves; extra columns are left alone.
"""

from __future__ import annotations

import math
import pickle
import tempfile
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_path
from tidewatch.sources import store

UNIT = 2.0 ** 20
FAN_IN = 16
MIN_TASK_ROWS = 1 << 14           # fewer rows than this are not worth a task of their own
CHUNK_ROWS = 1 << 15              # sums of units within a chunk stay exact in doubles
JOINT_CELLS = 4096                # cells of a histogram over the bins of several features
ADVANCE_EVERY = 1                 # rounds between two kept margins; a row repeats at most this many trees
RESTART_EVERY = 250               # rounds of one barrier stage; the next makes its margins from the stored rows
HELD_BYTES = 1 << 28              # more than this a task does not hold in memory


@dataclass
class Forest:
    """Fitted trees: arrays ``(models, rounds, nodes)`` in heap order; ``feature`` is -1 at a leaf."""

    names: list[str]
    columns: list[str]
    feature: np.ndarray
    threshold: np.ndarray          # a row goes right when its value is greater
    value: np.ndarray              # a leaf's share of the margin, step included

    def scores(self) -> Column:
        """Column of type ``array<double>``: the positive-class probability by each model, in order of ``names``.

        Values become their rank among the feature's thresholds once a batch, so that the trees compare bytes.
        """
        feature, value, n_cols = self.feature, self.value, len(self.columns)
        edges = [np.unique(self.threshold[feature == i]) for i in range(n_cols)]
        cut = np.zeros(feature.shape, np.int64)
        for i, e in enumerate(edges):
            cut[feature == i] = np.searchsorted(e, self.threshold[feature == i])
        code = _code_type(max(map(len, edges), default=0))

        def run(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), n_cols)
            x = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)]).astype(code)
            margins = np.stack([_margin(x, f, t, v) for f, t, v in zip(feature, cut, value)], 1)
            p = 1.0 / (1.0 + np.exp(-margins))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))

        return F.arrow_udf(run, "array<double>")(F.array(*[_number(c) for c in self.columns]))

    def score(self, df: DataFrame, out: str, model: str | None = None) -> DataFrame:
        """``df`` with the probability by one model (the first, unless named) as column ``out``."""
        return df.withColumn(out, self.scores()[self.names.index(model) if model else 0])

    def save(self, spark: SparkSession, path: str) -> None:
        """One row a node; models x rounds x nodes rows, so bounded by the settings of the fit."""
        rows = [(m, name, t, n, int(f), float(self.threshold[m, t, n]), float(self.value[m, t, n]), self.columns)
                for m, name in enumerate(self.names) for t in range(self.feature.shape[1])
                for n, f in enumerate(self.feature[m, t])]
        schema = "model int, name string, tree int, node int, feature int, threshold double, value double, columns array<string>"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        rows = spark.read.parquet(path).toPandas().sort_values(["model", "tree", "node"])     # as bounded as written
        shape = (rows.model.nunique(), rows.tree.nunique(), rows.node.nunique())
        names = rows.drop_duplicates("model").name.tolist()
        return cls(names, list(rows["columns"].iloc[0]), *(rows[c].to_numpy().reshape(shape) for c in ("feature", "threshold", "value")))


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(x.isNull() | F.isnan(x), 0.0).otherwise(x)


def _code_type(most: int) -> type:
    return np.uint8 if most < 256 else np.uint16 if most < 65536 else np.int64


def _places(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Per row of ``x`` (bin numbers, a feature a row) its place among the ``2 ** levels`` of that level, from the left.

    A leaf above that level sends its rows on to its left.  Whole columns of small integers are compared
    node by node, which costs a row less than following its own path.
    """
    at = np.zeros(x.shape[1], _code_type(2 ** levels - 1))
    for level in range(levels):
        _descend(at, x, feature, cut, level)
    return at


def _descend(at: np.ndarray, x: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> None:
    """Moves the rows at their places ``at`` of a level on to the next."""
    right = np.zeros(len(at), bool)
    for i, (f, c) in enumerate(zip(feature[2 ** level - 1:2 ** (level + 1) - 1].tolist(), cut[2 ** level - 1:].tolist())):
        if f >= 0:
            over = x[f] > c
            if level:
                over &= at == i
            right |= over
    at += at
    at += right


def _leaves(feature: np.ndarray, value: np.ndarray, levels: int) -> np.ndarray:
    """The value of a tree at each place of its last level: its own, or of the leaf above it."""
    out = value[:1]
    for level in range(levels):
        below = slice(2 ** (level + 1) - 1, 2 ** (level + 2) - 1)
        split = np.repeat(feature[2 ** level - 1:2 ** (level + 1) - 1] >= 0, 2)
        out = np.where(split, value[below], np.repeat(out, 2))
    return out


def _margin(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> np.ndarray:
    levels = (feature.shape[-1] + 1).bit_length() - 2
    out = np.zeros(x.shape[1])
    for f, c, v in zip(feature, cut, value):
        out += _leaves(f, v, levels).take(_places(x, f, c, levels).astype(np.intp))
    return out


def _sampled(ids: np.ndarray, salt: int, share: float) -> np.ndarray:
    """Rows of a share, by a mix of the stored row id and ``salt`` (so a task that runs again takes the same)."""
    z = ids.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))) < np.uint64(min(int(share * 2 ** 64), 2 ** 64 - 1))


def _bin_edges(df: DataFrame, cols: Sequence[str], bins: int) -> list[np.ndarray]:
    """Per feature at most ``bins - 1`` ascending edges: approximate percentiles, one aggregate for all.  None above which no
    value lies, as no row would be in its bin."""
    probs = [i / bins for i in range(1, bins)]
    found = [f(_number(c)) for c in cols for f in (lambda x: F.percentile_approx(x, probs, 100 * bins), F.max)]
    row = df.agg(*[c.alias(str(i)) for i, c in enumerate(found)]).first()
    edges = [np.unique(np.array(row[2 * i] or [0.0])) for i in range(len(cols))]
    return [e[:max(1, np.searchsorted(e, row[2 * i + 1] or 0.0, "left"))] for i, e in enumerate(edges)]


STORED = "_id long, _bins binary, _y double, _w array<double>"


def _stored(df: DataFrame, cols: Sequence[str], label: str, weights: Sequence[Column], edges: list[np.ndarray]) -> DataFrame:
    def run(rows: pa.Array) -> pa.Array:
        x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), len(edges))
        b = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)], 1).astype(np.uint8)
        ends = np.arange(len(rows) + 1, dtype=np.int32) * len(edges)
        return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(b.tobytes())])

    ws = F.array(*[F.coalesce(w.cast("double"), F.lit(0.0)) for w in weights])
    rows = df.where(F.col(label).isNotNull()).select(F.array(*[_number(c) for c in cols]).alias("_x"), F.col(label).cast("double").alias("_y"),
                                                     ws.alias("_w"))
    rows = rows.where(F.exists("_w", lambda w: w > 0))
    return rows.select(F.monotonically_increasing_id().alias("_id"), F.arrow_udf(run, "binary")("_x").alias("_bins"), "_y", "_w")


class _Room:
    """Arrays in memory or, ``mapped``, in temporary files without a name."""

    def __init__(self, mapped: bool):
        self.mapped, self.block, self.used = mapped, None, 0

    def empty(self, shape, dtype) -> np.ndarray:
        if not self.mapped:
            return np.empty(shape, dtype)
        size = -(-int(np.prod(shape)) * np.dtype(dtype).itemsize // 64) * 64
        if self.block is None or self.used + size > len(self.block):
            with tempfile.TemporaryFile() as f:
                self.block, self.used = np.memmap(f, np.uint8, "w+", shape=max(size, 1 << 26)), 0
        part, self.used = self.block[self.used:self.used + size], self.used + size
        return part.view(dtype)[:int(np.prod(shape))].reshape(shape)

    def keep(self, a: np.ndarray) -> np.ndarray:
        out = self.empty(a.shape, a.dtype)
        out[...] = a
        return out


class _Chunk:
    """Rows of a task: ids, bins by feature, cells by feature group, labels; by model weights, margins, places in the tree, whether
    the row is ``drawn`` in this round, and both derivatives in units side by side (whole numbers)."""

    def __init__(self, rows: pa.RecordBatch, sizes: Sequence[int], groups: Sequence[Sequence[int]], n_models: int, depth: int, room: _Room):
        n = rows.num_rows
        col = {c: rows.column(c) for c in rows.schema.names}
        ends = np.frombuffer(col["_bins"].buffers()[1], np.int32)[col["_bins"].offset:][:n + 1]
        bins = np.frombuffer(col["_bins"].buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(n, len(sizes))
        self.ids, self.x, self.y = room.keep(col["_id"].to_numpy()), room.keep(bins.T), room.keep(col["_y"].to_numpy())
        self.w = room.keep(col["_w"].flatten().to_numpy().reshape(n, n_models).T)
        self.most = n * np.fmax.reduce(self.w, axis=None, initial=0.0) * UNIT                # no sum of units is larger
        self.cells = room.empty((len(groups), n), np.uint16)
        for cell, g in zip(self.cells, groups):
            cell[:] = self.x[g[0]]
            for f in g[1:]:
                cell *= np.uint16(sizes[f])
                cell += self.x[f]
        self.margins, self.at = room.empty((n_models, n), np.float64), room.empty((n_models, n), _code_type(2 ** depth - 1))
        self.margins[:] = 0
        self.drawn = room.empty((n_models, n), bool)
        self.units = room.empty((n_models, n, 2), np.int32 if self.most < n * 2.0 ** 31 else np.float64)

    def draw(self, m: int, salt: int, share: float, margin: np.ndarray) -> None:
        """The model's rows of a round, at the root, and all rows' derivatives at ``margin``."""
        p = np.negative(margin)
        np.exp(p, out=p)
        p += 1.0
        np.divide(1.0, p, out=p)
        wu, h = self.w[m] * UNIT, 1 - p
        h *= p
        p -= self.y
        for i, d in enumerate((p, h)):
            d *= wu
            self.units[m, :, i] = np.rint(d, out=d)
        np.greater(self.w[m], 0, out=self.drawn[m])
        if share < 1:
            self.drawn[m] &= _sampled(self.ids, salt, share)
        self.at[m] = 0

    def add_to(self, total: Sequence[np.ndarray], m: int, spans: Sequence[int], level: int, wanted: np.ndarray | None) -> None:
        """Adds the derivatives of the model's drawn rows at ``wanted`` places to a histogram per feature group, as complex
        numbers: one pass adds both."""
        rows = np.flatnonzero(self.drawn[m] & wanted.take(self.at[m]) if level else self.drawn[m])
        whole = self.units.dtype == np.int32
        units = self.units[m].view(np.int64 if whole else np.complex128).ravel().take(rows)
        if whole:
            units = units.view(np.int32).astype(np.float64).view(np.complex128)
        node = (self.at[m].take(rows) >> 1).astype(np.intp) if level else None
        for code, span, out in zip(self.cells, spans, total):
            cell = code.take(rows).astype(np.intp)
            if level:
                cell += node * span
            np.add.at(out[m], cell, units)


def _chunks(batches: Iterator[pa.RecordBatch], *args) -> Iterator[_Chunk]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK_ROWS:
            yield _Chunk(pa.Table.from_batches(held).combine_chunks().to_batches()[0], *args)
            held = []
    if held:
        yield _Chunk(pa.Table.from_batches(held).combine_chunks().to_batches()[0], *args)


class _Meeting:
    """Where the tasks of a barrier stage add up their arrays and learn what the first of them makes of the sum.

    Every message is a file of the shared folder under a name of its own, written aside and renamed, so it is read
    whole; its reader deletes it, and the first task an answer once all have the next sums out."""

    def __init__(self, folder: str, tasks: int):
        context = BarrierTaskContext.get()
        self.task, self.tasks, self.step = context.partitionId(), tasks, 0
        if tasks > 1:
            attempt = context.allGather(str(context.taskAttemptId()))[0]                     # a stage that starts again has its own
            self.fs, self.folder = store.in_task(f"{folder}/{attempt}")
            self.fs.create_dir(self.folder, recursive=True)

    def _put(self, name: str, data: bytes) -> None:
        aside = f"{self.folder}/.{name}"
        with self.fs.open_output_stream(aside) as out:
            out.write(data)
        self.fs.move(aside, f"{self.folder}/{name}")

    def _get(self, name: str) -> bytes:
        path, began = f"{self.folder}/{name}", time.monotonic()
        while not self.fs.get_file_info(path).is_file:
            time.sleep(min(0.05, 0.0005 + (time.monotonic() - began) / 10))
        with self.fs.open_input_stream(path) as f:
            return f.read()

    def decide(self, mine: np.ndarray, choose: Callable[[np.ndarray], object]):
        """What ``choose`` (run by the first task) says of the sum over all tasks; added by ``FAN_IN``, so that none reads many."""
        self.step, span = self.step + 1, 1
        while span < self.tasks:
            if self.task % (span * FAN_IN):
                self._put(f"{self.step}-{self.task}", mine.tobytes())
                break
            for other in range(self.task + span, min(self.task + span * FAN_IN, self.tasks), span):
                mine = mine + np.frombuffer(self._get(f"{self.step}-{other}"), mine.dtype).reshape(mine.shape)
                self.fs.delete_file(f"{self.folder}/{self.step}-{other}")
            span *= FAN_IN
        if self.task:
            return pickle.loads(self._get(str(self.step)))
        answer = choose(mine)
        if self.tasks > 1:
            self._put(str(self.step), pickle.dumps(answer))
            if self.step > 1:
                self.fs.delete_file(f"{self.folder}/{self.step - 1}")
        return answer


def _joint(sizes: Sequence[int]) -> list[list[int]]:
    """Features in groups whose bins multiply to at most ``JOINT_CELLS``, the largest first: one histogram counts a whole group."""
    groups: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        fits = (g for g in groups if math.prod(sizes[i] for i in g) * sizes[f] <= JOINT_CELLS)
        g = next(fits, None)
        if g is None:
            groups.append(g := [])
        g.append(f)
    return groups


def best_splits(g: np.ndarray, h: np.ndarray, allowed: np.ndarray, l2: float, min_hessian: float):
    """Per node the split of most gain: ``(gain, feature, bin, left G, left H, G, H)`` from ``(nodes, features, bins)`` sums.

    Gain is ``GL²/(HL+l2) + GR²/(HR+l2) - G²/(H+l2)``; both sides need ``min_hessian``; ties go to the first.
    """
    gl, hl = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
    total_g, total_h = g[:, 0].sum(1), h[:, 0].sum(1)
    gr, hr = total_g[:, None, None] - gl, total_h[:, None, None] - hl
    ok = (hl >= min_hessian) & (hr >= min_hessian) & allowed[None, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - (total_g ** 2 / (total_h + l2))[:, None, None]
    gain = np.where(ok & np.isfinite(gain), gain, -np.inf).reshape(len(g), -1)
    best = gain.argmax(1)
    node = np.arange(len(g))
    f, b = best // gl.shape[2], best % gl.shape[2]
    return gain[node, best], f, b, gl[node, f, b], hl[node, f, b], total_g, total_h


def fit(df: DataFrame, cols: Sequence[str], label: str, weights: Mapping[str, Column] | None = None, rounds: int = 500,
        depth: int = 4, step: float = 0.05, subsample: float = 0.9, columns: float = 0.9, l2: float = 1.0,
        min_hessian: float = 1.0, bins: int = 64, seed: int = 42) -> Forest:
    """Logistic boosting of one tree a round for every model of ``weights`` (name -> weight column; default one of weight 1).

    Every round runs; ``subsample`` rows (per model and round) and ``columns`` features (per tree) are drawn
    by seed, ``l2`` is added to the hessian of a leaf, and a split needs ``min_hessian`` on both sides.
    """
    if not 2 <= bins <= 256:
        raise ValueError("bins must be between 2 and 256")
    spark = df.sparkSession
    weights = dict(weights or {"model": F.lit(1.0)})
    cols, n_models, n_cols, n_nodes = list(cols), len(weights), len(cols), 2 ** (depth + 1) - 1
    edges = _bin_edges(df, cols, bins)
    sizes = [len(e) + 1 for e in edges]
    n_bins, n_cells = max(sizes), sum(sizes)
    starts = np.cumsum([0, *sizes[:-1]])
    groups = _joint(sizes)
    spans = [math.prod(sizes[f] for f in g) for g in groups]
    cells = np.concatenate([f * n_bins + np.arange(n) for f, n in enumerate(sizes)])         # of those of n_bins a feature
    folder = scratch_path(spark, "boosting")
    _stored(df, cols, label, list(weights.values()), edges).write.parquet(folder)
    table = spark.read.schema(STORED).parquet(folder)
    n_rows = table.count()
    tasks = max(1, min(n_rows // MIN_TASK_ROWS, spark.sparkContext.defaultParallelism))
    mapped = n_rows // tasks * (n_cols + 2 * len(groups) + 16 + 26 * n_models) > HELD_BYTES
    feature = np.full((n_models, rounds, n_nodes), -1, np.int16)
    cut = np.zeros((n_models, rounds, n_nodes), np.int16)
    value = np.zeros((n_models, rounds, n_nodes))
    rng = np.random.default_rng(seed)
    kept_columns = max(1, round(columns * n_cols))
    allowed = np.array([[np.isin(np.arange(n_cols), rng.permutation(n_cols)[:kept_columns]) for _ in range(n_models)]
                        for _ in range(rounds)])

    def level_sums(chunks, level, wanted):
        """Histograms of a round's nodes at ``level`` over a task's rows: of the root, or of the ``wanted`` child of each node
        above (its sister's is the difference)."""
        width, most = max(1, 2 ** level // 2), 0.0
        out = np.zeros((n_models, width, n_cells, 2), np.int64)
        total = [np.zeros((n_models, width * span), np.complex128) for span in spans]

        def collect():
            for g, joint in zip(groups, total):
                left = joint
                for f in g:                                                # its own sums, and what is left for the features after it
                    left = left.reshape(n_models, width, sizes[f], -1)
                    own, left = left.sum(3), left.sum(2)
                    out[:, :, starts[f]:starts[f] + sizes[f]] += own.view(np.float64).reshape(*own.shape, 2).astype(np.int64)
                joint[:] = 0

        for chunk in chunks:
            if most + chunk.most >= 2.0 ** 53:
                collect()
                most = 0.0
            most += chunk.most
            for m in range(n_models):
                chunk.add_to(total, m, spans, level, None if wanted is None else wanted[m])
        collect()
        return np.ascontiguousarray(np.moveaxis(out, 3, 1))

    def split(t, level, sums, whole, wanted, trees):
        """Splits the nodes of round ``t`` at ``level`` in ``trees``: their histograms, and the children to count next (None if
        no node is split)."""
        feature, cut, value = trees
        if level:
            both = np.zeros((n_models, 2, 2 ** level, n_cells), np.int64)
            for m in range(n_models):
                for node in np.flatnonzero(wanted[m]):
                    both[m, :, node] = sums[m, :, node >> 1]
                    both[m, :, node ^ 1] = whole[m, :, node >> 1] - sums[m, :, node >> 1]
            sums = both
        dense = np.zeros((n_models, 2, 2 ** level, n_cols * n_bins))
        dense[..., cells] = sums / UNIT
        dense = dense.reshape(n_models, 2, 2 ** level, n_cols, n_bins)
        children = np.zeros((n_models, 2 ** (level + 1)), bool)
        for m in range(n_models):
            gain, f, b, gl, hl, g, h = best_splits(*dense[m], allowed[t, m], l2, min_hessian)
            if level == 0:
                value[m, t, 0] = -step * g[0] / (h[0] + l2) if h[0] + l2 > 0 else 0.0
            for i in np.flatnonzero(gain > 1e-6):
                node = 2 ** level - 1 + i
                feature[m, t, node], cut[m, t, node] = f[i], b[i]
                children[m, 2 * i + int(2 * hl[i] > h[i])] = True                            # the child of fewer rows
                for side, (sg, sh) in enumerate(((gl[i], hl[i]), (g[i] - gl[i], h[i] - hl[i]))):
                    value[m, t, 2 * node + 1 + side] = -step * sg / (sh + l2)
        return sums, children if children.any() else None

    def grow(first, last, folder):
        """A task's part in the rounds from ``first`` on; the first task returns their trees."""
        def run(batches):
            trees = feature.copy(), cut.copy(), value.copy()
            chunks = list(_chunks(batches, sizes, groups, n_models, depth, _Room(mapped)))
            meeting = _Meeting(folder, tasks)
            kept = 0
            for t in range(first, last):
                advance = t == first or t - kept >= ADVANCE_EVERY
                for chunk in chunks:
                    for m in range(n_models):
                        margin = chunk.margins[m]
                        if kept < t:
                            since = _margin(chunk.x, *[a[m, kept:t] for a in trees])
                            margin = np.add(margin, since, out=margin if advance else None)
                        chunk.draw(m, (seed * 1_000_003 + t) * 1_009 + m, subsample, margin)
                kept = t if advance else kept
                wanted, whole = None, [None]
                for level in range(depth):
                    def choose(sums, t=t, level=level, wanted=wanted, whole=whole):
                        whole[0], children = split(t, level, sums, whole[0], wanted, trees)
                        return children, [a[:, t] for a in trees]

                    wanted, grown = meeting.decide(level_sums(chunks, level, wanted), choose)
                    for a, new in zip(trees, grown):
                        a[:, t] = new
                    if wanted is None or level + 1 == depth:
                        break
                    for chunk in chunks:
                        for m in range(n_models):
                            _descend(chunk.at[m], chunk.x, trees[0][m, t], trees[1][m, t], level)
            if not meeting.task:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps([a[:, first:last] for a in trees])], pa.binary())], ["trees"])

        return run

    for first in range(0, rounds, RESTART_EVERY):
        last, meeting = min(rounds, first + RESTART_EVERY), scratch_path(spark, "boosting-sums")
        for row in table.repartition(tasks).mapInArrow(grow(first, last, meeting), "trees binary", barrier=True).collect():
            for a, new in zip((feature, cut, value), pickle.loads(row.trees)):
                a[:, first:last] = new
        store.remove(spark, meeting)
    top = [np.append(e, np.full(n_bins - len(e), np.inf)) for e in edges]
    threshold = np.where(feature >= 0, np.stack(top)[np.maximum(feature, 0), cut], 0.0)
    return Forest(list(weights), cols, feature.astype(np.int64), threshold, value)
