"""SimHash near-duplicates: 64-bit fingerprints linked at a small bit distance.

Fingerprints come from one Arrow UDF.  Equal fingerprints collapse to one class
before any search.  Classes are found by deletion variants: a fingerprint is cut
into ``distance // 2 + 1`` segments, so two fingerprints within the distance have
a segment that differs in at most one bit; every segment is indexed once for each
of its bits left out (a wildcard).  Rows of one variant meet by an equality shuffle
and are verified on all 64 bits.  Inside a variant, links are found by probing
sorted fingerprints with every admissible bit change, which is linear in the
variant's size, and only a spanning forest leaves the task, never all pairs.

Defined cases: a null text, or one without words, has fingerprint 0 and links like
any other; repeated rows link (distance 0); null ids take part in links but are no
component's id unless it has no other; an empty table gives an empty table; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import byte_slices, word_spans
from tidewatch.llm.components import connected, forest
from tidewatch.session import checkpointed

SHINGLE, DISTANCE, SEED = 3, 2, 42


def _fingerprints(texts: pa.Array, shingle: int, seed: int) -> pa.Array:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    digest, places = xxhash.xxh64_intdigest, np.arange(64, dtype=np.uint64)
    out = []
    for _, _, data, offs in byte_slices(texts):
        n = len(offs) - 1
        starts, ends, doc = word_spans(data, offs)
        # all words of the slice, one space after each
        lengths = ends - starts + 1
        to = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths, out=to[1:])
        source = np.repeat(starts - to[:-1], lengths) + np.arange(to[-1])
        joined = lower[data[np.minimum(source, max(len(data) - 1, 0))]] if len(data) else data
        joined[to[1:] - 1] = 32
        joined = joined.tobytes()
        # the first and last word of each shingle; a text of fewer words is one shingle
        counts = np.bincount(doc, minlength=n)
        first_word = np.cumsum(counts) - counts
        index = np.arange(len(starts))
        at = index[(index - first_word[doc] + shingle <= counts[doc])
                   | ((index == first_word[doc]) & (counts[doc] < shingle))]
        last = np.minimum(at + shingle, (first_word + counts)[doc[at]])
        h = np.fromiter((digest(joined[i:j], seed) for i, j in zip(to[at].tolist(), (to[last] - 1).tolist())),
                        np.uint64, len(at))
        # ones at each bit place, summed by text; bits are taken a byte at a time
        of = doc[at]
        total = np.bincount(of, minlength=n)
        prints = np.zeros(n, np.uint64)
        edges = np.searchsorted(of, np.arange(n))
        filled = total > 0
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        if filled.any():
            ones = np.add.reduceat(bits, edges[filled], axis=0, dtype=np.int64)
            majority = 2 * ones > total[filled, None]
            prints[filled] = (majority.astype(np.uint64) << places).sum(axis=1, dtype=np.uint64)
        out.append(prints)
    flat = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return pa.array(flat.view(np.int64), pa.int64())


def fingerprint(text, shingle: int = SHINGLE, seed: int = SEED):
    """Column: the 64-bit fingerprint of a text column, as a (signed) long."""

    def run(texts: pa.Array) -> pa.Array:
        return _fingerprints(texts, shingle, seed)

    return F.arrow_udf(run, "long")(F.col(text).cast("string") if isinstance(text, str) else text.cast("string"))


def variants(prints: DataFrame, distance: int = DISTANCE, column: str = "fp") -> DataFrame:
    """``(place, rest, fp)``: each segment of ``column`` with each one of its bits left out.

    ``place`` is the bit left out (which also names the segment), ``rest`` the segment
    without it.  A segment has ``64 / segments`` variants, a fingerprint 64.
    """
    cut = _segments(distance)
    segments = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"),
                                  F.lit(_signed(((1 << hi) - (1 << lo)))).alias("mask")) for lo, hi in cut])
    return (prints.select(F.col(column).alias("fp"), F.explode(segments).alias("s"))
            .select("fp", "s.mask", F.explode(F.sequence(F.col("s.lo"), F.col("s.hi") - 1)).alias("place"))
            .select("place", F.expr("fp & mask & ~shiftleft(1L, place)").alias("rest"), "fp"))


def _segments(distance: int) -> list[tuple[int, int]]:
    n = distance // 2 + 1
    return [(64 * i // n, 64 * (i + 1) // n) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _changes(lo: int, hi: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Xor masks of up to ``distance`` bits outside [lo, hi), and how many bits each has."""
    free = [b for b in range(64) if not lo <= b < hi]
    masks = [m for k in range(distance + 1) for m in itertools.combinations(free, k)]
    return (np.array([sum(1 << b for b in m) for m in masks], np.uint64),
            np.array([len(m) for m in masks]))


def _links(distance: int):
    """Task function over rows sorted by (place, rest): spanning edges inside each variant."""

    def solve(place: np.ndarray, rest: np.ndarray, fp: np.ndarray, masks: dict):
        """Edges among complete variants, all of them at once by a (variant, fingerprint) order."""
        heads = np.ones(len(fp), bool)
        heads[1:] = (place[1:] != place[:-1]) | (rest[1:] != rest[:-1])
        group = np.cumsum(heads) - 1
        sizes = np.bincount(group)
        alone = sizes[group] == 1
        place, fp, group = place[~alone], fp[~alone].view(np.uint64), group[~alone]
        found_a, found_b = [fp[:0]], [fp[:0]]
        # small variants: the k-th next row of the same variant, for every k
        sizes = sizes[group]
        small = sizes <= 64
        p, f, g = place[small], fp[small], group[small]
        k, at = 1, np.arange(len(f))
        while True:
            at = at[at + k < len(f)]
            at = at[g[at + k] == g[at]] if len(at) else at
            if not len(at):
                break
            near = np.bitwise_count(f[at] ^ f[at + k]) <= distance
            found_a.append(f[at[near]])
            found_b.append(f[at[near] + k])
            k += 1
        # large variants: probe the sorted fingerprints with every change that stays within the distance
        large = np.flatnonzero(~small)
        for run in np.split(large, np.flatnonzero(np.diff(group[large])) + 1) if len(large) else []:
            f = np.sort(fp[run])
            bit = np.uint64(1) << np.uint64(place[run[0]])
            lo, hi = next(s for s in _segments(distance) if s[0] <= place[run[0]] < s[1])
            if (lo, hi) not in masks:
                masks[lo, hi] = _changes(lo, hi, distance)
            edges = 0
            for mask, n in zip(*masks[lo, hi]):
                for flip in ([bit] if n == 0 else [np.uint64(0), bit] if n < distance else [np.uint64(0)]):
                    other = f ^ mask ^ flip
                    hit = np.minimum(np.searchsorted(f, other), len(f) - 1)
                    hit_at = np.flatnonzero((f[hit] == other) & (f < other))
                    found_a.append(f[hit_at])
                    found_b.append(other[hit_at])
                    edges += len(hit_at)
                if edges > 4 * len(f):                     # keep spanning edges only: memory follows the rows, not their links
                    a, b = forest(np.concatenate(found_a).view(np.int64), np.concatenate(found_b).view(np.int64))
                    found_a, found_b, edges = [a.view(np.uint64)], [b.view(np.uint64)], 0
        a, b = np.concatenate(found_a).view(np.int64), np.concatenate(found_b).view(np.int64)
        return forest(a, b)

    def run(batches):
        masks: dict = {}
        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held:
                last = held[-1]
                same = (cols[0] == last[0][-1]) & (cols[1] == last[1][-1])
                stop = int(np.argmin(same)) if not same.all() else len(same)
                held.append([c[:stop] for c in cols])
                if stop == len(same):
                    continue
                yield solve_all(held, masks)
                cols = [c[stop:] for c in cols]
            # keep the last variant open: the next batch may go on with it
            ends = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut:
                yield solve_all([[c[:cut] for c in cols]], masks)
            held = [[c[cut:].copy() for c in cols]]
        if held:
            yield solve_all(held, masks)

    def solve_all(parts, masks):
        a, b = solve(*[np.concatenate([p[i] for p in parts]) for i in range(3)], masks)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def links(prints: DataFrame, distance: int = DISTANCE, column: str = "fp") -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints within ``distance``, given distinct ones."""
    found = variants(prints, distance, column).repartition("place", "rest").sortWithinPartitions("place", "rest")
    return found.mapInArrow(_links(distance), "a long, b long")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``fp``, ``component_id``, ``component`` and ``content``.

    ``component_id`` is the smallest id among the rows reachable by links, ``component`` the
    smallest fingerprint there (as a long), ``content`` a 64-bit hash of the text.
    """
    rows = checkpointed(docs.select(F.col(id).alias("id"), fingerprint(text, shingle, seed).alias("fp"),
                                    F.xxhash64(F.col(text).cast("string")).alias("content")))
    classes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    classes = checkpointed(classes)
    roots = connected(links(classes, distance)).withColumnRenamed("node", "fp")
    labelled = classes.join(roots, "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    best = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labelled.join(best, "root").select("fp", "component_id", F.col("root").alias("component"))
    return rows.join(named, "fp").select(F.col("id").alias(id), "fp", "component_id", "component", "content")


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, then the smallest text hash.

    Rows that repeat that id and text count as one; the columns stay as they are.
    """
    found = near_duplicates(docs, id, text, shingle, distance)
    first = found.groupBy("component").agg(
        F.min(F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), "content")).alias("k"))
    first = first.select(F.col("k.id").alias("_first_id"), F.col("k.content").alias("_first_content"))
    marked = docs.withColumn("_row_content", F.xxhash64(F.col(text).cast("string")))
    kept = marked.join(first, F.col(id).eqNullSafe(F.col("_first_id"))
                       & (F.col("_row_content") == F.col("_first_content")), "left_semi")
    return kept.dropDuplicates([id, "_row_content"]).select(*[F.col(f"`{c}`") for c in docs.columns])
