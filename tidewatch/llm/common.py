"""Byte-level helpers shared by the operators that run numpy inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words everywhere in this package: runs of anything but space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts of one Arrow batch are worked on in slices of about this many bytes, which
#: bounds the numpy temporaries (about 60 bytes a text byte); a longer text is one slice.
SLICE_BYTES = 1 << 20

#: A table of at most so many rows may be broadcast (rows of keys and numbers, under 200 bytes).
SMALL_ROWS = 20_000

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_ODD = 0x9E3779B97F4A7C15          # odd multiplier of the rolling hashes


def small(df: DataFrame) -> DataFrame:
    """``df`` (stored) marked for broadcast if its row count allows, else as it is."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def byte_slices(texts, limit: int = SLICE_BYTES):
    """``(first row, end row, bytes, offsets)`` over an Arrow string array; null is empty."""
    texts = pa.array(texts) if not isinstance(texts, pa.Array) else texts
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    n = len(texts)
    if n == 0:
        return
    texts = texts.fill_null("") if texts.null_count else texts
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bufs = texts.buffers()
    offs = np.frombuffer(bufs[1], kind, n + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """Start and end byte of every word of every text, and the index of its text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SEPARATOR[data]
    begins = inside[1:-1] & ~inside[:-2]
    cuts = offsets[:-1][(offsets[:-1] < len(data))]
    begins[cuts] = inside[1:-1][cuts]                      # a text ends the word of the one before
    starts = np.flatnonzero(begins)
    stops = inside[1:-1] & ~inside[2:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    stops[lasts] = inside[1:-1][lasts]
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def piece_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Dense ids of non-empty pieces, in order and apart or side by side: equal ids exactly where the bytes are equal."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    marks = np.zeros(len(data) + 1, np.int8)
    marks[starts] += 1
    marks[ends] -= 1                                       # a piece may begin where the one before it ends
    inside = np.cumsum(marks[:-1], dtype=np.int8).astype(bool)
    small = offsets[-1] < 1 << 31
    kind, offs = (pa.binary(), offsets.astype(np.int32)) if small else (pa.large_binary(), offsets)
    pieces = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(offs), pa.py_buffer(data[inside])])
    return pieces.dictionary_encode().indices.to_numpy().astype(np.int32)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, np.uint64(base)
    with np.errstate(over="ignore"):
        while done < n:
            take = min(done, n - done)
            out[done:done + take] = out[:take] * step
            done += take
            step = step * step
    return out[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any range of a sequence of 64-bit values from one running sum.

    ``sum(v[i] * b**i)`` over a range, times the inverse power of its start, depends
    on the range's content only; all arithmetic is modulo 2**64.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        with np.errstate(over="ignore"):
            self.back = powers(pow(_ODD, -1, 1 << 64), n + 1)
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values * powers(_ODD, n), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.sums[ends] - self.sums[starts]) * self.back[starts]
            return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether it occurred earlier."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    twice, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later
