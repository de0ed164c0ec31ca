"""Periodic runs of words by recompression, and texts with each run collapsed to one period.

A run is a maximal stretch of words with smallest period ``q`` (words ``q`` apart are equal)
that is at least ``exponent`` periods and ``min_length`` words long.

1. Words become exact ids.  For every period a grid is laid over the text, so wide that a
   run of that period must hold ``PROBE`` equal words in a row, at a grid place and one period on;
   places where those words are equal are candidates (harmonic sum: about n log n places in all).
2. The texts that have candidates are compressed by turns: blocks of one symbol become one symbol,
   then pairs whose sides a random bit a symbol tells apart.  Equal stretches are cut alike but
   at their ends, which makes the levels a run-length grammar for extension queries.
3. A query (longest common extension of two places, forwards or backwards) climbs the levels
   while both places begin equal symbols, jumps whole blocks, and descends where they differ: a
   bounded number of steps a level.  Each candidate's two extensions give its run exactly.
   A run found with several multiples of its period keeps the smallest.

The work is one Arrow UDF: no shuffle, and memory in proportion to one slice of texts
(``common.SLICE_BYTES``) or to one longer text.  A longer text's candidates come in chunks.

Defined cases: a null or empty text has no runs and collapses to the empty text; equal rows
get equal results; other columns, whatever their names, are untouched; an empty table gives an
empty table; texts of any length are worked on whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import byte_slices, piece_ids, word_spans

MIN_LENGTH, EXPONENT = 24, 3
#: Equal words in a row that make a grid place a candidate; below the shortest possible match.
PROBE = 4
#: Grid places looked at together.
CHUNK = 1 << 19
#: Words joined together when the collapsed texts are written.
JOIN_WORDS = 1 << 17

RESULT = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _codes(keys: np.ndarray) -> tuple[np.ndarray, int]:
    found = pa.array(keys).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), len(found.dictionary)


class Grammar:
    """Levels of block and pair compression over texts of symbols, for one direction or the other.

    ``texts`` are laid end to end with a symbol of its own before, between and after them, so
    no extension leaves its text.  ``at(text, word)`` is a word's place.
    """

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, seed: int = 1):
        n, texts = len(symbols), len(sizes)
        self.base = np.zeros(texts + 1, np.int64)
        np.cumsum(sizes + 1, out=self.base[1:])
        place = np.ones(n + texts + 1, bool)
        place[self.base] = False
        t = np.empty(n + texts + 1, np.int32)
        known = int(symbols.max(initial=-1)) + 1
        t[place] = symbols
        fences = np.arange(known, known + texts + 1, dtype=np.int32)
        t[self.base] = fences
        rng = np.random.default_rng(seed)
        first_fence, known = known, known + texts + 1
        self.levels, ups, runs = [t], [], []
        while len(t) > 4 * texts + 16 and len(ups) < 1000:
            heads = np.ones(len(t), bool)
            heads[1:] = t[1:] != t[:-1]
            if not heads.all():                            # blocks
                begin = np.flatnonzero(heads)
                count = np.diff(begin, append=len(t))
                up = (np.cumsum(heads) - 1).astype(np.int32)
                new = t[begin].copy()
                many = np.flatnonzero(count > 1)
                codes, more = _codes(new[many].astype(np.int64) << 32 | count[many])
                new[many] = known + codes
                known += more
                ups.append(up)
                runs.append((begin.astype(np.int32), count.astype(np.int32)))
                t = new
                self.levels.append(t)
            side = rng.integers(0, 2, known, np.int8)
            side[first_fence:first_fence + texts + 1] = 2
            s = side[t]
            one, two = ((s[:-1] == a) & (s[1:] == 1 - a) for a in (0, 1))
            pair = np.flatnonzero(one if np.count_nonzero(one) >= np.count_nonzero(two) else two)
            if not len(pair):
                continue
            heads = np.ones(len(t), bool)
            heads[pair + 1] = False
            up = (np.cumsum(heads) - 1).astype(np.int32)
            codes, more = _codes(t[pair].astype(np.int64) << 32 | t[pair + 1])
            new = t[heads]
            new[up[pair]] = known + codes
            known += more
            ups.append(up)
            runs.append(None)
            t = new
            self.levels.append(t)
        self.size = n + texts + 1
        self.forward = self._view(ups, runs, False)
        self.backward = self._view(ups, runs, True)

    def _view(self, ups: list, runs: list, back: bool) -> list:
        """Per level: symbols, place one level up, whether the symbol above begins here, equal symbols from here on, first place below."""
        view = []
        for k, sym in enumerate(self.levels):
            if k == len(ups):
                view.append((sym[::-1] if back else sym, None, None, None, None))
                break
            up, rest = ups[k], None
            if runs[k] is not None:
                begin, count = runs[k]
                inner = np.arange(len(sym), dtype=np.int32) - begin[up]
                rest = (inner + 1)[::-1] if back else count[up] - inner
            if back:
                sym, up = sym[::-1], (len(self.levels[k + 1]) - 1 - up)[::-1]
            first = np.ones(len(sym), bool)
            first[1:] = up[1:] != up[:-1]
            view.append((sym, up, first, rest, np.flatnonzero(first).astype(np.int32)))
        return view

    def at(self, text: np.ndarray, word: np.ndarray) -> np.ndarray:
        return self.base[text] + 1 + word

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols from two different places on."""
        return _extension(self.forward, i, j)

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols up to, and without, two different places."""
        return _extension(self.backward, self.size - i, self.size - j)


def _extension(view: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    begin = i
    query = np.arange(len(i))
    waiting = []                                           # by level: queries whose symbols differ there
    for k, (sym, up, first, rest, _) in enumerate(view):
        differ, climb = [], []
        while len(query):
            same = sym[i] == sym[j]
            if not same.all():
                off = ~same
                differ.append((query[off], i[off], j[off]))
                query, i, j = query[same], i[same], j[same]
            step = 1
            if up is not None:
                above_i, above_j = up[i], up[j]
                over = first[i] & first[j] & (view[k + 1][0][above_i] == view[k + 1][0][above_j])
                if over.any():
                    climb.append((query[over], above_i[over], above_j[over]))
                    query, i, j = query[~over], i[~over], j[~over]
                if rest is not None:
                    step = np.minimum(rest[i], rest[j])
            i, j = i + step, j + step
        waiting.append(differ)
        if not climb:
            break
        query, i, j = (np.concatenate(c) for c in zip(*climb))
    out = np.zeros(len(begin), np.int64)
    query, i, j = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for k in range(len(waiting) - 1, -1, -1):
        sym, rest = view[k][0], view[k][3]
        # those from above are at the first places of differing symbols: equal here for one step at most
        same = sym[i] == sym[j]
        step = same if rest is None else np.where(same, np.minimum(rest[i], rest[j]), 0)
        i, j = i + step, j + step
        parts = [(query, i, j), *waiting[k]]
        query, i, j = (np.concatenate(c) for c in zip(*parts))
        if k:
            down = view[k - 1][4]
            i, j = down[i].astype(np.int64), down[j].astype(np.int64)
    out[query] = i - begin[query]
    return out


def _candidates(ids: np.ndarray, base: np.ndarray, sizes: np.ndarray, min_length: int, exponent: int):
    """Chunks ``(text, word, period)`` of grid places whose next ``PROBE`` words are equal one period on."""
    most = np.where(sizes >= min_length, sizes // exponent, 0)
    first = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(most, out=first[1:])
    done = 0
    while done < first[-1]:
        # (text, period) rows, as many as a chunk of places may hold
        row = np.arange(done, min(done + CHUNK, first[-1]))
        text = np.searchsorted(first, row, "right") - 1
        q = row - first[text] + 1
        step = np.maximum((exponent - 1) * q, min_length - q) - (PROBE - 1)
        places = np.maximum((sizes[text] - q - PROBE) // step + 1, 0)
        total = np.cumsum(places)
        take = max(1, int(np.searchsorted(total, CHUNK, "right")))
        text, q, step, places, total = text[:take], q[:take], step[:take], places[:take], total[:take]
        done += take
        for a in range(0, int(total[-1]), CHUNK):          # one period alone may have more places
            if total[-1] <= CHUNK:
                of = np.repeat(np.arange(take), places)
                at = np.arange(total[-1])
            else:
                at = np.arange(a, min(a + CHUNK, int(total[-1])))
                of = np.searchsorted(total, at, "right")
            word = (at - (total - places)[of]) * step[of]
            place, q_of = base[text[of]] + word, q[of]
            for c in range(PROBE):
                hit = np.flatnonzero(ids[place + c] == ids[place + c + q_of])
                place, q_of, of, word = place[hit], q_of[hit], of[hit], word[hit]
            if len(of):
                yield text[of], word, q_of


def find_runs(ids: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT):
    """``(text, start, length, period)`` arrays of all runs, ordered, of texts laid end to end as symbol ids."""
    if exponent < 2 or min_length <= 2 * PROBE:
        raise ValueError(f"runs need an exponent of 2 or more and a length above {2 * PROBE}")
    base = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=base[1:])
    none = np.zeros(0, np.int64)
    texts = np.zeros(len(sizes), bool)
    for text, _, _ in _candidates(ids, base, sizes, min_length, exponent):
        texts[text] = True
    chosen = np.flatnonzero(texts)
    if not len(chosen):
        return none, none, none, none
    ids = ids[np.repeat(texts, sizes)]
    sizes = sizes[chosen]
    base = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=base[1:])
    grammar = Grammar(ids, sizes)
    found = np.zeros((4, 0), np.int64)
    for text, word, q in _candidates(ids, base, sizes, min_length, exponent):
        i = grammar.at(text, word)
        ahead, behind = grammar.ahead(i, i + q), grammar.behind(i, i + q)
        length = ahead + behind + q
        keep = length >= np.maximum(min_length, exponent * q)
        found = _smallest(np.concatenate([found, np.stack([text, word - behind, length, q])[:, keep]], 1))
    order = np.lexsort((found[3], found[1], found[0]))
    return chosen[found[0]][order], *found[1:, order]


def _smallest(found: np.ndarray) -> np.ndarray:
    """One column a stretch: the one with its smallest period."""
    found = found[:, np.lexsort(found[::-1])]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[:3, 1:] != found[:3, :-1]).any(0)
    return found[:, new]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text offsets of the words of each text with one space between them."""
    size = ends - starts
    if len(doc):
        size[:-1] += doc[1:] == doc[:-1]                   # the space after a word that is not its text's last
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(doc, size, n).astype(np.int64), out=offsets[1:])
    out = np.empty(int(offsets[-1]), np.uint8)
    done = 0
    for a in range(0, len(starts), JOIN_WORDS):
        s, e, m = (x[a:a + JOIN_WORDS] for x in (starts, ends, size))
        to = np.cumsum(m)
        total = int(to[-1])
        index = np.arange(total) + np.repeat(s - (to - m), m)
        piece = data[np.minimum(index, len(data) - 1)]
        piece[(to - 1)[m > e - s]] = 0x20
        out[done:done + total] = piece
        done += total
    return out, offsets


def analysed(texts: pa.Array, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> pa.Array:
    """Struct array of ``RESULT`` for an Arrow string array."""
    rows, starts_, lengths_, periods_, blobs, cuts, done = [], [], [], [], [], [np.zeros(1, np.int64)], 0
    for _, _, data, offs in byte_slices(texts):
        n = len(offs) - 1
        starts, ends, doc = word_spans(data, offs)
        sizes = np.bincount(doc, minlength=n)
        text, start, length, period = find_runs(piece_ids(data, starts, ends), sizes, min_length, exponent)
        rows.append(np.bincount(text, minlength=n))
        starts_.append(start)
        lengths_.append(length)
        periods_.append(period)
        if len(text):
            first = np.zeros(n, np.int64)
            np.cumsum(sizes[:-1], out=first[1:])
            drop = np.zeros(len(starts) + 1, np.int64)
            np.add.at(drop, first[text] + start + period, 1)
            np.subtract.at(drop, first[text] + start + length, 1)
            kept = np.cumsum(drop[:-1]) == 0
            starts, ends, doc = starts[kept], ends[kept], doc[kept]
        blob, offsets = _joined(data, starts, ends, doc, n)
        blobs.append(blob)
        cuts.append(offsets[1:] + done)
        done += len(blob)
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts_, lengths_, periods_)]
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in flat], ["start", "length", "period"])
    ends = np.zeros(sum(map(len, rows)) + 1, np.int64)
    if rows:
        np.cumsum(np.concatenate(rows), out=ends[1:])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)
    kind, width = (pa.string(), np.int32) if done < 1 << 31 else (pa.large_string(), np.int64)
    offsets = np.concatenate(cuts).astype(width)
    data = np.concatenate(blobs) if blobs else np.zeros(0, np.uint8)
    collapsed = pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pa.StructArray.from_arrays([lists, collapsed], ["runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text", into: str = "periodic", min_length: int = MIN_LENGTH,
                  exponent: int = EXPONENT) -> DataFrame:
    """``docs`` with one struct column ``into``: the text's ``runs`` and its ``collapsed`` form.

    ``runs`` are ordered by start, then period, in words from 0.  ``collapsed`` drops each word
    that some run holds after that run's first period, and joins the others by one space.  A
    column named ``into`` is replaced.
    """

    def run(texts: pa.Array) -> pa.Array:
        return analysed(texts, min_length, exponent)

    return docs.withColumn(into, F.arrow_udf(run, RESULT)(F.col(f"`{text}`").cast("string")))
