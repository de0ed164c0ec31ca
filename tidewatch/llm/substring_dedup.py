"""Exact removal of repeated byte strings, by longest-previous-factor arrays.

Every byte inside a ``length``-byte string that also starts earlier (in a document of
smaller id, or earlier in the same one) is removed; strings are judged on the input.

A suffix array of a whole corpus is one task, so the corpus is first cut where repeats
show.  Each window of ``length`` bytes has an anchor: its ``gram``-byte string of least
hash.  Equal windows have equal anchors.  The windows that share one anchor's place are a
segment, about one for 33 bytes, known by the anchor's hash (key) and its bytes' hash.

1. One pass over the texts gives segments.  An equal segment earlier settles all its
   windows: they are repeats.  This is done first inside every Arrow batch, so what a
   third of all documents share leaves a task once, then by key over the cluster.
2. Keys left with two or more different segments (about one segment in twenty) may hide
   repeats of parts of them.  Their bytes meet by key; a key with very many segments is
   dealt finer, by the bytes common to the windows that begin a few places apart before the
   anchor, down to one window.
3. There a suffix array is sorted by prefix doubling, the previous and next smaller
   positions in suffix order give each window's longest previous factor, and a factor
   of ``length`` marks a repeat.
4. Marks meet their documents, and the bytes they cover go.

Steps 2 and 4 read one shuffle of the texts.  The marks of step 1 are written to the
shared folder.  Hash equality (two of 64 bits) stands for byte equality in step 1 only.
A document is its id and its version, 127 bits of hashes of the text in two columns, so rows
that share an id (all null ids do) stay apart.

Defined cases: a null text is empty; matches never cross documents; rows that repeat an
id and a text are one document and get equal results; rows that share an id only are
documents ordered by a hash of their texts; a null id is smaller than any; other columns
are not read, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import Rolling, byte_slices, mixed, small
from tidewatch.session import checkpointed, scratch_path

LENGTH = 100
#: Segments of one key that are compared in one piece; keys with more are dealt finer.
KEY_SEGMENTS = 1000
#: Bytes of segments in one suffix array.
ARRAY_BYTES = 1 << 20

_SIZE_BITS, _PLACE_BITS = 7, 21
_SMALLEST = -(1 << 63)


def _gram(length: int) -> int:
    return max(length // 3 - 1, length - (1 << _SIZE_BITS) + 1, 1)


def _segments(data: np.ndarray, offs: np.ndarray, length: int):
    """Segments of a slice of texts: key, hash, text, first window, number of windows, place of the
    anchor after the first window.

    A window's anchor is its gram of least hash, the leftmost of equal ones, so it depends on
    the window's bytes only and two equal windows never share an anchor's place.
    """
    gram = _gram(length)
    many = length - gram + 1                               # grams in a window
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 6
    text = Rolling(data.astype(np.uint64) + np.uint64(1))
    with np.errstate(over="ignore"):
        h = mixed((text.sums[gram:] - text.sums[:-gram]) * text.back[:len(data) - gram + 1])
    # the low bits hold the place, in stretches that overlap by a window
    low = (1 << _PLACE_BITS) - 1
    anchors = []
    for at in range(0, len(data) - length + 1, low - many):
        part = h[at:at + low]
        least = (part & ~np.uint64(low)) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while 2 * size <= many:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < many:
            least = np.minimum(least[:len(least) - (many - size)], least[many - size:])
        anchors.append((least & np.uint64(low)).astype(np.int64)[:low - many] + at)
    anchor = np.concatenate(anchors)[:len(data) - length + 1]
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:len(anchor)]
    inside = np.arange(len(anchor)) + length <= offs[doc + 1]
    cut = np.ones(len(anchor) + 1, bool)
    cut[1:-1] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | ~inside[1:] | ~inside[:-1]
    cuts = np.flatnonzero(cut)
    first, end = cuts[:-1], cuts[1:]
    real = inside[first]
    first, end = first[real], end[real]
    of = doc[first]
    return (h[anchor[first]].view(np.int64), text.of(first, end - 1 + length).view(np.int64),
            of, first - offs[of], end - first, anchor[first] - first)


def _firsts(key, content, doc, version, second, pos):
    """Of rows equal in key and content: (first ones, later ones), without rows equal in all."""
    order = np.lexsort((pos, second, version, doc, content, key))
    k, c, d, v, w, p = (x[order] for x in (key, content, doc, version, second, pos))
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0)) if len(k) else new.astype(np.int64)
    later = ~new & ((d != d[head]) | (v != v[head]) | (w != w[head]) | (p != p[head]))
    return order[new], order[later]


def _pack(start, size):
    return (start << _SIZE_BITS) | size


def _unpack(pos):
    return pos >> _SIZE_BITS, pos & ((1 << _SIZE_BITS) - 1)


def _merged(doc, version, second, start, size):
    """Touching or overlapping byte ranges of a document as one."""
    order = np.lexsort((start, second, version, doc))
    d, v, w, s = doc[order], version[order], second[order], start[order]
    e = s + size[order]
    if not len(d):
        return d, v, w, s, e
    same = (d[1:] == d[:-1]) & (v[1:] == v[:-1]) & (w[1:] == w[:-1])
    group = np.concatenate([[0], np.cumsum(~same)])
    # the farthest end so far in the document: ends lifted above those of documents before
    lift = group * (int(e.max()) + 1)
    reach = np.maximum.accumulate(e + lift) - lift
    new = np.ones(len(d), bool)
    new[1:] = ~same | (s[1:] > reach[:-1])
    heads = np.flatnonzero(new)
    return d[heads], v[heads], w[heads], s[heads], np.maximum.reduceat(reach, heads) - s[heads]


def _batch(arrays: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) if not isinstance(a, pa.Array) else a for a in arrays.values()], list(arrays))


def _nullable(values: np.ndarray, n_null: int, kind=pa.int64()) -> pa.Array:
    """``values`` after ``n_null`` nulls."""
    return pa.concat_arrays([pa.nulls(n_null, kind), pa.array(values, kind)])


#: ``size`` is a range's bytes, or a segment's anchor place.
SEGMENT = "key long, content long, doc long, version long, second long, pos long, size long"


def _cut(length: int):
    """Step 1, in a task: (doc, version, second, text) -> new segments, and byte ranges (null content) already known to repeat."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            versions, seconds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            parts = []
            for i, _, data, offs in byte_slices(batch.column(3)):
                key, content, of, start, n, anchor = _segments(data, offs, length)
                parts.append((key, content, docs[of + i], versions[of + i], seconds[of + i], _pack(start, n), anchor))
            key, content, doc, version, second, pos, anchor = (np.concatenate(c) for c in zip(*parts))
            first, later = _firsts(key, content, doc, version, second, pos)
            start, n = _unpack(pos[later])
            d, v, w, s, size = _merged(doc[later], version[later], second[later], start, n - 1 + length)
            yield _batch({
                "key": np.concatenate([s + size, key[first]]), "content": _nullable(content[first], len(d)),
                "doc": np.concatenate([d, doc[first]]), "version": np.concatenate([v, version[first]]),
                "second": np.concatenate([w, second[first]]), "pos": np.concatenate([_pack(s, 0), pos[first]]),
                "size": np.concatenate([size, anchor[first]])})

    return run


MARK = "doc long, version long, second long, start long, size long, anchor long, key long"


def _settle(length: int):
    """Step 1, over the cluster: rows sorted by key, content, doc, version, second, pos -> byte ranges (null key) and open segments."""
    def run(batches):
        held = None                                        # the last first row, and whether it has been given out
        for batch in batches:
            if not batch.num_rows:
                continue
            content = batch.column(1)
            known = content.is_null().to_numpy(zero_copy_only=False)
            key, doc, version, second, pos, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4, 5, 6))
            content = content.fill_null(0).to_numpy(zero_copy_only=False)
            ranges = [(doc[known], version[known], second[known], _unpack(pos[known])[0], size[known])]
            k, c, d, v, w, p, far = (x[~known] for x in (key, content, doc, version, second, pos, size))
            opened = np.zeros(0, np.int64)
            if len(k):
                given = False
                if held:
                    k, c, d, v, w, p, far = (np.concatenate([[h], x]) for h, x in zip(held, (k, c, d, v, w, p, far)))
                    given = held[7]
                new = np.ones(len(k), bool)
                new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
                head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
                later = ~new & ((d != d[head]) | (v != v[head]) | (w != w[head]) | (p != p[head]))
                s, n = _unpack(p[later])
                ranges.append((d[later], v[later], w[later], s, n - 1 + length))
                first = np.flatnonzero(new)
                same = k[first][1:] == k[first][:-1]
                shared = np.zeros(len(first), bool)
                shared[1:] |= same
                shared[:-1] |= same
                last_given = bool(shared[-1]) or (given and len(first) == 1)
                at = first[-1]
                held = (k[at], c[at], d[at], v[at], w[at], p[at], far[at], last_given)
                if given:
                    shared[0] = False
                opened = first[shared]
                s, n = _unpack(p[opened])
                open_rows = (d[opened], v[opened], w[opened], s, n, far[opened], k[opened])
            else:
                open_rows = tuple(np.zeros(0, np.int64) for _ in range(7))
            r = _merged(*[np.concatenate(x) for x in zip(*ranges)])
            r = (*r, np.zeros(len(r[0]), np.int64))
            yield _batch({name: np.concatenate([a, b]) for name, a, b in zip(("doc", "version", "second", "start", "size", "anchor"), r, open_rows)}
                         | {"key": _nullable(open_rows[6], len(r[0]))})

    return run


PIECE = "route long, content long, doc long, version long, second long, start long, size long, bytes binary"


def _deal(length: int):
    """Step 2: (doc, version, second, text, open segments) -> runs of windows with their bytes, equal ones once a batch."""
    def run(batches):
        for batch in batches:
            lists = batch.column(4)
            if not batch.num_rows:
                continue
            ends = np.asarray(lists.offsets, np.int64)
            flat = lists.values.slice(ends[0], ends[-1] - ends[0])
            ends = ends - ends[0]
            fields = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(4)]
            docs, versions, seconds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
            for i, j, data, offs in byte_slices(batch.column(3)):
                lo, hi = ends[i], ends[j]
                row = np.repeat(np.arange(j - i), np.diff(ends[i:j + 1]))
                start, windows, anchor, most = (f[lo:hi] for f in fields)
                # a run's windows begin from ``most * c`` to ``most * (c + 1) - 1`` bytes before the anchor
                far, near = anchor // most, (anchor - windows + 1) // most
                parts = far - near + 1
                of = np.repeat(np.arange(len(start)), parts)
                inner = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
                c, place = far[of] - inner, (start + anchor)[of]
                begin = np.maximum(start[of], place - (c + 1) * most[of] + 1)
                n = np.minimum((start + windows)[of], place - c * most[of] + 1) - begin
                row = row[of]
                at, place = begin + offs[row], place + offs[row]
                text = Rolling(data.astype(np.uint64) + np.uint64(1))
                route = text.of(place - c * most[of], place - (c + 1) * most[of] + 1 + length).view(np.int64)
                content = text.of(at, at + n - 1 + length).view(np.int64)
                doc, version, second = docs[row + i], versions[row + i], seconds[row + i]
                first, later = _firsts(route, content, doc, version, second, _pack(begin, n))
                d, v, w, s, size = _merged(doc[later], version[later], second[later], begin[later], n[later] - 1 + length)
                sizes = n[first] - 1 + length
                to = np.concatenate([[0], np.cumsum(sizes)])
                raw = data[np.repeat(at[first] - to[:-1], sizes) + np.arange(to[-1])]
                blobs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(raw)])
                yield _batch({
                    "route": np.concatenate([s + size, route[first]]), "content": _nullable(content[first], len(d)),
                    "doc": np.concatenate([d, doc[first]]), "version": np.concatenate([v, version[first]]),
                    "second": np.concatenate([w, second[first]]),
                    "start": np.concatenate([s, begin[first]]), "size": np.concatenate([size, sizes]),
                    "bytes": pa.concat_arrays([pa.nulls(len(d), pa.binary()), blobs])})

    return run


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int):
    """Suffixes at ``starts`` in order of their first ``depth`` bytes, by prefix doubling.

    Returns their order, and a function that gives the longest common prefix (up to
    ``depth``) of pairs of them.  ``data`` must hold ``depth`` bytes after every start.
    """
    word = np.zeros(len(data), np.uint64)                  # eight bytes from every place
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for b in range(8):
        word = (word << np.uint64(8)) | padded[b:b + len(data)]
    ranks, span, rank = [], 8, word
    while 2 * span <= depth:
        rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
        ranks.append((span, rank))
        far = np.concatenate([rank[span:], np.zeros(min(span, len(rank)), np.uint64)])[:len(rank)]
        rank, span = (rank << np.uint64(32)) | far, 2 * span
    rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
    ranks.append((span, rank))
    if span < depth:                                       # the two overlapping halves of the rest
        whole = (rank[starts] << np.uint64(32)) | rank[starts + depth - span]
    else:
        whole = rank[starts]

    def common(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b, total = starts[i], starts[j], np.zeros(len(i), np.int64)
        for span, rank in [*ranks[::-1], *[(span, rank) for span, rank in ranks[-1:]]]:
            equal = (total + span <= depth) & (rank[np.minimum(a + total, len(rank) - 1)] == rank[np.minimum(b + total, len(rank) - 1)])
            total += np.where(equal, span, 0)
        # what is left is shorter than the shortest ranked prefix or passes the depth: byte by byte
        live = np.flatnonzero(total < depth)
        for _ in range(depth):
            live = live[(total[live] < depth)]
            if not len(live):
                break
            live = live[data[a[live] + total[live]] == data[b[live] + total[live]]]
            total[live] += 1
        return total

    return np.argsort(whole, kind="stable"), common


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place, the nearest one before it with a smaller value, or -1; by jumping pointers."""
    at = np.arange(-1, len(values) - 1)
    live = np.arange(len(values))
    while True:
        live = live[at[live] >= 0]
        live = live[values[at[live]] > values[live]]
        if not len(live):
            return at
        at[live] = at[at[live]]


def longest_previous_factors(data: np.ndarray, starts: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
    """For the suffix at each start, the longest prefix (up to ``depth``) that a suffix of smaller ``place`` has.

    ``place`` is the order of occurrence; among all earlier suffixes the longest match is
    the nearest in suffix order on either side.
    """
    order, common = suffix_order(data, starts, depth)
    seen = place[order]
    factors = np.zeros(len(starts), np.int64)
    before = nearest_smaller(seen)
    after = len(seen) - 1 - nearest_smaller(seen[::-1])[::-1]
    for near, ok in ((before, before >= 0), (after, after < len(seen))):
        who = np.flatnonzero(ok)
        factors[order[who]] = np.maximum(factors[order[who]], common(order[who], order[near[who]]))
    return factors


RANGE = "doc long, version long, second long, start long, size long"


def _compare(length: int, array_bytes: int):
    """Step 3: rows sorted by route, content, doc, version, second, start -> byte ranges that repeat."""
    def solve(rows):
        doc, version, second, start, size, blobs = (np.concatenate([r[i] for r in rows]) for i in range(6))
        data = np.frombuffer(b"".join(blobs), np.uint8)
        ends = np.cumsum(size)
        windows = size - length + 1
        of = np.repeat(np.arange(len(size)), windows)
        inner = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        d, v, w, s = doc[of], version[of], second[of], start[of] + inner
        place = np.empty(len(of), np.int64)
        place[np.lexsort((s, w, v, d))] = np.arange(len(of))
        repeat = longest_previous_factors(data, (ends - size)[of] + inner, place, length) >= length
        return d[repeat], v[repeat], w[repeat], s[repeat], np.full(int(repeat.sum()), length)

    def run(batches):
        held, held_bytes, last = [], 0, None               # rows of distinct contents whose routes may go on
        route_open = None
        for batch in batches:
            if not batch.num_rows:
                continue
            known = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4, 5, 6)]
            content = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
            ranges = [tuple(c[known] for c in cols[1:])]
            route, doc, version, second, start, size = (c[~known] for c in cols)
            content = content[~known]
            blobs = np.array(batch.column(7).filter(pa.array(~known)).to_pylist(), object)
            if len(route):
                # equal contents follow each other: only the first takes part, later ones repeat it
                new = np.ones(len(route), bool)
                new[1:] = (route[1:] != route[:-1]) | (content[1:] != content[:-1])
                if last is not None:
                    new[0] = (route[0], content[0]) != last[:2]
                head = np.maximum.accumulate(np.where(new, np.arange(len(route)), -1))
                owner = [np.where(head < 0, last[2 + i] if last is not None else 0, x[head])
                         for i, x in enumerate((doc, version, second, start))]
                other = (doc != owner[0]) | (version != owner[1]) | (second != owner[2]) | (start != owner[3])
                later = ~new & other
                ranges.append((doc[later], version[later], second[later], start[later], size[later]))
                at = len(route) - 1
                last = (route[at], content[at], owner[0][at], owner[1][at], owner[2][at], owner[3][at])
                firsts = np.flatnonzero(new)
                # whole routes go into one suffix array
                edges = np.flatnonzero(np.diff(route[firsts])) + 1
                for part in np.split(firsts, edges):
                    if not len(part):
                        continue
                    r = route[part[0]]
                    if r != route_open and held_bytes >= array_bytes:
                        ranges.append(solve(held))
                        held, held_bytes = [], 0
                    route_open = r
                    held.append(tuple(x[part] for x in (doc, version, second, start, size, blobs)))
                    held_bytes += int(size[part].sum())
            yield _batch(dict(zip(("doc", "version", "second", "start", "size"), _merged(*[np.concatenate(x) for x in zip(*ranges)]))))
        if held:
            yield _batch(dict(zip(("doc", "version", "second", "start", "size"), _merged(*solve(held)))))

    return run


def _kept(texts: pa.Array, lists: pa.Array) -> pa.Array:
    """Step 4: the text's bytes, those kept, and the removed ranges."""
    sizes, kept, spans = [], [], []
    for t, ranges in zip(texts, lists):
        raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
        sizes.append(len(raw))
        merged = []
        if ranges.is_valid and len(ranges.values):
            both = ranges.values
            start, size = (both.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            zero = np.zeros(len(start), np.int64)
            _, _, _, s, n = _merged(zero, zero, zero, start, size)
            merged = list(zip(s.tolist(), n.tolist()))
            at, out = 0, []
            for s, n in merged:
                out.append(raw[at:s])
                at = s + n
            raw = b"".join([*out, raw[at:]])
        kept.append(raw)
        spans.append([{"start": s, "length": n} for s, n in merged])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)],
                                      ["n_bytes", "kept", "spans"])


def _text_hashes(text: Column) -> list[Column]:
    """What tells apart the texts of one id: two 64-bit hashes."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 key_segments: int = KEY_SEGMENTS, array_bytes: int = ARRAY_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``kept`` (bytes) and ``spans`` (removed ranges, in bytes)."""
    spark = docs.sparkSession
    t = F.col(text).cast("string")
    document = ["doc", "version", "second"]
    # the version's last bit tells a null id; these columns are never null, so that the two joins
    # below plan, and share, the same shuffle of the texts
    none = F.col(id).isNull().cast("long")
    hashes = [F.coalesce(h, F.lit(0).cast("long")) for h in _text_hashes(t)]
    base = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(_SMALLEST)).alias("doc"),
                       hashes[0].bitwiseAND(F.lit(-2)).bitwiseOR(none).alias("version"), hashes[1].alias("second"), t.alias("text"))
    # 1. segments, and what equal ones settle
    found = base.mapInArrow(_cut(length), SEGMENT)
    order = ["key", "content", "doc", "version", "second", "pos"]
    path = scratch_path(spark, "repeat-marks")
    found.repartition("key").sortWithinPartitions(*order).mapInArrow(_settle(length), MARK).write.parquet(path)
    marks = spark.read.schema(MARK).parquet(path)
    opened = marks.where("key is not null")
    # 2. open segments with their bytes; those of crowded keys in runs of fewer windows
    crowded = checkpointed(opened.groupBy("key").agg(F.count("*").alias("many")).where(F.col("many") > key_segments))
    whole = length - _gram(length) + 1
    most = F.when(F.col("many").isNull(), whole).otherwise(F.greatest(F.lit(1), F.floor(F.lit(whole * key_segments) / F.col("many"))))
    runs = (opened.join(small(crowded), "key", "left").withColumn("most", most.cast("long"))
            .groupBy(*document).agg(F.collect_list(F.struct("start", "size", "anchor", "most")).alias("open")))
    pieces = (base.join(runs.hint("shuffle_hash"), document).select(*document, "text", "open")
              .mapInArrow(_deal(length), PIECE))
    # 3. repeats inside them
    inner = (pieces.repartition("route").sortWithinPartitions("route", "content", *document, "start")
             .mapInArrow(_compare(length, array_bytes), RANGE))
    # 4. all marks of a document
    ranges = (marks.where("key is null").select(*document, "start", "size").unionByName(inner)
              .groupBy(*document).agg(F.collect_list(F.struct("start", "size")).alias("ranges")))
    cut = F.arrow_udf(_kept, "n_bytes long, kept binary, spans array<struct<start:bigint,length:bigint>>")
    out = base.join(ranges.hint("shuffle_hash"), document, "left").withColumn("r", cut("text", "ranges"))
    return out.select(F.when(F.col("version").bitwiseAND(F.lit(1)) == 0, F.col("doc")).alias(id), "r.n_bytes", "r.kept", "r.spans")
