"""Best-fit packing of tokenised documents into fixed-length sequences.

The plan is made on the histogram of piece lengths, which has at most ``capacity``
rows however large the corpus is, so it is the plan one global packer would make:
pieces above a third of the capacity fit at most twice into a sequence and are
matched greedily, largest with the largest that fits; smaller ones go, largest
first, to the tightest gap left.  Pieces then take their places by their rank among
the pieces of their length, from bucketed counts, so a length that a third of all
pieces share is never one group.

Defined cases: a null or empty text is the end token alone; repeated rows are packed
one by one; other columns are not read, whatever their names; an empty table packs
into no sequence; a text of any length is cut into whole capacities, its first
piece taking the remainder.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import checkpointed

CAPACITY, END_ID = 2048, 0
#: Pieces of one length that are ranked together; longer lists are split into buckets.
BUCKET_ROWS = 512

PIECE = "array<struct<start:bigint,length:bigint,ids_crc32:bigint,ids:binary>>"


def _encoder(ranks_path: str, pattern: str):
    """Byte-level BPE over a public rank file; special tokens' strings are ordinary text."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
           ranks_path: str | None = None, pattern: str | None = None, tokenizer_path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``: each document's ids, cut to the capacity.

    ``ids`` holds unsigned 32-bit little-endian ids.  The rank file has the vocabulary of
    the ``byte_bpe_50k.json`` file and gives the same ids (tested); it is read on the
    executors from the installed tokenizer package unless ``ranks_path`` says otherwise.  A
    text that its pattern engine refuses (a run of some million blanks) goes to that file's own tokenizer.
    """

    def run(batches):
        import public_tokenizers

        enc = _encoder(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN)

        def encoded(t: str) -> np.ndarray:
            try:
                return enc.encode_to_numpy(t, disallowed_special=())
            except ValueError:                              # the pattern engine's stack is full
                from tokenizers import Tokenizer
                whole = Tokenizer.from_file(tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"))
                return np.array(whole.encode(t, add_special_tokens=False).ids, np.uint32)

        for texts in batches:
            starts, lengths, crcs, blobs, ends = [], [], [], [], [0]
            for t in texts:
                t = t.as_py() or ""
                ids = np.append(encoded(t), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for a, b in zip(cuts, cuts[1:]):
                    raw = ids[a:b].tobytes()
                    starts.append(a)
                    lengths.append(b - a)
                    crcs.append(zlib.crc32(raw))
                    blobs.append(raw if with_ids else None)
                ends.append(len(starts))
            rows = pa.StructArray.from_arrays(
                [pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                 pa.array(blobs, pa.binary())], ["start", "length", "ids_crc32", "ids"])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    from collections.abc import Iterator

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    cut = F.arrow_udf(run, PIECE)(F.col(text).cast("string"))
    out = docs.select(F.col(id), F.posexplode(cut).alias("piece", "p"))
    names = ["start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return out.select(id, "piece", *[F.col(f"p.{c}").alias(c) for c in names])


def plan(counts: dict[int, int], capacity: int) -> dict[int, np.ndarray]:
    """By length: runs ``(first rank, first sequence, pieces a sequence, first offset)`` by rank.

    ``counts`` is pieces by length; the result's size depends on the capacity alone.
    """
    left = {n: c for n, c in counts.items() if c}
    groups: dict[int, list] = defaultdict(list)            # gap -> [number of sequences, [(length, times)]]

    def place(gap: int, group: list) -> None:
        groups[gap].append(group)
        if len(groups[gap]) == 1:
            bisect.insort(gaps, gap)

    def taken(gap: int) -> list:
        group = groups[gap].pop()
        if not groups[gap]:
            gaps.remove(gap)
        return group

    gaps: list[int] = []
    # matching: pieces of more than a third of the capacity, largest first
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        mates = bisect.bisect_right(large, capacity - n) - 1
        if mates < 0:                                       # nothing fits beside it
            place(capacity - n, [left.pop(n), [(n, 1)]])
            large.pop()
            continue
        m = large[mates]
        if m == n:                                          # with its own kind, an odd one goes on
            pairs = left[n] // 2
            if pairs:
                place(capacity - 2 * n, [pairs, [(n, 2)]])
            left[n] -= 2 * pairs
            if left[n]:
                mates -= 1
                if mates < 0:
                    place(capacity - n, [1, [(n, 1)]])
                else:
                    m = large[mates]
                    place(capacity - n - m, [1, [(n, 1), (m, 1)]])
                    left[m] -= 1
                    if not left[m]:
                        large.remove(m)
                        del left[m]
            large.remove(n)
            del left[n]
            continue
        pairs = min(left[n], left[m])
        place(capacity - n - m, [pairs, [(n, 1), (m, 1)]])
        for x in (n, m):
            left[x] -= pairs
            if not left[x]:
                large.remove(x)
                del left[x]
    # best fit: the others, largest first, each into the tightest gap that takes it
    for n in sorted(left, reverse=True):
        rest = left[n]
        while rest:
            at = bisect.bisect_left(gaps, n)
            if at < len(gaps):
                gap = gaps[at]
                many, items = taken(gap)
            else:
                gap, items = capacity, []
                many = -(-rest // (capacity // n))
            each = gap // n
            full = min(many, rest // each)
            if full:
                place(gap - each * n, [full, [*items, (n, each)]])
                rest, many = rest - full * each, many - full
            if many and rest:                               # the last ones fill a sequence in part
                place(gap - rest * n, [1, [*items, (n, rest)]])
                rest, many = 0, many - 1
            if many:
                place(gap, [many, items])
    runs: dict[int, list] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for gap in sorted(groups):
        for many, items in groups[gap]:
            offset = 0
            for n, times in items:
                runs[n].append((used[n], sequence, times, offset))
                used[n] += many * times
                offset += n * times
            sequence += many
    return {n: np.array(r, np.int64) for n, r in runs.items()}


def place(found: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """``found`` (with a ``length`` of 1 to ``capacity``) and each piece's ``sequence_id`` and ``offset``.

    ``found`` must be stored (checkpointed), as it is read twice.  Rows equal in the
    ``order`` columns and length may trade places.
    """
    counts = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    spark = found.sparkSession
    runs = plan(counts, capacity)
    buckets = F.broadcast(spark.createDataFrame(                                                      # <= capacity rows
        [(n, c // BUCKET_ROWS + 1) for n, c in counts.items()], "length long, _buckets long"))
    dealt = found.join(buckets, "length").withColumn("_bucket", F.pmod(F.xxhash64(*order), F.col("_buckets")))
    before = (dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n"))
              .drop("_n"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*order)
    ranked = (dealt.withColumn("_inside", F.row_number().over(inside) - 1).join(before, ["length", "_bucket"])
              .withColumn("_rank", F.col("_before") + F.col("_inside")))

    def seat(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        n, rank = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for length in np.unique(n):
            at = np.flatnonzero(n == length)
            first, start, times, shift = runs[int(length)].T
            run = np.searchsorted(first, rank[at], "right") - 1
            inner = rank[at] - first[run]
            sequence[at] = start[run] + inner // times[run]
            offset[at] = shift[run] + inner % times[run] * length
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    seats = F.arrow_udf(seat, "sequence_id long, offset long")(F.col("length"), F.col("_rank"))
    return (ranked.withColumn("_seat", seats)
            .select(*found.columns, F.col("_seat.sequence_id").alias("sequence_id"), F.col("_seat.offset").alias("offset")))


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False, **tokenizer) -> DataFrame:
    """Every piece of every document with its place: ``pieces`` stored, then ``place``."""
    found = checkpointed(pieces(docs, id, text, capacity, end_id, with_ids=with_ids, **tokenizer))
    return place(found, capacity, (id, "piece", "ids_crc32"))


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, length)``: the packed token ids, from ``pack(..., with_ids=True)``.

    At most ``capacity`` ids meet in a group.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform(parts, lambda p: p.ids), F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))
