import random
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewatch.llm import packing


def expected_pieces(texts, capacity):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    for i, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_ids_pieces_and_places(odd_documents, capacity):
    rows = packing.pack(odd_documents, capacity=capacity).collect()
    expected = expected_pieces([(r.doc_id, r.text) for r in odd_documents.collect()], capacity)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter(expected)
    check_places(rows, capacity)
    assert packing.pack(odd_documents.limit(0), capacity=capacity).count() == 0


def test_sequences_hold_the_ids(odd_documents):
    packed = packing.pack(odd_documents, capacity=64, with_ids=True)
    pieces = {(r.sequence_id, r.offset): r.ids for r in packed.collect()}
    for r in packing.sequences(packed).collect():
        assert r.length <= 64 and len(r.ids) == 4 * r.length
        for (s, offset), ids in pieces.items():
            if s == r.sequence_id:
                assert r.ids[4 * offset:4 * offset + len(ids)] == ids


def test_plan_fills_and_is_near_the_bound():
    random.seed(2)
    for capacity in (10, 97, 2048):
        for _ in range(40):
            counts = Counter(min(capacity, max(1, int(random.lognormvariate(3, 1.2)))) for _ in range(random.randint(1, 600)))
            runs = packing.plan(dict(counts), capacity)
            used = Counter()
            seen = Counter()
            for n, r in runs.items():
                ends = [*r[1:, 0].tolist(), counts[n]]
                for (first, sequence, times, offset), end in zip(r.tolist(), ends):
                    for rank in range(first, end):
                        used[sequence + (rank - first) // times] += n
                        seen[n] += 1
            assert seen == counts and max(used.values()) <= capacity
            large = sum(c for n, c in counts.items() if 2 * n > capacity)
            bound = max(large, -(-sum(n * c for n, c in counts.items()) // capacity))
            assert len(used) <= bound * 1.23 + 1


def test_hot_length_is_split_into_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 16)
    df = spark.createDataFrame([(i, "same words") for i in range(400)], "doc_id long, text string")
    rows = packing.pack(df, capacity=7).collect()
    assert len(rows) == 400 and len({(r.sequence_id, r.offset) for r in rows}) == 400
    check_places(rows, 7)


def test_long_white_space(spark):
    """The fast encoder's pattern engine refuses runs of a million blanks; ids must not change."""
    n = 3_000_000
    texts = ["a" + " " * n + "b", "\n" * n, ("a  \n\t" * (n // 30)) + " \n" * (n // 2) + "end", "x" * 100 + " " * 999_000]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = packing.pieces(df).collect()
    assert Counter(tuple(r) for r in got) == Counter(expected_pieces(rows, 2048))
