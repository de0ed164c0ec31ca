import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidewatch.llm import substring_dedup as S


def brute(rows, length):
    """By document: its bytes, those kept and the removed ranges; ids are unique."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - length + 1):
            if raw[p:p + length] in seen:
                gone[p] += 1
                gone[p + length] -= 1
            seen.add(raw[p:p + length])
        cover = np.concatenate([[False], np.cumsum(gone[:-1]) > 0, [False]])
        starts, ends = np.flatnonzero(cover[1:] & ~cover[:-1]), np.flatnonzero(cover[:-1] & ~cover[1:])
        out[i] = (len(raw), bytes(b for b, c in zip(raw, cover[1:]) if not c), list(zip(starts.tolist(), (ends - starts).tolist())))
    return out


def found(df, **how):
    return {r.doc_id: (r.n_bytes, bytes(r.kept), [(s.start, s.length) for s in r.spans])
            for r in S.deduplicated(df, **how).collect()}


def corpus(seed):
    random.seed(seed)
    words = ["".join(random.choice("abcdé ") for _ in range(random.randint(3, 9))) for _ in range(30)]
    pool = [" ".join(random.choice(words) for _ in range(random.randint(1, 60))) for _ in range(40)]
    rows = []
    for i in range(200):
        t = "".join(random.choice(pool) + random.choice(["", "x", " "]) for _ in range(random.randint(0, 4)))
        t = "Ea " * random.randint(1, 200) if i % 50 == 0 else None if i % 37 == 0 else t
        if t and random.random() < 0.2:
            k = random.randrange(len(t))
            t = t[:k] + "@" + t[k + 1:]
        rows.append((None if i == 9 else i, t))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("length,key_segments,array_bytes", [(100, 1000, 1 << 20), (100, 3, 20000), (24, 2, 2000)])
def test_equals_brute_force(spark, length, key_segments, array_bytes):
    """Also with keys so crowded that they are dealt finer, and several suffix arrays a task."""
    rows = corpus(length + key_segments)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string").repartition(5)
    got = found(df, length=length, key_segments=key_segments, array_bytes=array_bytes)
    assert got == brute(rows, length)


def test_small_batches(spark):
    """State that goes on from one Arrow batch to the next."""
    rows = corpus(77)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, 100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repeated_rows_are_one_document(spark, odd_documents):
    rows = [(i, "".join(chr(97 + (i * j * j) % 23) for j in range(300))) for i in range(1, 6)]
    got = found(spark.createDataFrame(rows * 3, "doc_id long, text string"))
    assert got == brute(rows, 100)
    out = S.deduplicated(odd_documents)
    assert out.count() == odd_documents.count() and S.deduplicated(odd_documents.limit(0)).count() == 0


def test_longest_previous_factors():
    random.seed(5)
    for _ in range(150):
        n, depth = random.randint(20, 200), random.choice([8, 9, 12, 16, 19])
        data = np.array([random.choice(b"aab") for _ in range(n)], np.uint8)
        starts = np.array(sorted(random.sample(range(n - depth + 1), random.randint(1, n - depth + 1))))
        place = np.array(random.sample(range(1000), len(starts)))

        def common(a, b):
            k = 0
            while k < depth and data[a + k] == data[b + k]:
                k += 1
            return k

        expected = [max([common(a, b) for b, q in zip(starts, place) if q < p] or [0]) for a, p in zip(starts, place)]
        assert S.longest_previous_factors(data, starts, place, depth).tolist() == expected


def test_nearest_smaller():
    random.seed(8)
    for _ in range(50):
        v = random.sample(range(99), random.randint(0, 40))
        expected = [max([j for j in range(i) if v[j] < v[i]] or [-1]) for i in range(len(v))]
        assert S.nearest_smaller(np.array(v, int)).tolist() == expected


@pytest.mark.parametrize("first_hash_bits", [64, 4])
def test_many_texts_under_one_null_id(spark, monkeypatch, first_hash_bits):
    """Equal bits of one hash never mix up documents; each text starts with the same passage, which one keeps."""
    if first_hash_bits < 64:
        whole = S._text_hashes
        monkeypatch.setattr(S, "_text_hashes", lambda t: [F.pmod(whole(t)[0], F.lit(1 << first_hash_bits)), whole(t)[1]])
    random.seed(12)
    own = lambda n: "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    shared = own(150)
    rows = [(None, (shared if i % 2 else own(i % 70)) + own(200) + (shared if i % 3 == 0 else "")) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = S.deduplicated(df).collect()
    # documents of one id are ordered by their hashes, the first without its last bit
    first, second = S._text_hashes(F.col("text"))
    ordered = df.select("text", first.alias("a"), second.alias("b")).collect()
    texts = [r.text for r in sorted(ordered, key=lambda r: (r.a >> 1, r.b))]
    expected = brute(list(enumerate(texts)), 100)
    assert all(r.doc_id is None for r in out)
    assert sorted((r.n_bytes, bytes(r.kept), [(s.start, s.length) for s in r.spans]) for r in out) == sorted(expected.values())


def test_texts_of_one_id_are_told_apart_by_whole_hashes(spark):
    """So many texts under one null id that 24 bits of a hash collide."""
    passage = " the same passage here" * 6
    own = F.concat(*[F.sha2(F.concat(F.lit(x), F.col("id").cast("string")), 256) for x in "ab"])
    own = F.concat(own, F.substr(own, F.lit(1), (F.col("id") % 7 * 8).cast("int")))
    df = spark.range(30000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(own, F.lit(passage)).alias("text"))
    extra = F.length("kept") - (F.col("n_bytes") - len(passage))
    left = S.deduplicated(df).agg(F.count_if(extra > 20).alias("with_it"), F.count_if(extra.between(-20, 0)).alias("without")).first()
    # a few bytes before the passage may be the same by chance
    assert (left.with_it, left.without) == (1, 29999)
