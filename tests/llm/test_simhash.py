import random

import numpy as np
import xxhash
from tidewatch.llm import components, simhash


def brute_print(text, words, shingle=3, seed=42):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def classes(prints, groups, distance=2):
    g = groups(prints)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin(a ^ b).count("1") <= distance:
                g.link(a, b)
    return {p: g.root(p) for p in prints}


def test_operator_on_odd_documents(odd_documents, words, groups):
    rows = odd_documents.collect()
    fp = [brute_print(r.text, words) for r in rows]
    root = classes(sorted(set(fp)), groups)
    least = {}
    for r, f in zip(rows, fp):
        if r.doc_id is not None:
            least[root[f]] = min(least.get(root[f], r.doc_id), r.doc_id)
    expected = sorted(((r.doc_id, signed(f), least.get(root[f])) for r, f in zip(rows, fp)), key=str)
    found = simhash.near_duplicates(odd_documents)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in found.collect()), key=str) == expected
    assert simhash.near_duplicates(odd_documents.limit(0)).count() == 0
    kept = simhash.keep_first(odd_documents)
    assert kept.columns == odd_documents.columns
    assert len(kept.collect()) == len(set(root[f] for f in fp))


def test_links_in_crowded_variants(spark, groups):
    """Hundreds of fingerprints that share a half: the probing path finds the same classes."""
    random.seed(3)
    base = random.getrandbits(64)
    for bits, distance in (((32, 64), 2), ((0, 64), 2), ((32, 64), 3)):
        prints = {base}
        while len(prints) < 300:
            b = random.choice(sorted(prints))
            for _ in range(random.choice((1, 2, 3))):
                b ^= 1 << random.randrange(*bits)
            prints.add(b)
        prints = sorted(prints)
        edges = simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), distance).collect()
        g = groups(prints)
        for e in edges:
            g.link(e.a % (1 << 64), e.b % (1 << 64))
        assert {p: g.root(p) for p in prints} == classes(prints, groups, distance)


def test_components(spark, groups):
    random.seed(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (None, 3), (60, 0)]
    edges += [(random.randrange(200, 400), random.randrange(200, 400)) for _ in range(120)]
    found = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    g = groups({x for e in real for x in e})
    for e in real:
        g.link(*e)
    assert found == {m: g.root(m) for m in g.up}
    assert components.connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_forest_spans_its_graph(groups):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 80, 90), rng.integers(0, 80, 90)
    x, y = components.forest(a, b)
    one, two = groups(range(80)), groups(range(80))
    for e in zip(a.tolist(), b.tolist()):
        one.link(*e)
    for e in zip(x.tolist(), y.tolist()):
        two.link(*e)
    assert [one.root(i) for i in range(80)] == [two.root(i) for i in range(80)] and len(x) < 80


def test_memory_of_a_crowded_variant_follows_its_rows():
    """Dense fingerprints have some hundred links each; a task keeps spanning edges only."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    low = np.arange(1 << 14, dtype=np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(np.full(len(low), 40, np.int32)), pa.array(np.zeros(len(low), np.int64)), pa.array(low)],
                                       ["place", "rest", "fp"])
    tracemalloc.start()
    out = pa.Table.from_batches(list(simhash._links(2)(iter([batch]))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == len(low) - 1 and set(out["b"].to_pylist()) == {0}
    assert peak < 1200 * len(low)                           # links alone would take 8 kB a row
