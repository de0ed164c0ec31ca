import random

import pytest
from pyspark.sql import functions as F
from tidewatch.llm import mixing


def expected_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + ([None] if None in sizes else [])
    weight = {n: mixing.WEIGHTS[i % 3] for i, n in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in capped]
        level = (total - sum(2 * sizes[n] for n in capped)) / sum(weight[n] for n in free) if free else 0
        new = {n for n in free if weight[n] * level > 2 * sizes[n]}
        if not new:
            return {n: float(2 * sizes[n]) if n in capped else weight[n] * level for n in names}
        capped |= new


def corpus(spark, n_sources, seed, null=True):
    random.seed(seed)
    rows = []
    for i in range(600):
        s = 0 if random.random() < 0.35 else random.randrange(n_sources)
        words = int(random.lognormvariate(4, 1.3))
        rows.append((i, " ".join(f"w{j}" for j in range(words)), None if null and s == n_sources - 1 else f"src{s}é"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("n_sources,shard_words", [(1, 1 << 20), (2, 3000), (7, 1 << 20), (20, 3000)])
def test_targets_and_takes(spark, words, n_sources, shard_words):
    docs = corpus(spark, n_sources, n_sources)
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    sizes = {}
    for t, s in texts.values():
        sizes[s] = sizes.get(s, 0) + len(words(t))
    target = expected_targets(sizes)
    rows = mixing.mix(docs, shard_words=shard_words).collect()
    taken = {}
    for r in rows:
        text, source = texts[r.doc_id]
        assert r["size"] == len(words(text)) and r.source_size == sizes[source]
        assert r.target == pytest.approx(target[source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r.taken
    for s, t in target.items():
        assert taken[s] == pytest.approx(t, rel=0.02, abs=2 * mixing.BLOCK_WORDS)
    again = mixing.mix(docs.repartition(5), shard_words=shard_words).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, rows))


def test_mixed_rows_hold_what_is_taken(spark, words):
    docs = corpus(spark, 5, 9).withColumn("size", F.lit("clash")).withColumn("n_chars", F.length("text"))
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        assert r["size"] == "clash"
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
    assert got == {i: n for i, n in taken.items() if n}


def test_odd_documents(odd_documents):
    rows = mixing.mix(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(r.taken == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(odd_documents.limit(0)).count() == 0
    assert mixing.mixed(odd_documents.limit(0)).columns == odd_documents.columns
    assert all(r.taken == 0 for r in mixing.mix(odd_documents.where("doc_id in (0, 1, 2)")).collect())


def test_apportionment_is_highest_quotients(spark):
    random.seed(6)
    rows = []
    for g in range(30):
        n = random.randint(1, 9)
        votes = [random.choice([0, 1, 3, random.random() * 50]) for _ in range(n)]
        seats = random.randint(0, 60)
        rows += [(g, i, float(v), seats, 10 ** 6) for i, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "g long, i long, v double, seats long, cap long")
    got = {(r.g, r.i): r.q for r in mixing.apportion(df, "v", "seats", "cap", "q", ["g"], ["i"]).collect()}
    for g in range(30):
        mine = [r for r in rows if r[0] == g]
        if not any(v for _, _, v, _, _ in mine):
            continue
        won = {i: 0 for _, i, *_ in mine}
        for _ in range(mine[0][3]):
            best = max(mine, key=lambda r: (r[2] / (2 * won[r[1]] + 1), -r[1]))
            won[best[1]] += 1
        assert {i: got[g, i] for i in won} == won


def test_very_long_text(spark, words):
    """A text of 600,000 words costs time in proportion to its words, not their square."""
    text = " ".join(f"w{i % 1000}" for i in range(600_000))
    rows = [(0, text, "a"), (1, "few words here", "a"), (2, "some more words in another source", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in mixing.mix(df).collect()}
    got = {}
    for r in mixing.mixed(df).collect():
        got.setdefault(r.doc_id, []).append(len(words(r.text)))
    assert {i: sum(n) for i, n in got.items()} == {i: r.taken for i, r in found.items() if r.taken}
    assert found[0].spans and 600_000 <= found[0].taken <= 1_200_000
