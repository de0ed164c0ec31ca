import random
import zlib

import pytest
from pyspark.sql import functions as F
from tidewatch.llm import quality_classifier as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = Q.scored(docs.select("doc_id", "text"), Q.fit(docs, labels))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in scored.collect() if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r.score >= 0.3) == truth[r.doc_id] for r in rows)
    assert len(rows) > 50 and right / len(rows) > 0.9
    good = [r.score >= 0.3 for r in rows if truth[r.doc_id] == 1]
    assert sum(good) / len(good) > 0.95
    assert sum(r.score for r in rows) / len(rows) == pytest.approx(sum(truth[r.doc_id] for r in rows) / len(rows), abs=0.1)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    a, b = Q.fit(docs, labels), Q.fit(docs, flipped)
    assert a.share == b.share and a.dictionaries == b.dictionaries and (a.weights == b.weights).all()


def test_odd_documents_and_missing_classes(spark, odd_documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.fit(odd_documents, none)
    assert {r.score for r in Q.scored(odd_documents, model).collect()} == {0.5}
    one_sided = spark.createDataFrame([(i, 1) for i in range(12)] + [(None, 0), (3, None)], "doc_id long, quality int")
    assert {r.score for r in Q.scored(odd_documents, Q.fit(odd_documents, one_sided)).collect()} == {Q.fit(odd_documents, one_sided).share}
    both = spark.createDataFrame([(i, i % 2) for i in range(14)] + [(4, 1)], "doc_id long, quality int")
    scored = Q.scored(odd_documents, Q.fit(odd_documents, both), into="size")     # replaced; the others untouched
    assert scored.columns == odd_documents.columns and scored.count() == odd_documents.count()
    assert all(0 <= r["size"] <= 1 for r in scored.collect())
    assert Q.scored(odd_documents.limit(0), model).count() == 0


def test_what_follows_the_first_max_chars_is_learned(spark):
    """Bad texts start like good ones; only what comes later tells."""
    random.seed(4)
    words = ["".join(random.choice("abcdefghij") for _ in range(random.randint(2, 8))) for _ in range(300)]
    clean = lambda n: " ".join(random.choice(words) for _ in range(n))
    junk = lambda n: " ".join("".join(random.choice("!#%&0123456789XYZ") for _ in range(6)) for _ in range(n))
    rows = [(i, clean(600) if i % 2 else clean(200) + " " + junk(400), i % 2) for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    scored = Q.scored(docs, Q.fit(docs, labels, max_chars=800)).where(Q.held_out(F.col("doc_id"))).collect()
    assert len(scored) > 30 and all((r.score >= 0.5) == r.doc_id % 2 for r in scored)


def test_dictionary_samples_come_from_across_a_text(spark):
    texts = ["short", "é" * 16, "".join(chr(200 + i) for i in range(100))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in df.select(Q._spread(F.col("t"), 16).alias("s")).collect()]
    assert got[:2] == texts[:2] and len(got[2]) == 16 and got[2][:2] == texts[2][:2] and got[2][-2:] == texts[2][-2:]
