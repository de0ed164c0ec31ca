import hashlib
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tidewatch.llm import periodic_runs as P
from tidewatch.llm import queries


def brute(found, least=24, exponent=3):
    """All runs of a word list, by every period, and the words that stay."""
    n, runs = len(found), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if found[i] != found[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and found[j] == found[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                runs.setdefault((i, j + q - i), q)
            i = j + 1
    runs = sorted((s, length, q) for (s, length), q in runs.items())
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return runs, " ".join(w for i, w in enumerate(found) if i not in gone)


def texts_with_runs(seed=5):
    random.seed(seed)
    texts = [None, "", " \n", "a", "a " * 23, "a " * 24, "a\n" * 500, "a b " * 100, "é 𝛂 ñ " * 40, "ab a" * 60]
    for _ in range(400):
        letters = "abc"[:random.randint(1, 3)] if random.random() < 0.7 else "abcdefghijklmnopqrstuvwxyz"
        part = lambda k: [random.choice(letters) for _ in range(k)]
        out = part(random.randint(0, 30))
        for _ in range(random.randint(0, 3)):
            out += part(random.randint(1, 14)) * random.randint(1, 9) + part(random.randint(0, 6))
        if random.random() < 0.2:                          # runs of runs
            out = (out + part(2)) * 4
        texts.append(random.choice([" ", "\n", "  "]).join(out))
    return texts


def test_runs_equal_brute_force(words):
    texts = texts_with_runs()
    got = P.analysed(pa.array(texts)).to_pylist()
    for t, g in zip(texts, got):
        runs, collapsed = brute(words(t))
        assert [(r["start"], r["length"], r["period"]) for r in g["runs"]] == runs, t
        assert g["collapsed"] == collapsed


def test_extensions_equal_a_direct_count():
    rng = np.random.default_rng(2)
    for letters, n in ((1, 300), (2, 900), (2, 5000), (4, 700), (50, 4000)):
        x = rng.integers(0, letters, n)
        x[n // 2:n // 2 + n // 4] = np.resize(x[:7], n // 4)
        sizes = np.array([n // 3, 0, n - n // 3])
        g = P.Grammar(x.astype(np.int32), sizes)
        text = rng.choice([0, 2], 2000)
        i, j = (rng.integers(0, sizes[text]) for _ in range(2))
        text, i, j = text[i != j], i[i != j], j[i != j]
        ahead = g.ahead(g.at(text, i), g.at(text, j))
        behind = g.behind(g.at(text, i), g.at(text, j))
        for k in range(len(i)):
            t = x[:n // 3] if text[k] == 0 else x[n // 3:]
            a, b = t[i[k]:], t[j[k]:]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            assert ahead[k] == (differ[0] if len(differ) else m)
            a, b = t[:i[k]][::-1], t[:j[k]][::-1]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            assert behind[k] == (differ[0] if len(differ) else m)


def test_grammar_is_shallow():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 5000, 200_000).astype(np.int32)
    g = P.Grammar(x, np.array([200_000]))
    assert len(g.levels) < 80 and sum(map(len, g.levels)) < 6 * len(x)
    same = P.Grammar(np.zeros(200_000, np.int32), np.array([200_000]))
    assert len(same.levels) == 2


@pytest.mark.parametrize("small", [64, 1 << 19])
def test_chunks_change_nothing(small, monkeypatch, words):
    monkeypatch.setattr(P, "CHUNK", small)
    monkeypatch.setattr(P, "JOIN_WORDS", 50)
    texts = texts_with_runs(9)[:80]
    for t, g in zip(texts, P.analysed(pa.array(texts)).to_pylist()):
        runs, collapsed = brute(words(t))
        assert [tuple(r.values()) for r in g["runs"]] == runs and g["collapsed"] == collapsed


def test_very_long_texts(words):
    n = 600_000
    one = " ".join(["w"] * n)                              # one run of one word
    got = P.analysed(pa.array([one])).to_pylist()[0]
    assert got == {"runs": [{"start": 0, "length": n, "period": 1}], "collapsed": "w"}
    rng = np.random.default_rng(4)
    plain = [f"v{k}" for k in rng.integers(0, 20000, n)]
    plain[100_000:400_000] = (plain[100_000:190_000] * 4)[:300_000]
    got = P.analysed(pa.array([" ".join(plain)])).to_pylist()[0]
    assert len(got["runs"]) == 1
    r = got["runs"][0]
    assert r["period"] == 90_000 and r["start"] <= 100_000 and r["start"] + r["length"] >= 400_000
    assert got["collapsed"].split(" ") == [w for i, w in enumerate(plain)
                                           if not r["start"] + 90_000 <= i < r["start"] + r["length"]]


def test_sliced_arrays_and_other_thresholds(words):
    texts = ["skip me", "a b c " * 9, None, "x y " * 30, "z"]
    whole = P.analysed(pa.array(texts), 12, 2).to_pylist()
    assert P.analysed(pa.array(texts).slice(2), 12, 2).to_pylist() == whole[2:]
    assert P.analysed(pa.array([], pa.string())).to_pylist() == []
    for t, g in zip(texts, whole):
        assert [tuple(r.values()) for r in g["runs"]] == brute(words(t), 12, 2)[0]
    with pytest.raises(ValueError):
        P.analysed(pa.array(texts), 8, 1)


def test_operator_keeps_rows_and_clashing_columns(odd_documents, words):
    out = P.periodic_runs(odd_documents, into="quality")   # replaced; 'size' and 'source' stay
    assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    for r in out.collect():
        runs, collapsed = brute(words(r.text))
        assert [tuple(x) for x in r.quality.runs] == runs and r.quality.collapsed == collapsed
    assert P.periodic_runs(odd_documents.limit(0)).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text, words):
    found = words(text)
    n = len(found)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            found = [found[a + (i - a) % p] if i >= a else found[i] for i in range(n)]
    runs, collapsed = brute(found)
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    s, length, q = best or (None, None, None)
    return (doc_id, len(runs), s, length, q, 1000 * length // q if best else None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(collapsed))


def test_query_equals_brute_force(spark, tmp_path, words):
    texts = texts_with_runs(7)[:150]
    rows = [(i, t, "s", "x") for i, t in enumerate(texts)] + [(3, "a b " * 30, None, "x"), (3, "a b " * 30, None, "x"), (None, "q " * 40, "s", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = sorted((expected(r[0], r[1], words) for r in rows), key=key)
    assert sorted(map(tuple, got.collect()), key=key) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = con.execute(queries.ORACLE["op11_periodic_runs"])
    assert [c[0] for c in sql.description] == got.columns
    assert sorted(sql.fetchall(), key=key) == want
