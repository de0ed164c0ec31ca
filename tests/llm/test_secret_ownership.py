import hashlib
import random
import re
from collections import defaultdict

import duckdb
from tidewatch.llm import queries
from tidewatch.llm import secret_ownership as S

BASE = {"assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 8),
        "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16), "hex": (re.compile(r"[0-9a-f]+"), 0, 32)}
ORDER = ["assign", "access", "hex", "own"]


def brute_base(text):
    return [(k, m.start(), m.end(), m[g]) for k, (p, g, least) in BASE.items() for m in p.finditer(text or "") if len(m[g]) >= least]


def brute(rows):
    """Per (doc_id, text, owner): base spans, all spans, live, example."""
    each, owners, places = [], defaultdict(set), defaultdict(set)
    for doc, text, owner in rows:
        spans = brute_base(text)
        for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text or ""):
            if len(m[0]) >= 20 and 12 * len(re.findall("[A-Za-z]+[0-9]", m[0])) >= len(m[0]) and not any(
                    a < m.end() and b > m.start() for k, a, b, _ in spans if k != "own"):
                spans.append(("own", m.start(), m.end(), m[0]))
        for *_, v in spans:
            owners[v].add(owner)
            places[v].add((owner, doc))
        each.append(spans)
    out = []
    for (doc, _, _), spans in zip(rows, each):
        spans = sorted(spans, key=lambda s: (s[1], ORDER.index(s[0])))
        verdicts = []
        for *_, v in spans:
            likely = len(v) >= 16 and 12 * len(re.findall("[A-Za-z]+[0-9]", v)) >= len(v)
            verdicts.append("example" if len(owners[v]) > 1 or len(places[v]) > 64 else "live" if likely else "weak")
        show = lambda s: f"{s[0]}:{s[1]}:{s[2]}"
        base = ",".join(show(s) for s in spans if s[0] != "own")
        shown = [(s, v) for s, v in zip(spans, verdicts) if s[0] != "own" or v == "live"]
        count = lambda k: sum(s[0] == k for s, _ in shown)
        out.append((doc, *map(count, ORDER), hashlib.sha256(base.encode()).hexdigest(), ",".join(show(s) for s, _ in shown),
                    sum(v == "live" for _, v in shown), sum(v == "example" for _, v in shown)))
    return out


def made_rows():
    random.seed(3)
    hexes = ["".join(random.choice("0123456789abcdef") for _ in range(random.choice([31, 32, 40, 64]))) for _ in range(12)]
    tokens = ["".join(random.choice("ABCxyz019Kq7") for _ in range(random.randint(17, 40))) for _ in range(12)]
    parts = ["password", "PassWd", "api_key", "apikey", "APIKEY", "token", "secret", "=", " = ", ":", "  :\"", "'", "\"", " ", "\n", "é", "𝛂 ",
             "short", "longvalue1", "AKIA", "AKIAABCDEFGHIJKL", "AKIAABCDEFGHIJK", "abc", "paſſword=longvalue1", "toKen=longvalue1",
             "2024/05/06/some-article-name", "deadbeef", "ABCDEF0123456789ABCDEF0123456789", *hexes, *tokens]
    rows = [(0, None, "a"), (1, "", None), (2, "token=password=abcdefgh12", "a"), (3, "token=secret:longvalue123", "a"),
            (4, "\"api_key\" : \"abcd1234.=-_\"", None), (5, "x" * 50 + "A1" * 30, "b"), (6, "token" + " " * 50, "b")]
    rows += [(7 + i, "".join(random.choice(parts) for _ in range(random.randint(0, 25))), random.choice(["a", "b", "c", None])) for i in range(400)]
    shared = "A1b2C3d4E5f6G7h8I9j0K"                         # one owner, more repositories than its own would be in
    rows += [(1000 + i, f"see {shared} there", "a") for i in range(70)]
    return rows + [(7, rows[7][1], rows[7][2]), (None, "token: q1w2e3r4t5y6u7i8", "a"), (None, None, None)]


def write(spark, rows, folder):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, kind string, hash int")
    df.write.mode("overwrite").parquet(f"{folder}/documents.parquet")


def key(r):
    return tuple((x is None, str(x)) for x in r)


def test_query_equals_brute_force_and_sql(spark, tmp_path, monkeypatch):
    rows = made_rows()
    write(spark, rows, tmp_path)
    want = sorted(brute(rows), key=key)
    got = queries.op12_secret_ownership(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=key) == want
    assert sum(r[4] for r in want) > 50 and sum(r[8] for r in want) > 50      # own spans, examples
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = con.execute(queries.ORACLE["op12_secret_ownership"])
    names = [c[0] for c in sql.description]
    at = [names.index(c) for c in got.columns]
    assert sorted((tuple(r[i] for i in at) for r in sql.fetchall()), key=key) == want
    # every value that several rows hold takes the way of crowded ones
    monkeypatch.setattr(S, "CALM_ROWS", 1)
    monkeypatch.setattr(S, "SMALL_ROWS", 10_000)
    assert sorted(map(tuple, queries.op12_secret_ownership(spark, str(tmp_path)).collect()), key=key) == want


def test_operator_general_columns(odd_documents):
    out = S.secrets(odd_documents, owner="quality", repository="source")
    assert out.columns == ["doc_id", "secrets"] and out.count() == odd_documents.count()
    assert S.secrets(odd_documents.limit(0)).count() == 0


def test_ownership_decides(spark):
    live, copied = "q1W2e3R4t5Y6u7I8o9P0a", "z1X2c3V4b5N6m7A8s9D0f"
    rows = [(1, f"a {live}", "me", "r1"), (2, f"b {live}", "me", "r2"), (3, f"c {copied}", "me", "r1"), (4, f"d {copied}", "you", "r1"),
            (5, "password=abcdefgh", "me", "r1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, repo string")
    got = {r.doc_id: r.secrets for r in S.secrets(df, repository="repo").collect()}
    assert [(s.kind, s.n_repositories, s.n_owners, s.verdict) for s in got[1]] == [("own", 2, 1, "live")]
    assert got[3] == [] and got[4] == []
    assert [(s.kind, s.value_start, s.value_end, s.verdict) for s in got[5]] == [("assign", 9, 17, "weak")]
    few = {r.doc_id: r.secrets for r in S.secrets(df, repository="repo", max_repositories=1).collect()}
    assert few[1] == [] and few[2] == []


def test_long_texts(spark):
    text = "token" + " " * 300_000 + "=" + "\"" + "ab1" * 200_000 + " " + "token =" * 20_000 + "f0" * 100_000 + " " + "K9" * 100_000
    got = S.secrets(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).first().secrets
    assert [(s.kind, s.start, s.end) for s in got if s.kind != "own"] == [(k, a, b) for k, a, b, _ in sorted(
        brute_base(text), key=lambda s: (s[1], ORDER.index(s[0])))]
    assert got[-1].kind == "own" and got[-1].end == len(text)
