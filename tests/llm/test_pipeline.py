import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from tidewatch.llm import mixing, pii, queries, simhash
from test_packing import check_places, expected_pieces
from test_quality_rules import brute as quality_brute
from test_quality_rules import kept_by_hand
from test_simhash import brute_print, classes
from tidewatch.llm import quality_rules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output on the smallest tables."""
    from tidewatch.session import scratch_path
    docs, tables = spark.read.parquet(f"{SF}/documents.parquet"), []
    tables.append(docs.toPandas())
    for name, stage in P.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        tables.append(docs.toPandas())
    return tables


def test_columns(stages):
    assert all(list(t.columns) == list(stages[0].columns) for t in stages[1:-1])
    for t in stages[3:-1]:
        assert (t.n_chars == t.text.str.len()).all()


def test_quality_stage(stages, words):
    keep = set()
    for i, t in zip(stages[0].doc_id, stages[0].text):
        if kept_by_hand(quality_brute(t, words, tuple(quality_rules.NGRAM_LIMITS))):
            keep.add(i)
    assert sorted(stages[1].doc_id) == sorted(keep)


def test_near_duplicate_stage(stages, words, groups):
    fp = {i: brute_print(t, words) for i, t in zip(stages[1].doc_id, stages[1].text)}
    root = classes(sorted(set(fp.values())), groups)
    least = {}
    for i, f in sorted(fp.items()):
        least.setdefault(root[f], i)
    assert sorted(stages[2].doc_id) == sorted(least.values())


def test_private_data_stage(stages):
    before, after = (dict(zip(t.doc_id, t.text)) for t in (stages[2], stages[3]))
    assert before.keys() == after.keys()
    assert all(after[i] == t for i, t in before.items() if not re.search("[0-9@=:]|AKIA|ASIA", t))
    for i, t in before.items():
        for value in re.findall(r"[\w.]+@[\w.]+\w|\b\d+\.\d+\.\d+\.\d+\b|\+1 \(\d{3}\) \d{3}-\d{4}|[0-9a-f]{40}", t):
            assert value not in after[i]


def test_mixing_stage(stages, spark, words):
    taken = {r.doc_id: r.taken for r in mixing.mix(spark.createDataFrame(stages[3])).collect()}
    got = {}
    for i, t in zip(stages[4].doc_id, stages[4].text):
        got[i] = got.get(i, 0) + len(words(t))
    assert got == {i: n for i, n in taken.items() if n}


def test_packing_stage(stages):
    rows = list(stages[5].itertuples())
    expected = expected_pieces(list(zip(stages[4].doc_id, stages[4].text)), 2048)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    check_places(rows, 2048)


def test_every_operator_is_registered_once():
    names = sorted(n for n in E.queries() if n.startswith("op"))
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("key,table", [("op8_url_filter", "pages"), ("op1_quality_rules", "documents"),
                                       ("op6_chat_format", "conversations"), ("op7_embedding_near_dedup", "embeddings")])
def test_sql_oracle(spark, key, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    expected = con.execute(queries.ORACLE[key]).df()
    got = queries.QUERIES[key](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(expected.columns)
    rows = lambda df: sorted(map(str, df[sorted(df.columns)].astype(object).where(df.notna(), None).values.tolist()))
    assert rows(got) == rows(expected)


CONTRACT = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op4_substring_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_source_mixing": "doc_id size source_size target taken",
    "op6_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op7_embedding_near_dedup": "vec_id n_links component_id kept",
    "op8_url_filter": "page_id host path rule verdict",
    "op9_simhash": "doc_id fingerprint component_id",
    "op10_compression_classifier": "doc_id held_out score predicted",
}


@pytest.mark.parametrize("key", CONTRACT)
def test_contract_columns(spark, key):
    assert queries.QUERIES[key](spark, SF).columns[:len(CONTRACT[key].split())] == CONTRACT[key].split()


def test_native_operators_run_no_python(spark):
    for name in ("op3_pii", "op5_source_mixing"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    assert pii.ROUNDS >= 8 and simhash.DISTANCE == 2
