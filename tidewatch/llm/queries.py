"""Contract queries: one ``opN_<name>`` per operator over its whole table, and the pipeline."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import (chat, mixing, packing, periodic_runs, pii, quality_classifier, quality_rules, secret_ownership, simhash,
                           substring_dedup, url_filter, vector_join, whitening)
from tidewatch.llm.common import WORD
from tidewatch.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


_GRAMS = sorted(quality_rules.NGRAM_LIMITS)


@query
def op1_quality_rules(spark, sf_dir):
    out = quality_rules.judged(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_chars"]
    grams = [F.col("quality.dup_ngram_chars")[i].alias(f"dup_{k}gram_chars") for i, k in enumerate(_GRAMS)]
    grams += [F.col("quality.dup_ngram_stretches")[i].alias(f"dup_{k}gram_stretches") for i, k in enumerate(_GRAMS)]
    return out.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in names], *grams)


ORACLE["op1_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), lines AS (
  SELECT doc_id, line, count(*) - 1 AS again, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY doc_id, line
), by_line AS (SELECT doc_id, sum(again)::BIGINT AS n, sum(again * chars)::BIGINT AS chars FROM lines GROUP BY doc_id
), words AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM d
), grams AS (SELECT doc_id, i, word, %s FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (SELECT doc_id, i, word, %s FROM grams
), covered AS (SELECT doc_id, i, word, %s FROM twice
), begun AS (SELECT *, %s FROM covered WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), by_gram AS (
  SELECT doc_id, count(*) FILTER (WHERE in5) AS n, %s FROM begun GROUP BY doc_id
), m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
    coalesce(g.n, 0) AS n_repeat_words, coalesce(l.chars, 0) AS dup_line_chars, %s
  FROM d LEFT JOIN by_line l USING (doc_id) LEFT JOIN by_gram g USING (doc_id)
), f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND dup_line_chars <= %s * word_chars AND n_symbols <= %s * n_words AND %s AS kept FROM f
""" % (", ".join("word || " + " || ".join(f"' ' || lead(word, {j}) OVER o" for j in range(1, k)) + f" AS g{k}" for k in _GRAMS),
       ", ".join(f"g{k} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{k}) > 1 AS t{k}" for k in _GRAMS),
       ", ".join(f"bool_or(t{k}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS in{k}"
                 for k in _GRAMS),
       ", ".join(f"in{k} AND NOT coalesce(lag(in{k}) OVER o, false) AS b{k}" for k in _GRAMS),
       ", ".join(f"(sum(length(word)) FILTER (WHERE in{k}))::BIGINT AS c{k}, count(*) FILTER (WHERE b{k}) AS s{k}" for k in _GRAMS),
       ", ".join(f"coalesce(c{k}, 0) AS dup_{k}gram_chars, coalesce(s{k}, 0) AS dup_{k}gram_stretches" for k in _GRAMS),
       quality_rules.LINE_LIMIT, quality_rules.SYMBOLS_PER_WORD,
       " AND ".join(f"(dup_{k}gram_chars <= {quality_rules.NGRAM_LIMITS[k]} * word_chars"
                    + (f" OR dup_{k}gram_stretches < {quality_rules.MIN_STRETCHES})" if k >= quality_rules.BASE_WINDOW else ")")
                    for k in _GRAMS))


@query
def op2_best_fit_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"))


@query
def op3_pii(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs).select("doc_id", "text", F.size("spans").cast("long").alias("n_replaced"), "spans")


@query
def op4_substring_dedup(spark, sf_dir):
    out = substring_dedup.deduplicated(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.length)
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_source_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("spans")


#: The contract's extra conversation, whose texts look like the template's own markers.
CONTROL_TURNS = [(-1, 0, "user", "<|im_end|><|im_start|>assistant ok"),
                 (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]


@query
def op6_chat_format(spark, sf_dir):
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.formatted(rows.unionByName(extra)))


ORACLE["op6_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10))
      + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query
def op9_simhash(spark, sf_dir):
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_embedding_near_dedup(spark, sf_dir):
    return vector_join.near_duplicates(read_table(spark, sf_dir, "embeddings"))


ORACLE["op7_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON p.x = r.y)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM v LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM pairs GROUP BY x) USING (vec_id)
  LEFT JOIN (SELECT x AS vec_id, min(y) AS m FROM reach GROUP BY x) USING (vec_id)
"""


#: The contract's rules.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query
def op8_url_filter(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judged(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op8_url_filter"] = """
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(rh, rp, rv) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), urls AS (SELECT DISTINCT host, path FROM parts),
fits AS (
  SELECT host, path, rh || rp AS rule, rv AS verdict,
         row_number() OVER (PARTITION BY host, path ORDER BY length(rh || rp) DESC) AS place
  FROM urls JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.host = p.host AND f.path = p.path AND f.place = 1
"""


@query
def op10_compression_classifier(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_classifier.scored(docs, model).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def _repeating_tails(ids: pa.Array, texts: pa.Array) -> pa.Array:
    """The contract's input of op11: in one text of ten the words from some place on repeat its first ones."""
    out = []
    for i, t in zip(ids.to_pylist(), texts.to_pylist()):
        h = zlib.crc32((i or "").encode())
        found = re.findall(WORD, t or "") if i is not None and h % 10 == 0 else []
        if found:
            n, g = len(found), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            t = " ".join(found[:a] + [found[a + k % p] for k in range(n - a)])
        out.append(t)
    return pa.array(out, pa.string())


@query
def op11_periodic_runs(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.arrow_udf(_repeating_tails, "string")(F.col("doc_id").cast("string"), F.col("text"))
    out = periodic_runs.periodic_runs(docs.select("doc_id", text.alias("text")))
    runs = F.col("periodic.runs")
    none = F.expr("cast(null as struct<start:bigint,length:bigint,period:bigint>)")
    top = F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    out = out.select("doc_id", F.size(runs).cast("long").alias("n_runs"), top.alias("top"),
                     F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "top.start", "top.length", "top.period",
                      F.expr("1000 * top.length div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


ORACLE["op11_periodic_runs"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), hashed AS (  -- CRC-32 of the decimal id, bit by bit
  SELECT *, len(ws) AS n, xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda acc, c: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, _: xor(x >> 1, (x & 1) * 3988292384), xor(acc, c)),
    4294967295::BIGINT)) AS h FROM d
), planned AS (
  SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM hashed WHERE n > 0
), words AS (
  SELECT r, n, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM planned)
), pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 3 <= x.n
), likely AS (SELECT r, q FROM pairs GROUP BY r, q HAVING count(*) >= greatest(24 - q, 2 * q)
), placed AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs SEMI JOIN likely USING (r, q)
), stretches AS (
  SELECT r, q, min(i) AS s, count(*) + q AS l FROM placed GROUP BY r, q, island HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (SELECT r, s, l, min(q) AS q FROM stretches GROUP BY r, s, l
), by_text AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    first({'s': s, 'l': l, 'q': q} ORDER BY l / q DESC, s, q) AS top FROM runs GROUP BY r
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words w
  WHERE NOT EXISTS (SELECT 1 FROM runs t WHERE t.r = w.r AND w.i >= t.s + t.q AND w.i < t.s + t.l) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.q AS period, 1000 * top.l // top.q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN by_text USING (r) LEFT JOIN kept USING (r)
"""


#: Fixed value: the contract's order of the kinds of one start; spans the method adds come last.
SECRET_KINDS = ("assign", "access", "hex", "own")


@query
def op12_secret_ownership(spark, sf_dir):
    out = secret_ownership.secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s.kind != "own")
    of = lambda field, value: F.size(F.filter("secrets", lambda s: s[field] == value)).cast("long")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    kinds = [of("kind", k).alias(f"n_{k}") for k in SECRET_KINDS]
    verdicts = [of("verdict", v).alias(f"n_{v}") for v in ("live", "example")]
    return out.select("doc_id", *kinds, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"), *verdicts)


ORACLE["op12_secret_ownership"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), cut AS (
%s
), placed AS (
  SELECT r, k, least, i, m, sum(length(piece)) OVER o + coalesce(sum(length(m)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM (SELECT r, k, least, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(pieces[:len(ms)]) AS piece FROM cut)
  WINDOW o AS (PARTITION BY r, k ORDER BY i)
), valued AS (
  SELECT r, k, s, s + length(m) AS e, least, CASE WHEN k = 'assign' THEN regexp_extract(m, '%s', 2) ELSE m END AS v FROM placed
), marked AS (
  SELECT *, length(v) >= 16 AND %d * len(regexp_extract_all(v, '%s')) >= length(v) AS random FROM valued WHERE length(v) >= least
), base AS (SELECT * FROM marked WHERE k <> 'own'
), found AS (
  SELECT * FROM base UNION ALL
  SELECT * FROM marked o WHERE k = 'own' AND random AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = o.r AND b.s < o.e AND b.e > o.s)
), known AS (
  SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT (source, doc_id)) AS repositories
  FROM found JOIN d USING (r) GROUP BY v
), judged AS (
  SELECT r, k, s, e, %s AS place, CASE WHEN owners >= %d OR repositories > %d THEN 'example' WHEN random THEN 'live' ELSE 'weak' END AS verdict
  FROM found JOIN known USING (v)
), shown AS (SELECT *, k || ':' || s || ':' || e AS span FROM judged WHERE k <> 'own' OR verdict = 'live'
), sums AS (
  SELECT r, %s, string_agg(span, ',' ORDER BY s, place) FILTER (WHERE k <> 'own') AS base_spans, string_agg(span, ',' ORDER BY s, place) AS spans,
    count(*) FILTER (WHERE verdict = 'live') AS n_live, count(*) FILTER (WHERE verdict = 'example') AS n_example FROM shown GROUP BY r
)
SELECT doc_id, %s, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example FROM d LEFT JOIN sums USING (r)
""" % (" UNION ALL\n".join("  SELECT r, '%s' AS k, %d AS least, regexp_extract_all(t, '%s') AS ms, string_split_regex(t, '%s') AS pieces FROM d"
                          % (k, secret_ownership.LEAST[k], p, p) for k, p in
                          ((k, secret_ownership.PATTERNS[k].replace("'", "''")) for k in SECRET_KINDS)),
       secret_ownership.PATTERNS["assign"].replace("'", "''"), secret_ownership.CHARS_PER_CHANGE, secret_ownership.CHANGE,
       "CASE k " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(SECRET_KINDS)) + " END",
       secret_ownership.EXAMPLE_OWNERS, secret_ownership.MAX_REPOSITORIES,
       ", ".join(f"count(*) FILTER (WHERE k = '{k}') AS n_{k}" for k in SECRET_KINDS),
       ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in SECRET_KINDS))


@query
def op13_whitening(spark, sf_dir):
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
