"""Secrets in texts, told apart by who else in the corpus holds them.

Patterns find candidates: named assignments, access keys, hexadecimal keys, and any other
token that looks random.  A candidate's value leaves its task as a 128-bit hash only.  Hashes are
aggregated over the corpus: a value that several owners or very many repositories hold is a
copied example; one that a single owner holds in few repositories is that owner's own and, if it
looks random, a live credential.  Patterned candidates are always reported, with that verdict;
other random-looking tokens are reported only where the corpus shows them to be an owner's own.

Only ids, owners and candidate spans leave the first pass, stored in the shared folder; texts are
read once.  Frequencies collapse map-side by (hash, owner, repository), then (hash, owner), then
hash.  On the way back the hashes of many candidates (more than one in ``SMALL_ROWS`` of all, so at most
``SMALL_ROWS`` hashes at any size) are broadcast, the others joined by hash: no join key is hot.

Defined cases: a null or empty text has no secrets; a null owner is one owner, a null repository one
repository of its owner; rows that repeat an id are rows of their own, in one repository if
they name the same; an empty table gives an empty table; only the id, text, owner and repository
columns are read, whatever the others are called; whole texts of any length are searched.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SMALL_ROWS
from tidewatch.session import checkpointed

NAMES = ("password", "passwd", "secret", "token", "api_?key")
VALUE = "A-Za-z0-9+/_.=-"
#: Characters of a token that is no word, and the share of its characters at which a digit must follow a letter.
RANDOM = "A-Za-z0-9+/_=-"
RANDOM_LENGTH, CHARS_PER_CHANGE = 20, 12
#: Shortest value by kind; ``own`` is a random-looking token that no pattern covers.
LEAST = {"assign": 8, "access": 16, "hex": 32, "own": RANDOM_LENGTH}
KINDS = tuple(LEAST)
#: From so many owners, or above so many repositories of one owner, a value is a copied example.
EXAMPLE_OWNERS, MAX_REPOSITORIES = 2, 64
#: A key of up to so many candidates is no hot one.
CALM_ROWS = 5000

SPANS = "array<struct<kind:string,start:bigint,end:bigint,value_start:bigint,value_end:bigint,random:boolean,hash:binary>>"


def _either_case(name: str) -> str:
    """ASCII letters in either case, without the Unicode folding of a case-insensitive match."""
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", name)


#: Group 2 of ``assign`` is the value.
PATTERNS = {
    "assign": rf"({'|'.join(map(_either_case, NAMES))})[\"']?\x20*[:=]\x20*[\"']?([{VALUE}]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{%d,}" % LEAST["hex"],
    "own": r"[%s]{%d,}" % (RANDOM, RANDOM_LENGTH),
}
CHANGE = "[A-Za-z]+[0-9]"


def looks_random(value: str) -> bool:
    """Digits follow letters too often for words, numbers or paths."""
    return len(value) >= 16 and CHARS_PER_CHANGE * len(re.findall(CHANGE, value)) >= len(value)


def candidates(text: str, compiled: dict) -> list[tuple]:
    """``(kind, start, end, value start, value end, value)`` of every candidate, in code points."""
    out = []
    for kind in KINDS[:3]:
        for m in compiled[kind].finditer(text):
            a, b = m.span(2 if kind == "assign" else 0)
            if b - a >= LEAST[kind]:
                out.append((kind, m.start(), m.end(), a, b, text[a:b]))
    covered = sorted((c[1], c[2]) for c in out)
    at, reach = 0, 0                                       # spans that begin before a token's end, and how far they go
    for m in compiled["own"].finditer(text):
        while at < len(covered) and covered[at][0] < m.end():
            reach = max(reach, covered[at][1])
            at += 1
        if reach <= m.start() and looks_random(m[0]):
            out.append(("own", *m.span(), *m.span(), m[0]))
    return out


def _spans(texts: pa.Array) -> pa.Array:
    compiled = {k: re.compile(p) for k, p in PATTERNS.items()}
    rows, ends = [], [0]
    for t in texts:
        for kind, a, b, c, d, value in candidates(t.as_py() or "", compiled):
            rows.append((kind, a, b, c, d, looks_random(value), hashlib.blake2b(value.encode(), digest_size=16).digest()))
        ends.append(len(rows))
    kinds = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value_start", pa.int64()),
             ("value_end", pa.int64()), ("random", pa.bool_()), ("hash", pa.binary())]
    columns = list(zip(*rows)) or [()] * len(kinds)
    structs = pa.StructArray.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], [n for n, _ in kinds])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)


def ownership(found: DataFrame) -> DataFrame:
    """``(hash, n_candidates, n_repositories, n_owners)`` of candidates ``(hash, owner, repository)``."""
    each = found.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    owned = each.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("r"))
    return owned.groupBy("hash").agg(F.sum("n").alias("n_candidates"), F.sum("r").alias("n_repositories"),
                                     F.count("*").alias("n_owners"))


def verdict(random: Column, n_repositories: Column, n_owners: Column, example_owners: int = EXAMPLE_OWNERS,
            max_repositories: int = MAX_REPOSITORIES) -> Column:
    """``example`` (widely copied), ``live`` (one owner's own, random-looking) or ``weak`` (its own, but no random value)."""
    copied = (n_owners >= example_owners) | (n_repositories > max_repositories)
    return F.when(copied, "example").when(random, "live").otherwise("weak")


def secrets(docs: DataFrame, id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id",
            example_owners: int = EXAMPLE_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per row of ``docs``: the id and its ``secrets``.

    ``secrets`` is an array, by start, then kind in the order of ``KINDS``, of ``kind``, ``start``, ``end``, the
    ``value_start`` and ``value_end`` within, ``n_repositories``, ``n_owners`` and ``verdict``; never a value.
    """
    def _col(name: str) -> Column:
        return F.col(f"`{name}`")

    run = F.arrow_udf(_spans, SPANS)
    stored = checkpointed(docs.select(F.monotonically_increasing_id().alias("row"), _col(id).alias("id"), _col(owner).alias("owner"),
                                      _col(repository).alias("repository"), run(_col(text).cast("string")).alias("spans")))
    found = stored.where(F.size("spans") > 0).select("row", "id", "owner", "repository", F.inline("spans"))
    known = checkpointed(ownership(found))
    total = known.agg(F.sum("n_candidates")).first()[0] or 0
    hot = F.col("n_candidates") > max(CALM_ROWS, total // SMALL_ROWS)             # so fewer than SMALL_ROWS hashes
    facts = ["hash", "n_repositories", "n_owners"]
    crowded = F.broadcast(known.where(hot).select(*facts))
    some = found.join(crowded, "hash")
    rest = found.join(crowded.select("hash"), "hash", "left_anti").join(known.where(~hot).select(*facts), "hash")
    judged = some.unionByName(rest).withColumn(
        "verdict", verdict(F.col("random"), F.col("n_repositories"), F.col("n_owners"), example_owners, max_repositories))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    shown = F.struct("start", rank.alias("rank"), "kind", "end", "value_start", "value_end", "n_repositories", "n_owners", "verdict")
    reported = F.when((F.col("kind") != "own") | (F.col("verdict") == "live"), shown)
    by_row = judged.groupBy("row", "id").agg(F.array_sort(F.collect_list(reported)).alias("spans"))     # one text's spans
    names = ["kind", "start", "end", "value_start", "value_end", "n_repositories", "n_owners", "verdict"]
    with_some = by_row.select("id", F.transform("spans", lambda s: F.struct(*[s[n].alias(n) for n in names])).alias("secrets"))
    kind = with_some.schema["secrets"].dataType
    without = stored.where(F.size("spans") == 0).select("id", F.array().cast(kind).alias("secrets"))
    return with_some.unionByName(without).select(F.col("id").alias(id), "secrets")
