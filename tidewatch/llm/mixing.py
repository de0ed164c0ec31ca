"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources get target sizes by weight, none above its cap.  Each source's rows are dealt
into shards of a bounded number of words, laid end to end in a seeded order, and cut
into blocks of (nearly) equal words.  Blocks are apportioned by highest quotients, first
to sources by their targets and then to each source's shards, which gives every shard an
integer quota; a seeded permutation selects that many of the shard's blocks.  A quota
above the number of blocks takes all of them and the rest a second time.

Everything is DataFrame expressions.  Source totals collapse map-side, a hot source is
many shards, and apportionment ranks at most about two candidate seats a source or shard.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null source is
a source of its own, sorted last; rows that repeat an id are rows of their own; an empty
table gives an empty table; a text of any length is one row, whose words are split once; only the id, text and source columns are read unless asked
to be carried, and the operator's own columns win over carried ones of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, let, small
from tidewatch.session import checkpointed

WEIGHTS, TOTAL, MAX_REPEATS = (5, 2, 1), 1.5, 2
BLOCK_WORDS, SHARD_WORDS, SEED = 64, 1 << 20, 17
#: Primes above any number of blocks in a shard, so coprime to it.
PRIMES = (2147483587, 2147483629, 2147483647, 4294967279, 4294967291)


def targets(sources: DataFrame, weights=WEIGHTS, total: float = TOTAL, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size)`` with ``weight`` and ``target``: shares by weight below a cap.

    Sources weigh ``weights`` in turn by code point, null last.  The shares of all
    sources are ``total`` times their sizes; none is above ``max_repeats`` times its
    source, and what is cut off is shared again by weight.  Sorted by cap over weight,
    the capped sources come first, so running sums find them in one pass.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    exact = lambda c: c.cast("decimal(38,6)")
    df = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    df = df.withColumn("cap", F.lit(max_repeats) * F.col("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    df = (df.withColumn("all_words", F.sum(exact(F.col("source_size"))).over(everything) * F.lit(total).cast("decimal(10,6)"))
          .withColumn("all_weight", F.sum("weight").over(everything))
          .withColumn("cap_before", F.coalesce(F.sum(exact(F.col("cap"))).over(before), F.lit(0)))
          .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    level = (F.col("all_words") - F.col("cap_before")).cast("double") / (F.col("all_weight") - F.col("weight_before"))
    df = df.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    # the first source that is not capped sets the level of all that follow
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    return df.withColumn("free", free.getField("level")).withColumn(
        "target", F.when(F.col("capped") | F.col("free").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("weight") * F.col("free"), F.col("cap").cast("double")))
    ).select("source", "source_size", "weight", "target")


def apportion(df: DataFrame, votes: str, seats: str, cap: str, into: str, by: list[str], key: list[str]) -> DataFrame:
    """``df`` with integer ``into``: ``seats`` (equal within ``by``) dealt by highest ``votes / (2k + 1)``.

    Divisors half a seat a row apart from the mean bound every row's seats from below and
    above; only the seats between the two bounds are ranked, at most about two a row.
    """
    group = Window.partitionBy(*by) if by else Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = (df.withColumn("_v", F.sum(votes).over(group)).withColumn("_rows", F.count("*").over(group))
          .withColumn("_sure", F.coalesce(F.floor(F.col(votes) * F.greatest(F.col(seats) - F.col("_rows") / 2, F.lit(0))
                                                  / F.when(F.col("_v") > 0, F.col("_v")) + 0.5).cast("long"), F.lit(0)))
          .withColumn("_most", F.coalesce(F.floor(F.col(votes) * (F.col(seats) + F.col("_rows") / 2)
                                                  / F.when(F.col("_v") > 0, F.col("_v")) + 0.5).cast("long"), F.lit(0)))
          .withColumn("_sure", F.when(F.col(votes) * (F.col(seats) - F.col("_rows") / 2) > 0, F.col("_sure")).otherwise(0))
          .withColumn("_sure_all", F.sum("_sure").over(group)))
    open_seats = F.when(F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure"), F.col("_most") - 1))
    rows = df.withColumn("_k", F.explode_outer(open_seats))
    quotient = F.col(votes) / (2 * F.col("_k") + 1)
    order = [quotient.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in key], F.col("_k").asc()]
    rank = F.row_number().over((Window.partitionBy(*by) if by else Window).orderBy(*order))
    rows = rows.withColumn("_won", (F.col("_k").isNotNull() & (rank <= F.col(seats) - F.col("_sure_all"))).cast("long"))
    kept = [c for c in df.columns if c not in ("_v", "_rows", "_sure", "_most", "_sure_all", into)]
    out = rows.groupBy(*kept).agg((F.first("_sure") + F.sum("_won")).alias(into))
    return out.withColumn(into, F.least(F.col(into), F.col(cap)))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", carry: tuple[str, ...] = (),
        weights=WEIGHTS, total: float = TOTAL, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``source_size``, ``target``, ``taken``, ``copies``, ``spans``.

    The mix takes the text ``copies`` times in whole and once more its word ``spans``
    (from, to; 0-based, end excluded).  ``carry`` names further columns to keep.
    """
    own = {"size", "source_size", "target", "taken", "copies", "spans"}
    carry = tuple(c for c in carry if c not in own and c not in (id,))
    raw = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(id).alias("_id"), F.col(source).alias("_source"),
                      words(F.col(text).cast("string")).alias("_size"),
                      F.xxhash64(F.lit(seed), F.col(id), F.col(text)).alias("_key"))
    narrow = checkpointed(raw.select("_id", "_source", "_size", "_key"))
    base = raw if carry else narrow
    # targets, and the number of shards of each source
    by_source = targets(narrow.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size")),
                        weights, total, max_repeats)
    by_source = checkpointed(by_source.withColumn("_shards", F.floor((F.col("source_size") - 1) / shard_words) + 1)
                             .withColumn("_shards", F.greatest("_shards", F.lit(1))))
    marked = small(by_source)

    def sharded(df: DataFrame) -> DataFrame:
        out = df.join(marked, df._source.eqNullSafe(marked.source)).drop("source")
        return out.withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed + 1), "_key"), F.col("_shards")))

    cells = (sharded(narrow).groupBy("_source", "_shard")
             .agg(F.sum("_size").alias("_words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
             .withColumn("_blocks", F.when(F.col("_words") > 0, F.greatest(F.round(F.col("_words") / block_words), F.lit(1))
                                           ).otherwise(0).cast("long")))
    cells = checkpointed(cells)
    # quotas: to sources by target in blocks of their own mean size, then to their shards
    quota = (cells.groupBy("_source").agg(F.sum("_blocks").alias("_all_blocks"), F.first("source_size").alias("s"),
                                          F.first("target").alias("t"))
             .withColumn("_votes", F.when(F.col("s") > 0, F.col("t") * F.col("_all_blocks") / F.col("s")).otherwise(0.0))
             .withColumn("_cap", max_repeats * F.col("_all_blocks")))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    quota = quota.withColumn("_seats", F.round(F.sum("_votes").over(everything)).cast("long"))
    quota = apportion(quota, "_votes", "_seats", "_cap", "_source_quota", [], ["_source"])
    quota = quota.select(F.col("_source").alias("q_source"), "_source_quota")
    cells = cells.join(quota, cells._source.eqNullSafe(quota.q_source)).drop("q_source")
    cells = apportion(cells.withColumn("_cap", max_repeats * F.col("_blocks")), "_blocks", "_source_quota", "_cap",
                      "_quota", ["_source"], ["_shard"])
    cells = small(checkpointed(cells.select(F.col("_source").alias("c_source"), F.col("_shard").alias("c_shard"),
                                            "_words", "_blocks", "_quota")))
    # places in the shard, the blocks there, and the words they take
    line = Window.partitionBy("_source", "_shard").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    placed = sharded(base).withColumn("_to", F.sum("_size").over(line)).withColumn("_from", F.col("_to") - F.col("_size"))
    placed = placed.join(cells, placed._source.eqNullSafe(cells.c_source) & (placed._shard == cells.c_shard))
    step = F.element_at(F.array(*[F.lit(p) for p in PRIMES]),
                        (F.pmod(F.xxhash64(F.lit(seed + 2), "_source", "_shard"), F.lit(len(PRIMES))) + 1).cast("int"))
    placed = (placed.withColumn("_step", F.pmod(step, F.greatest("_blocks", F.lit(1))))
              .withColumn("_turn", F.pmod(F.xxhash64(F.lit(seed + 3), "_source", "_shard"), F.greatest("_blocks", F.lit(1))))
              .withColumn("copies", F.when(F.col("_size") > 0, F.floor(F.col("_quota") / F.col("_blocks"))).otherwise(0).cast("long"))
              .withColumn("_more", F.col("_quota") - F.col("copies") * F.col("_blocks")))
    # a block covers [floor(j words / blocks), floor((j + 1) words / blocks))
    spans = F.expr("""
        transform(filter(sequence(((_from + 1) * _blocks - 1) div _words, (_to * _blocks - 1) div _words),
                         j -> pmod(j * _step + _turn, _blocks) < _more),
                  j -> named_struct('from', greatest(_from, (j * _words) div _blocks) - _from,
                                    'to', least(_to, ((j + 1) * _words) div _blocks) - _from))""")
    empty = F.expr("cast(array() as array<struct<from:bigint,to:bigint>>)")
    placed = placed.withColumn("spans", F.when((F.col("_size") > 0) & (F.col("_more") > 0), spans).otherwise(empty))
    taken = F.col("copies") * F.col("_size") + F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.to - s["from"])
    return placed.select(*[F.col(f"`{c}`") for c in carry], F.col("_id").alias(id), F.col("_size").alias("size"),
                         "source_size", "target", taken.alias("taken"), "copies", "spans")


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for every whole copy and one for the spans.

    A row of spans holds the words of its blocks with the white space before each.
    """
    columns = docs.columns
    own = [c for c in columns if c != id]
    packed = docs.select(id, text, source, F.struct(*[F.col(f"`{c}`") for c in own]).alias("_own"))
    found = mix(packed, id, text, source, carry=("_own",), **how)
    whole = F.col("_own").getField(text)
    parts = F.regexp_extract_all(whole, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = let(parts, lambda ws: F.array_join(F.flatten(F.transform("spans", lambda s: F.slice(
        ws, (s["from"] + 1).cast("int"), (s.to - s["from"]).cast("int")))), ""))
    words_in = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.to - s["from"])
    last = F.when(words_in == 0, F.array().cast("array<string>")).when(words_in == F.col("size"), F.array(whole)).otherwise(F.array(cut))
    texts = F.concat(F.array_repeat(whole, F.col("copies").cast("int")), last)
    rows = found.where("taken > 0").withColumn("_text", F.explode(texts))
    return rows.select(*[F.col(f"`{c}`") if c == id else F.col("_text").alias(c) if c == text
                         else F.col("_own").getField(c).alias(c) for c in columns])
