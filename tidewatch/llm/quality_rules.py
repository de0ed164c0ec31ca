"""Repetition rules: how much of a text sits inside repeated n-grams and lines.

Words and lines become exact ids; rolling hashes of n-grams of word ids (several lengths, from
one running sum) find what a text repeats; the rules measure the characters inside it.
The work is one Arrow UDF over the text column: no shuffle, whole texts, and
memory bounded by one slice of a batch (see ``common.SLICE_BYTES``).

Defined cases: a null or empty text has no words, all measures are 0 and it
fails the base rules; equal rows get equal results; other columns, whatever
their names, are untouched; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import Rolling, byte_slices, free_name, mixed, piece_ids, repeated, word_spans

SYMBOLS = "#*$%&|<>"
#: Largest kept share of a text's word characters inside repeated n-grams, by n. From 5 on the
#: lengths and shares of published repetition filters (Rae et al. 2021, table A1): the share
#: inside n-grams falls with n, so only falling limits let every length decide. 3 finds words
#: repeated a few times each.
NGRAM_LIMITS = {3: 0.75, 5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: The limits from 5 on bind where this many separate stretches of the text are inside repeated
#: n-grams. A text of any length that says one passage twice or three times has fewer.
MIN_STRETCHES = 4
LINE_LIMIT = 0.20                  # of word characters, inside lines equal to an earlier line (same table)
SYMBOLS_PER_WORD = 0.10
BASE_WORDS, BASE_REPEAT_PERCENT, BASE_WINDOW = 10, 20, 5

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "dup_line_chars long, dup_ngram_chars array<long>, dup_ngram_stretches array<long>")


def measures(texts: pa.Array, lengths: tuple[int, ...]) -> pa.Array:
    """Struct array of ``MEASURES`` for an Arrow string array; ``lengths`` ascend and hold 5."""
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS.encode())] = True
    columns = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")}
    spans, stretches = [], []
    for _, _, data, offs in byte_slices(texts):
        n = len(offs) - 1
        starts, ends, doc = word_spans(data, offs)
        per_doc = lambda x, of=doc, n=n: np.bincount(of, x, n).astype(np.int64)
        # code points up to each byte: every byte that does not continue one
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        chars = points[ends] - points[starts]
        symbols = np.zeros(len(data) + 1, np.int64)
        np.cumsum(is_symbol[data], out=symbols[1:])
        salt = mixed(np.arange(1, n + 1, dtype=np.uint64))          # repeats count within a text only

        # lines: cut at text ends and line feeds; at one place the end comes before the next text's feed
        feeds = np.flatnonzero(data == 10)
        cuts = np.sort(np.concatenate([2 * offs[1:], 2 * feeds + 1]))
        line_ends = cuts >> 1
        line_starts = np.concatenate([[0], ((cuts + 1) >> 1)[:-1]])
        line_doc = np.searchsorted(offs, line_starts, "right") - 1
        words_to = np.searchsorted(starts, line_ends, "left")
        words_from = np.searchsorted(starts, line_starts, "left")
        with_word = (line_starts < line_ends) & (words_to > words_from)
        line_starts, line_ends, line_doc = line_starts[with_word], line_ends[with_word], line_doc[with_word]
        words_from, words_to = words_from[with_word], words_to[with_word]
        _, later = repeated(piece_ids(data, line_starts, line_ends).astype(np.int64) * n + line_doc)
        char_sums = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(chars, out=char_sums[1:])
        line_chars = (char_sums[words_to] - char_sums[words_from]) * later

        # n-grams: a longer one can only repeat where the shorter one at its start does
        grams = Rolling(mixed(piece_ids(data, starts, ends).astype(np.uint64) + np.uint64(1)))
        at = np.arange(len(starts))
        covered = []
        for k in lengths:
            at = at[at + k <= len(starts)]
            at = at[doc[at + k - 1] == doc[at]]
            twice, _ = repeated(grams.of(at, at + k) ^ salt[doc[at]])
            at = at[twice]
            marks = np.zeros(len(starts) + 1, np.int32)
            np.add.at(marks, at, 1)
            np.subtract.at(marks, at + k, 1)
            covered.append(np.cumsum(marks[:-1]) > 0)
        columns["n_words"].append(np.bincount(doc, minlength=n))
        columns["word_chars"].append(per_doc(chars))
        columns["n_symbols"].append(symbols[offs[1:]] - symbols[offs[:-1]])
        columns["n_dup_lines"].append(np.bincount(line_doc, later, n).astype(np.int64))
        columns["dup_line_chars"].append(np.bincount(line_doc, line_chars, n).astype(np.int64))
        columns["n_repeat_words"].append(per_doc(covered[lengths.index(BASE_WINDOW)]))
        spans.append(np.stack([per_doc(c * chars) for c in covered], 1))
        goes_on = np.zeros(len(starts), bool)                       # the word before is of the same text
        goes_on[1:] = doc[1:] == doc[:-1]
        stretches.append(np.stack([per_doc(c & ~(goes_on & np.roll(c, 1))) for c in covered], 1))
    flat = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in columns.items()}
    arrays = [pa.array(v, pa.int64()) for v in flat.values()]
    ends_of = pa.array(np.arange(len(flat["n_words"]) + 1) * len(lengths), pa.int32())
    for by_length in (spans, stretches):
        values = np.concatenate(by_length).ravel() if by_length else np.zeros(0, np.int64)
        arrays.append(pa.ListArray.from_arrays(ends_of, pa.array(values, pa.int64())))
    return pa.StructArray.from_arrays(arrays, [*flat, "dup_ngram_chars", "dup_ngram_stretches"])


def judged(docs: DataFrame, text: str = "text", into: str = "quality",
           ngram_limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT,
           symbols_per_word: float = SYMBOLS_PER_WORD, min_stretches: int = MIN_STRETCHES) -> DataFrame:
    """``docs`` with one struct column ``into``: the measures, ``base_failed`` and ``kept``.

    The verdict keeps a text that passes the base rules, whose share of word
    characters inside repeated n-grams is at most the limit of every length (of
    5 words and more: unless these n-grams cover fewer than ``min_stretches`` separate
    stretches of the text), inside repeated lines at most ``line_limit``, and which has at
    most ``symbols_per_word`` symbols a word.  A column named ``into`` is replaced.
    """
    lengths = tuple(sorted(ngram_limits))
    if BASE_WINDOW not in lengths:
        raise ValueError(f"the n-gram lengths must hold {BASE_WINDOW}")

    def run(texts: pa.Array) -> pa.Array:
        return measures(texts, lengths)

    m = F.arrow_udf(run, MEASURES)(F.col(text).cast("string"))
    out = docs.withColumn(into, m)
    q = F.col(into)
    failed = (q.n_words < BASE_WORDS) | (100 * q.n_repeat_words > BASE_REPEAT_PERCENT * q.n_words)
    good = (q.dup_line_chars <= line_limit * q.word_chars) & (q.n_symbols <= symbols_per_word * q.n_words)
    for i, k in enumerate(lengths):
        within = q.dup_ngram_chars[i] <= ngram_limits[k] * q.word_chars
        good &= within | (q.dup_ngram_stretches[i] < min_stretches) if k >= BASE_WINDOW else within
    return out.withColumn(into, q.withField("base_failed", failed).withField("kept", ~failed & good))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its own columns."""
    name = free_name(docs, "_quality")
    return judged(docs, text, name).where(F.col(f"{name}.kept")).drop(name)
