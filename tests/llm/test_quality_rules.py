import random
from collections import Counter

import pyarrow as pa
from tidewatch.llm import quality_rules as Q


def brute(text, words, lengths):
    text = text or ""
    found = words(text)
    seen, lines, chars = set(), 0, 0
    for line in text.split("\n"):
        if words(line):
            if line in seen:
                lines += 1
                chars += sum(map(len, words(line)))
            seen.add(line)
    inside, stretches, repeat = [], [], 0
    for k in lengths:
        grams = [tuple(found[i:i + k]) for i in range(len(found) - k + 1)]
        counts = Counter(grams)
        cover = {i + j for i, g in enumerate(grams) if counts[g] > 1 for j in range(k)}
        inside.append(sum(len(found[i]) for i in cover))
        stretches.append(sum(i - 1 not in cover for i in cover))
        repeat = len(cover) if k == 5 else repeat
    return {"n_words": len(found), "word_chars": sum(map(len, found)), "n_symbols": sum(c in Q.SYMBOLS for c in text),
            "n_dup_lines": lines, "n_repeat_words": repeat, "dup_line_chars": chars, "dup_ngram_chars": inside,
            "dup_ngram_stretches": stretches}


def kept_by_hand(b):
    """The verdict on brute-force measures."""
    within = [c <= limit * b["word_chars"] or (k >= 5 and s < Q.MIN_STRETCHES)
              for (k, limit), c, s in zip(Q.NGRAM_LIMITS.items(), b["dup_ngram_chars"], b["dup_ngram_stretches"])]
    return (b["n_words"] >= 10 and 100 * b["n_repeat_words"] <= 20 * b["n_words"] and all(within)
            and b["dup_line_chars"] <= Q.LINE_LIMIT * b["word_chars"] and b["n_symbols"] <= Q.SYMBOLS_PER_WORD * b["n_words"])


def test_measures_equal_brute_force(words):
    random.seed(1)
    parts = ["a", "b", " ", "\n", "é", "#", "\t", "ab ", "\x0b", "𝛂", " ", "a b a b "]
    texts = [None, "", "\n", "a\n", "\na", "a\n\na", "x " * 30, "é ñ a\n" * 5]
    texts += ["".join(random.choice(parts) for _ in range(random.randint(0, 80))) for _ in range(1500)]
    got = Q.measures(pa.array(texts), (3, 5, 6, 7)).to_pylist()
    assert got == [brute(t, words, (3, 5, 6, 7)) for t in texts]


def thue_morse(n, one, two):
    return "".join(one if bin(i).count("1") % 2 == 0 else two for i in range(n))


def test_pieces_that_collide_in_polynomial_hashes(words):
    """Thue-Morse words and their complements have equal polynomial hashes modulo a power of two."""
    texts = []
    for n in (1024, 2048, 4096):
        a, b = thue_morse(n, "a", "b"), thue_morse(n, "b", "a")
        texts += [f"{a}\n{b}", f"{a} x y z u {b} x y z u", f"{a}\n{b}\n{a}"]
        texts += [" ".join(a) + "\n" + " ".join(b)]
    texts.append("w" * 5000 + "\n" + "w" * 5001 + "\n" + "w" * 5000)
    got = Q.measures(pa.array(texts), (3, 5, 6, 7)).to_pylist()
    assert got == [brute(t, words, (3, 5, 6, 7)) for t in texts]
    assert got[0]["n_dup_lines"] == 0 and got[2]["n_dup_lines"] == 1


def test_sliced_and_empty_arrays(words):
    texts = ["skip", "a b c d e f a b c d e", None, "q"]
    whole = Q.measures(pa.array(texts), (5,)).to_pylist()
    assert Q.measures(pa.array(texts).slice(1), (5,)).to_pylist() == whole[1:]
    assert Q.measures(pa.array([], pa.string()), (5,)).to_pylist() == []


def test_operator_keeps_rows_and_clashing_columns(odd_documents, words):
    out = Q.judged(odd_documents)                          # 'quality' is replaced, 'size' stays
    assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    for r in out.collect():
        b = brute(r.text, words, tuple(Q.NGRAM_LIMITS))
        q = r.quality.asDict()
        assert {k: q[k] for k in b} == b
        failed = b["n_words"] < 10 or 100 * b["n_repeat_words"] > 20 * b["n_words"]
        assert q["base_failed"] == failed and q["kept"] == kept_by_hand(b)
    assert Q.judged(odd_documents.limit(0)).count() == 0


def test_verdict_on_clean_and_junk(spark):
    clean = " ".join(f"word{i} and" if i % 3 else f"other{i}." for i in range(200))
    junk = " ".join(f"w{i}###" for i in range(200))
    lines = "\n".join(["the same line of seven words here now"] * 3 + [f"line number {i} says x{i} y{i}" for i in range(8)])
    df = spark.createDataFrame([(1, clean), (2, junk), (3, "few words"), (4, lines)], "doc_id long, text string")
    kept = {r.doc_id for r in Q.keep_good(df).collect()}
    assert kept & {1, 2, 3} == {1}
    assert Q.keep_good(df).columns == df.columns


def twice_said(k, share, words=20_000):
    """Distinct words, but for passages of ``k`` words said twice each, apart, on ``share`` of all words."""
    passages = round(share * words / (2 * k))
    fresh = iter(range(10 ** 6))
    new = lambda n: [f"w{next(fresh):06d}" for _ in range(n)]
    said = [new(k) for _ in range(passages)]
    between = (words - 2 * k * passages) // (2 * passages)
    out = [w for p in said + said for w in p + new(between)]
    return " ".join(out + new(words - len(out)))


def test_every_length_decides_alone(spark):
    """Per length a text that only this length's limit rejects: limits loosened in turn, and the text just below it."""
    lengths = [k for k in Q.NGRAM_LIMITS if k >= 5]
    rows = [(k, over, twice_said(k, Q.NGRAM_LIMITS[k] + (0.006 if over else -0.006))) for k in lengths for over in (True, False)]
    docs = spark.createDataFrame(rows, "k int, over boolean, text string")
    verdicts = {(r.k, r.over): r.quality for r in Q.judged(docs).collect()}
    assert all(v.kept != over and not v.base_failed for (_, over), v in verdicts.items())
    for k in lengths:
        loose = Q.judged(docs.where((docs.k == k) & docs.over), ngram_limits={**Q.NGRAM_LIMITS, k: 1.0})
        assert loose.first().quality.kept


def test_lines_and_three_grams_decide_alone(spark):
    lines = [f"a{i} b{i} c{i}" for i in range(12)]
    fresh = [f"x{i} y{i} z{i}" for i in range(24)]
    text = "\n".join(f for i in range(24) for f in (lines[i % 12], fresh[i]))
    triples = [f"p{i} q{i} r{i}" for i in range(40)]
    three = " ".join(triples + [t for i in range(40) for t in (triples[(7 * i) % 40], *([f"n{i}"] if i % 2 else []))])
    docs = spark.createDataFrame([(1, text), (2, three)], "doc_id int, text string")
    assert [r.quality.base_failed for r in Q.judged(docs).collect()] == [False, False]
    assert not any(r.quality.kept for r in Q.judged(docs).collect())
    assert Q.judged(docs.where("doc_id = 1"), line_limit=1.0).first().quality.kept
    assert Q.judged(docs.where("doc_id = 2"), ngram_limits={**Q.NGRAM_LIMITS, 3: 1.0}).first().quality.kept


def test_one_passage_said_again_is_no_reason(spark):
    """One passage of a tenth of the text said twice stays; four passages of the same share in all do not."""
    new = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    once = " ".join([new(0, 36), new(100, 300), new(0, 36), new(300, 400)])
    apart = " ".join(new(9 * i, 9 * i + 9) + " " + new(100 + 40 * j + 10 * i, 110 + 40 * j + 10 * i) for j in range(6) for i in range(4)
                     if j in (0, 3)) + " " + new(400, 630)
    docs = spark.createDataFrame([(1, once), (2, apart)], "doc_id int, text string")
    got = {r.doc_id: r.quality for r in Q.judged(docs).collect()}
    assert got[1].kept and not got[2].kept and not got[2].base_failed


def test_lines_and_words_of_many_characters(spark, words):
    """Lines and words above 1,000 and 100,000 characters, in texts that share their beginnings."""
    long = "v" * 100_000
    texts = [f"{long}a\n{long}b\n{long}a", f"{long} {long}b {long}", "\n".join(["ab " * 700] * 2 + ["ab " * 699 + "ac"])]
    lengths = tuple(Q.NGRAM_LIMITS)
    assert Q.measures(pa.array(texts), lengths).to_pylist() == [brute(t, words, lengths) for t in texts]
