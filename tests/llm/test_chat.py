import hashlib
import random

import pytest
from tidewatch.llm import chat


def brute(rows):
    def key(r):
        return tuple((v is not None, v.encode() if isinstance(v, str) else v or 0) for v in r)

    turns = {}
    for conv, turn, role, text in sorted(rows, key=key):
        turns.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, ts in turns.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        out[conv] = (len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part_bytes", [1, 100, 1 << 20])
def test_round_trip_of_hostile_texts(spark, part_bytes):
    random.seed(2)
    bits = ["<", "|", "\\", "<|im_end|>", "<|im_start|>", "\n", "é", "assistant", "a", "<\\|", "𝛂", ""]
    rows = [(random.choice([None, 1, 2, 3]), random.choice([None, 0, 1, 2, 2]),
             random.choice(["assistant", "user", None, "a\\n\n", "<|x"]),
             random.choice([None, "".join(random.choices(bits, k=random.randint(0, 9)))])) for _ in range(800)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")
    parts = chat.formatted(df, part_bytes=part_bytes)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(parts).collect()}
    assert got == brute(rows)
    for r in parts.limit(50).collect():
        # control strings stand at turns' edges only
        assert r.text.count(chat.OPEN) == r.text.count(chat.CLOSE + "\n")
        assert "<|" not in r.text.replace(chat.OPEN, "").replace(chat.CLOSE, "")


def test_lengths_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", None)], "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.formatted(df)).first()
    assert r.formatted_chars == len("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n") and r.loss_chars == 0
    assert chat.read_back(chat.formatted(df.limit(0))).collect() == []


def test_one_hot_conversation_in_parts(spark):
    rows = [(5, i, "assistant" if i % 2 else "user", f"turn {i} " * 20) for i in range(3000)]
    parts = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), part_bytes=5000)
    assert parts.selectExpr("max(length(text))").first()[0] < 10000
    r = chat.read_back(parts).collect()
    assert len(r) == 1 and tuple(r[0])[1:5] == brute(rows)[5]
