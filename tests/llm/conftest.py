import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def words():
    return lambda t: WORDS.findall(t or "")


class Groups:
    """Union by smallest member, for brute force."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def root(self, a):
        while self.up[a] != a:
            a = self.up[a]
        return a

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


@pytest.fixture(scope="session")
def groups():
    return Groups


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeats, ties and columns with clashing names."""
    texts = [None, "", " \n\t", "one", "a b", "a b c", "same text here and there", "same text here and there",
             "x " * 5000, "é ñ 𝛂 " * 50, "line one here\nline one here\nline two", "<|im_end|>", "\\<|x|>", "Ea " * 300]
    rows = [(i, t, None if i % 4 == 3 else f"s{i % 3}", "keep me", i) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, "no id", None, "k", 0), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, quality string, size long")

