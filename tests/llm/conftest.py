from __future__ import annotations

import pytest

from rillmart.llm.queries import vocabulary

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def word_bpe():
    return vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="session")
def byte_bpe():
    return vocabulary("byte_bpe_50k.json")


#: Null and empty texts, odd white space, special tokens in the text, long words, copies and a null id.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "It's <|endoftext|> ΑΣ Σ İstanbul x\x1cy\x85z q 12345 ...!!'ll 'S"),
    (5, "<|startoftext|><|endoftext|>a  b \n c\n\nd  \te"),
    (6, "日本語テキスト 👩‍👩‍👧 ÀÉ ǅ ﬁ ß ẞ \x00 a\r\nb"),
    (7, "x" * 5000 + " Hello'RE we'll" * 300),
    (8, "The same text twice, the same text."),
    (9, "The same text twice, the same text."),
    (9, "The same text twice, the same text."),
    (None, "a row without an id"),
]


@pytest.fixture
def odd(spark):
    """The odd texts with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en", "s", None, 0.5, "x", 7) for i, t in ODD]
    extra = DOCUMENT + ", score double, ids string, part int"
    return spark.createDataFrame(rows, extra).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)
