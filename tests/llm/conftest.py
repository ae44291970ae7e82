"""Small tables that every training-data operator has to survive."""

import pytest

ODD_TEXTS = [
    None, "", " ", "\n\t", "a", "a", "a  b\n c", "a b c", "<|endoftext|> x", "é漢😀 ÑÑ!!", "\x00 zero", "1234 !!",
    "the of and " * 4000, "x" * 9000, "the of and to is that with for",
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Odd texts, null and repeated ids, repeated rows, extra columns with names
    that operators like to use for themselves."""
    rows = [(i, t, "en", "src0", len(t or ""), -1, "mine") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "a b", None, None, None, None, None), (None, None, None, None, None, None, None), rows[7], (7, "other", "fr", "src1", 5, 0, "m")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, tokens int, _text string"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.filter("doc_id = -1")
