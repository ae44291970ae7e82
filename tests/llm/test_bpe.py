import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from ontime.llm.bpe import Trie, Vocabulary, decode_documents, encode_documents, read_vocabulary
from ontime.llm.queries import QUERIES, VOCABULARY


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(trie, text):
    return np.frombuffer(trie.encode(text), "<u4").tolist()


def test_random_texts_match_the_library(library):
    trie = Trie(Vocabulary(*read_vocabulary(VOCABULARY)), max_words=500)
    random.seed(1)
    letters = "aab bcé漢😀 \n\t  .,!!<|endoftext|>'s've1239՘Ᲊ꟎\u0085　 thehanerinon"
    for i in range(3000):
        text = "".join(random.choice(letters) for _ in range(random.randrange(40))) + "<|endoftext|>" * (i % 7 == 0)
        assert ids_of(trie, text) == library.encode(text, add_special_tokens=False).ids, repr(text)
    for _ in range(500):
        text = "".join(random.choice("a-= Ãé") * random.randrange(1, 30) for _ in range(6))
        assert ids_of(trie, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_query_against_the_library(spark, sf_dir, library):
    documents = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op8_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        ids = library.encode(documents[r["doc_id"]], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(odd_documents, no_documents, library):
    out = decode_documents(encode_documents(odd_documents, VOCABULARY), VOCABULARY)
    rows = out.collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "")
    assert encode_documents(no_documents, VOCABULARY).count() == 0
    with pytest.raises(ValueError, match="tokens"):
        encode_documents(odd_documents, VOCABULARY, ids="tokens")


def test_ids_outside_the_vocabulary(spark):
    df = spark.createDataFrame([(1, [0, 60000, None, 1]), (2, None), (3, [])], "k int, ids array<int>")
    assert {r["k"]: r["decoded"] for r in decode_documents(df, VOCABULARY).collect()} == {1: '!"', 2: "", 3: ""}
