from __future__ import annotations

import random
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tideglass.llm.encode import TOKENIZER, encode_documents, encoder, token_counts

pytestmark = pytest.mark.skipif(not Path(TOKENIZER).exists(), reason="no tokenizer file")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_equals_library_on_any_text(library):
    code = encoder(TOKENIZER)

    @settings(max_examples=300, deadline=None)
    @given(st.text(max_size=80))
    def check(text):
        assert list(code.encode(text)) == library(text)

    check()


def test_equals_library_on_mixed_and_long_pieces(library):
    code, r = encoder(TOKENIZER), random.Random(5)
    bits = ["a", "the", " ", "\n", "é", "日本", "😀", "0", "12", "'s", "ing", "ation", "==", "\t", "xx", "aaaa", "<|endoftext|>", " ", "\x00"]
    for _ in range(2000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert list(code.encode(text)) == library(text)
    for text in ("a" * 50_000, "".join(r.choice("abcdeghilmnorst") for _ in range(30_000)), "=" * 9_999, "日" * 5_000):
        assert list(code.encode(text)) == library(text)


def test_kept_pieces_change_nothing(library, monkeypatch):
    from tideglass.llm import encode

    monkeypatch.setattr(encode, "KEPT_PIECES", 3)
    code = encode.PrefixEncoder(TOKENIZER)
    text = "one two three four five six seven one two three " * 20
    assert list(code.encode(text)) == library(text) and len(code) <= 3


def test_null_empty_and_extra_columns(spark, library):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, " \n", 9), (4, "Hello  world", 9), (4, "Hello  world", 9)], "doc_id bigint, text string, ids int")
    got = sorted((r.doc_id, list(r.ids)) for r in encode_documents(df).collect())
    assert got == [(1, []), (2, []), (3, library(" \n")), (4, library("Hello  world")), (4, library("Hello  world"))]
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts(df).collect()) == [(k, len(v)) for k, v in got]
    assert encode_documents(df.limit(0)).collect() == []


def test_documents(spark, small, library):
    from tideglass.llm.queries import p8_ids
    from tideglass.sources.tables import table

    texts = {r.doc_id: r.text for r in table(spark, small, "documents").collect()}
    assert {r.doc_id: list(r.ids) for r in p8_ids(spark, small).collect()} == {k: library(v or "") for k, v in texts.items()}
