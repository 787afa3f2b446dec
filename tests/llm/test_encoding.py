from __future__ import annotations

import os

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snaploom.llm import bpe
from snaploom.llm.encoding import TOKENIZERS, VOCABULARY, token_counts, token_ids

PATH = f"{TOKENIZERS}/{VOCABULARY}"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files here")
CASES = ["", " ", "  ", "a  b", "a \n b", "\n\n  x\n", "don't we've 'something ''s \"'s", "'re're'll'", "x's", "\t's \n's", "  x 　y\x85z\x1cq", "١٢٣ ½ ² abc", "<|endoftext|>", "éá नमस्ते", "🙂🙂 x🙂", "it'S 'LL", "'", "' ", "\r\n\r\n", "漢字かな交じり文です。", "a" * 3000, "ab" * 5000, "﻿​ x"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return bpe.Encoder(f.read())


def ours(encoder, texts):
    ids, at = encoder.words(pa.array(texts, pa.string())).ids()
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_cases_agree_with_the_library(encoder, library):
    assert ours(encoder, [*CASES, None]) == [library(t) for t in CASES] + [[]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t'stremldv.,!0123abAB é漢　 ½"), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=5))
def test_any_texts_agree_with_the_library(encoder, library, texts):
    # the library's tables may know other versions of Unicode: only characters that both know as assigned
    texts = ["".join(c for c in t if ord(c) < 0x3000 or c == "漢") for t in texts]
    assert ours(encoder, texts) == [library(t) for t in texts]


def test_forgetting_changes_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    assert ours(encoder, CASES) == [library(t) for t in CASES]


def test_ids_of_a_table_with_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, None, "k", 1), (2, "", "k", 1), (3, "A permit for 100 Main St.", "k", 1), (3, "A permit for 100 Main St.", "k", 1), (None, "x " * 50_000, "k", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key string, ids int")
    got = sorted(((r.doc_id or 0, r.ids) for r in token_ids(df).collect()), key=lambda r: r[0])
    assert got == [(0, library("x " * 50_000)), (1, []), (2, []), (3, library(rows[2][1])), (3, library(rows[2][1]))]
    counts = {(r.doc_id, r.n_tokens) for r in token_counts(df, ["doc_id"]).collect()}
    assert counts == {(k if k else None, len(v)) for k, v in got}
    assert token_ids(df.limit(0)).count() == 0


def test_decoding_gives_the_text_back(spark):
    t = Tokenizer.from_file(PATH)
    texts = [c for c in CASES if c]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: t.decode(r.ids, skip_special_tokens=False) for r in token_ids(df).collect()} == dict(enumerate(texts))
