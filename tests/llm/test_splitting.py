from __future__ import annotations

import os

import pytest
from tokenizers import Tokenizer

from snaploom.llm.encoding import TOKENIZERS, VOCABULARY
from snaploom.llm.splitting import pieces

PATH = f"{TOKENIZERS}/{VOCABULARY}"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files here")
TEXTS = {
    1: "First paragraph about permits. It has two sentences.\n\nSecond paragraph, rather longer, about units and houses and parcels in the county.\nA line.\n\nThird.",
    2: "x" * 3000,
    3: "漢字かな交じり文です。" * 40,
    4: "one two three " * 200,
    5: None,
    6: "",
    7: "   \n " * 300,
    8: "🙂" * 200,
    9: "short",
    10: "a.b.c!d?e" * 100,
    11: "Sentence one. " * 100,
}


def test_limits_overlap_cover_and_boundaries(spark):
    t = Tokenizer.from_file(PATH)
    count = lambda s: len(t.encode(s, add_special_tokens=False).ids)
    docs = spark.createDataFrame([(k, v, "s", 1, "x") for k, v in TEXTS.items()] + [(20, TEXTS[4], "unlimited", 1, "x"), (21, TEXTS[4], None, 1, "x"), (4, TEXTS[4], "s", 1, "x")], "doc_id bigint, text string, source string, piece_no int, boundary string")
    limits = spark.createDataFrame([("s", 20, 5), ("s", 20, 5), (None, 5, 1), ("null", None, None)], "source_name string, max_tokens int, overlap_tokens int")
    got = {}
    for r in pieces(docs, limits).distinct().collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got.keys() == {k for k, v in TEXTS.items() if v and count(v) > 20}
    for k, rows in got.items():
        rows.sort(key=lambda r: r.piece_no)
        assert [r.piece_no for r in rows] == list(range(len(rows)))
        assert rows[0].start_char == 0 and rows[-1].end_char == len(TEXTS[k]) and rows[-1].boundary == "end"
        for a, b in zip(rows, rows[1:]):
            assert b.start_token <= a.end_token - 5 and b.end_token > a.end_token and b.start_char <= a.end_char
        for r in rows:
            assert r.piece == TEXTS[k][r.start_char : r.end_char] and count(r.piece) <= 20 and r.end_token - r.start_token <= 20
    assert {r.boundary for r in got[2]} == {"hard", "end"}
    assert {r.boundary for r in got[11]} == {"sentence", "end"}
    assert {r.boundary for r in got[3]} == {"sentence", "end"} or "hard" in {r.boundary for r in got[3]}
    assert got[1][0].piece.endswith("\n\n")


def test_empty_table_and_tiny_limits(spark):
    docs = spark.createDataFrame([(1, "🙂🙂 abc", "s")], "doc_id bigint, text string, source string")
    for limit in (0, 1, 2):
        limits = spark.createDataFrame([("s", limit, 9)], "source_name string, max_tokens int, overlap_tokens int")
        rows = sorted(pieces(docs, limits).collect(), key=lambda r: r.piece_no)
        assert "".join(r.piece for r in rows) == ("" if limit == 0 else "🙂🙂 abc")
    assert pieces(docs.limit(0), limits).count() == 0


def test_overlaps_of_half_the_limit_or_more_are_kept(spark):
    t = Tokenizer.from_file(PATH)
    count = lambda s: len(t.encode(s, add_special_tokens=False).ids)
    for limit, overlap in ((20, 10), (20, 15), (8, 7)):
        docs = spark.createDataFrame([(k, TEXTS[k][:400], "s") for k in (2, 3, 4, 8, 10, 11)], "doc_id bigint, text string, source string")
        limits = spark.createDataFrame([("s", limit, overlap)], "source_name string, max_tokens int, overlap_tokens int")
        got = {}
        for r in pieces(docs, limits).collect():
            got.setdefault(r.doc_id, []).append(r)
        for k, rows in got.items():
            rows.sort(key=lambda r: r.piece_no)
            assert rows[0].start_char == 0 and rows[-1].end_char == len(TEXTS[k][:400])
            for a, b in zip(rows, rows[1:]):
                assert a.end_token < b.end_token and a.start_token < b.start_token and b.start_char <= a.end_char
            assert all(count(r.piece) <= limit for r in rows)
        for k in (4, 11):  # all tokens are whole words or end at characters
            assert {a.end_token - b.start_token for a, b in zip(got[k], got[k][1:])} == {overlap}
