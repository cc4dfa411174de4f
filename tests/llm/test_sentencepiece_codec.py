from __future__ import annotations

import hashlib

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from kinscore.llm.sentencepiece_codec import ChunkTable, default_model, encoded, sentencepiece_codec

SP = sentencepiece.SentencePieceProcessor(model_file=default_model())
TABLE = ChunkTable(default_model(), words=40)

TEXTS = [
    None,
    "",
    " ",
    "   ",
    "a",
    " a",
    "a ",
    "two  blanks   three    four",
    "line\nnext\n\n \n x\t\ty \r\n",
    "▁marked▁▁ word ▁",
    "</s> <s> <unk> <0x0A> [INST]",
    "ﬁ Å Å 　wide\xa0nbsp​ zero ﻿",
    "日本語 テスト 🙂🙂 emoji\U0001f469‍\U0001f4bb",
    "\x00 nul \x01",
    "word " * 3000,
    "x" * 5000,
]


def test_model_allows_the_table():
    assert TABLE.independent


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab  ▁\n\té.,1🙂　"), max_size=40) | st.text(max_size=30))
def test_ids_are_the_librarys(text):
    text = text.encode("utf-8", "ignore").decode()
    assert TABLE.encode([text]) == [SP.encode(text, add_eos=True)]


def test_crossing_models_run_over_whole_texts():
    table = ChunkTable(default_model())
    table.independent = False
    assert table.encode(["a b", ""]) == SP.encode(["a b", ""], add_eos=True)


def test_frame(docs_of):
    rows = [(i, t, "en", "s", 1, "x") for i, t in enumerate(TEXTS + TEXTS[:4])]
    docs = docs_of(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string")
    got = {r.doc_id: r for r in sentencepiece_codec(docs).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        ids = SP.encode(text or "", add_eos=True)
        plain = SP.decode(ids)
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and got[i].decoded == plain
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(plain.encode()).hexdigest()
    out = encoded(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids"]
    assert out.where("doc_id = 4").first().n_chars == 1
    assert encoded(docs.limit(0)).count() == 0


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = sentencepiece_codec(docs, fields=("ids",)).collect()
    assert [r.ids for r in got] == SP.encode([r.text or "" for r in got], add_eos=True)


