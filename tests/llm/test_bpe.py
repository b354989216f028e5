"""Encoding equals the tokenizers library, and decoding its decode()."""

from __future__ import annotations

import public_tokenizers
import pytest
from hard import CLASHES, empty_documents, hard_documents
from tokenizers import Tokenizer

from costgauge.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "Hello  World's cat123 <|endoftext|>\xe9\xe0\x1cfoo\x85bar İstanbul ΑΣ a<|startoftext|>b <|endof",
    "日本語 テキスト \U0001d518\U0001d52b é ́x ﬁ \xbd Ⅷ \x00 a\x00b ​ \"don't\" I'LL we'Ve",
    "x" * 5_000 + " " + "ab " * 3_000,
    " \n\t   ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("common", [0, 20, 200_000])
def test_round_trip(spark, library, common):
    docs = hard_documents(spark)
    more = [(200 + i, t, "x", "y", 0, *range(len(CLASHES))) for i, t in enumerate(HARD * 2)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    encoded = word_bpe.encode(docs, PATH, common=common)
    decoded = word_bpe.decode(encoded, PATH)
    assert encoded.columns == [c for c in docs.columns if c != "text"] + ["ids"]
    wanted = []
    for row in docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        wanted.append((row.doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    got = [(row.doc_id, row.ids, row.decoded) for row in decoded.collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_decode_odd_ids(spark, library):
    rows = [(1, None), (2, []), (3, [320, 10**6, None, 320])]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = {row.doc_id: row.decoded for row in word_bpe.decode(frame, PATH).collect()}
    assert got == {1: "", 2: "", 3: library.decode([320, 320], skip_special_tokens=False)}


def test_empty(spark):
    assert word_bpe.encode(empty_documents(spark), PATH).count() == 0
