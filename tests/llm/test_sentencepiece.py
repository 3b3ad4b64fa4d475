import random

import pytest
import sentencepiece as library
from conftest import SF

from sparley.llm import sentencepiece


@pytest.fixture(scope="module")
def model():
    return library.SentencePieceProcessor(model_file=sentencepiece.MODEL)


def texts_like():
    chance = random.Random(3)
    letters = list(" \n\t abcdefghijklmnopqrstuvwxyz  éñßあ漢字🎉\x00ABC123.,-_()[]{}\"'$%")
    out = ["".join(chance.choice(letters) for _ in range(chance.randint(0, 120))) for _ in range(150)]
    return [*out, "a" * 5000, " " * 700, "x " * 3000, "ab\n" * 900, "", "é", "🎉🎉", "\n\n  \n"]


def test_matches_the_library(spark, model):
    rows = [(k, t) for k, t in enumerate(texts_like())]
    got = sentencepiece.encode(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in got.collect():
        assert r["piece_ids"] == model.encode(rows[r["doc_id"]][1]) and r["round_trip"] and r["n_pieces"] == len(r["piece_ids"])


def test_matches_the_library_on_documents(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["piece_ids"] for r in sentencepiece.encode(docs).collect()} == {k: model.encode(t) for k, t in texts.items()}


def test_edge_cases_and_round_trip(spark):
    rows = [(1, None, "s"), (2, "", "s"), (2, "", "s"), (None, "a▁b ▁ c", None), (4, "x" * 30_000, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string")
    got = sentencepiece.encode(docs)
    assert got.count() == 5 and got.filter("NOT round_trip").count() == 0
    back = {(r["doc_id"], r["text"]) for r in sentencepiece.decode(got).collect()}
    assert back == {(1, ""), (2, ""), (None, "a▁b ▁ c"), (4, "x" * 30_000)}
    assert sentencepiece.encode(docs.limit(0)).count() == 0


def test_suffix_ranges_find_every_occurrence(model):
    import numpy as np

    pieces = sentencepiece.load()
    text = "the thethe other theory bathe"
    codes = np.array([ord(c) for c in text], np.int64)
    order = sentencepiece.suffix_array(codes, pieces.chars.shape[1])
    rows, low, high = sentencepiece.find_pieces(codes, order, pieces)
    for row, a, b in zip(rows, low, high, strict=True):
        piece = pieces.text[pieces.ids[row]]
        assert sorted(order[a:b].tolist()) == [k for k in range(len(text)) if text.startswith(piece, k)]
