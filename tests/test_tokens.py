from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexloom.functions.text import mark_leading_space, ws_tokens
from lexloom.operators import tokens as tk

TEXTS = ["Hello World", "Goodbye Moon and Sun", "", "Hello [CLS] Moon", "   "]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")


@pytest.fixture(scope="module")
def vocab(docs):
    return tk.build_vocab(docs, size=10).cache()


def test_vocab_order_and_specials(vocab):
    rows = [(r["id"], r["token"], r["n"]) for r in vocab.orderBy("id").collect()]
    assert [r[1] for r in rows[:4]] == tk.SPECIALS and [r[0] for r in rows] == list(range(len(rows)))
    assert [r[1] for r in rows[4:]] == ["Hello", "Moon", "Goodbye", "Sun", "World", "and"]


def test_vocab_size_and_min_count(docs):
    assert tk.build_vocab(docs, size=1).count() == 5
    assert tk.build_vocab(docs, size=10, min_count=2).count() == 6


@pytest.mark.parametrize("most", [3, tk.SENT_VOCAB])
def test_encode_decode_round_trip(docs, vocab, most):
    encoded = tk.encode(docs, vocab, most=most).cache()
    ids = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert ids[0] == [2, 4, 8, 3] and ids[2] == [2, 3] and ids[4] == [2, 3]
    assert ids[3] == [2, 4, 2, 5, 3]
    back = {r["doc_id"]: r["text"] for r in tk.decode(encoded, vocab, most=most).collect()}
    for i in (0, 1, 2, 4):
        assert back[i] == " ".join(TEXTS[i].split())
    whole = {r["doc_id"]: r["text"] for r in tk.decode(encoded, vocab, skip_special=False, most=most).collect()}
    assert whole[0] == "[CLS] Hello World [SEP]"


def test_unknown_tokens_and_ids(spark, docs, vocab):
    other = spark.createDataFrame([(9, "Hello Mars")], "doc_id int, text string")
    encoded = tk.encode(other, vocab)
    assert encoded.first()["ids"] == [2, 4, 1, 3]
    assert tk.decode(encoded, vocab).first()["text"] == "Hello [UNK]"
    rows = spark.createDataFrame([(0, 4), (1, 999)], "pos int, id int")
    got = {r["pos"]: r["token"] for r in tk.lookup_tokens(rows, vocab).collect()}
    assert got == {0: "Hello", 1: "[UNK]"}


def test_padding_and_mask(docs, vocab):
    encoded = tk.encode(docs.filter("doc_id < 2"), vocab).withColumn("batch", F.lit(1))
    rows = {r["doc_id"]: r for r in tk.pad_batch(encoded, "batch").collect()}
    assert rows[0]["ids"] == [2, 4, 8, 3, 0, 0] and rows[0]["mask"] == [1, 1, 1, 1, 0, 0]
    assert 0 not in rows[1]["mask"]


def test_find_token_forms(spark):
    frame = spark.createDataFrame([(0, "dog the dog dogs Dog"), (1, "cat")], "doc_id int, text string")
    rows = tk.find_token(frame, mark_leading_space(ws_tokens("text")), ["dog"]).collect()
    assert sorted(tuple(r) for r in rows) == [(0, 0, "dog"), (0, 2, "dog")]
    assert tk.find_token(frame, ws_tokens("text"), ["mouse"]).count() == 0


def test_breakdown(docs):
    rows = tk.token_breakdown(docs, ws_tokens("text")).filter("doc_id = 0").orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [(0, 0, "Hello"), (0, 1, "World")]


def test_tokenizer_report(spark):
    frame = spark.createDataFrame([(0, "Ab ab\nc"), (1, "ab")], "doc_id int, text string")
    rows = {r["variant"]: r for r in tk.tokenizer_report(frame, extra={"twice": F.array(F.lit("x"))}).collect()}
    assert rows["whitespace"]["tokens"] == 4 and rows["whitespace"]["distinct_tokens"] == 3
    assert rows["whitespace"]["unknown_rate"] == 0.5 and rows["whitespace"]["tokens_per_doc"] == 2.0
    assert rows["lower letters"]["distinct_tokens"] == 2
    assert rows["character"]["tokens"] == 9
    assert rows["twice"]["vocab_size"] == 1
