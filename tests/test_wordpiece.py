from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lexloom.functions.text import ws_tokens
from lexloom.operators.wordpiece import PieceTrie, piece_trie, wordpieces


def plain(word: str, vocab: set[str]) -> list[str]:
    at, out = 0, []
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in vocab:
                break
        else:
            return ["[UNK]"]
        out.append(piece)
        at = end
    return out


def test_the_classic_example():
    trie = PieceTrie(["a", "abcd", "##b", "##bc", "##z"])
    assert trie.split("abcz") == ["a", "##bc", "##z"]
    assert trie.split("abcd") == ["abcd"]
    assert trie.split("abcq") == ["[UNK]"] and trie.split("abc") == ["a", "##bc"] and trie.split("c") == ["[UNK]"]


@pytest.mark.parametrize("seed", range(30))
def test_every_word_splits_as_by_plain_search(seed):
    rng = random.Random(seed)
    letters = "abc" if seed % 2 else "abcdeé東#"
    vocab = {"".join(rng.choices(letters, k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 40))}
    vocab |= {"##" + "".join(rng.choices(letters, k=rng.randrange(1, 6))) for _ in range(rng.randrange(0, 60))}
    trie = PieceTrie(vocab)
    # a word that begins with the mark is read as the vocabulary's own piece would be
    for _ in range(300):
        word = "".join(rng.choices(letters, k=rng.randrange(1, 14)))
        if not word.startswith("##"):
            assert trie.split(word) == plain(word, vocab - {p for p in vocab if p == "##"} | ({"##"} & vocab)), (word, vocab)


def test_many_children_and_many_pieces():
    rng = random.Random(1)
    vocab = {chr(0x4E00 + rng.randrange(3000)) + chr(97 + rng.randrange(26)) for _ in range(4000)} | {"##" + chr(97 + k) for k in range(26)}
    trie = PieceTrie(vocab)
    for piece in sorted(vocab)[:2000]:
        if not piece.startswith("##"):
            assert trie.split(piece) == [piece] and trie.split(piece + "q") == [piece, "##q"]


def test_columns_and_edges(spark):
    vocab = spark.createDataFrame([("un",), ("##aff",), ("##able",), (None,), ("un",)], "piece string")
    trie = piece_trie(vocab)
    docs = spark.createDataFrame([(1, "unaffable un"), (2, ""), (3, None), (4, "x unable")], "k int, text string")
    got = {r["k"]: r["p"] for r in docs.select("k", wordpieces(ws_tokens("text"), trie).alias("p")).collect()}
    assert got[1] == ["un", "##aff", "##able", "un"] and not got[2] and not got[3] and got[4] == ["[UNK]", "un", "##able"]
    with pytest.raises(ValueError):
        piece_trie(vocab, most=2)
    assert PieceTrie([]).split("a") == ["[UNK]"] and PieceTrie(["a"]).split("") in ([], ["[UNK]"])
