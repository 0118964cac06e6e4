from __future__ import annotations

import random
from collections import Counter

import pytest

from lexloom.operators import subwords as sw


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")


def learn_plainly(texts, n_merges):
    """Greedy merges in plain Python."""
    words = Counter(w for t in texts for w in t.split())
    parts = {w: list(w) for w in words}
    merges = []
    for _ in range(n_merges):
        pairs = Counter()
        for w, n in words.items():
            for pair in zip(parts[w], parts[w][1:]):
                pairs[pair] += n
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append((*best, pairs[best]))
        for w, symbols in parts.items():
            out, i = [], 0
            while i < len(symbols):
                if tuple(symbols[i : i + 2]) == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            parts[w] = out
    return merges


def test_first_merge_and_ties(spark):
    merges = sw.learn_subwords(frame(spark, ["low low low lower newest widest"]), 2)
    assert merges[0] == ("l", "o", 4) and merges[1] == ("lo", "w", 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_match_plain_python(spark, seed):
    rnd = random.Random(seed)
    texts = [" ".join("".join(rnd.choice("ab$\\.é") for _ in range(rnd.randint(1, 7))) for _ in range(12)) for _ in range(6)]
    texts.append("aaaa aaaaa baaab")
    assert sw.learn_subwords(frame(spark, texts), 10, checkpoint_every=3) == learn_plainly(texts, 10)


def test_runs_out_of_pairs(spark):
    assert sw.learn_subwords(frame(spark, ["ab"]), 5) == [("a", "b", 1)]


def test_pieces_make_up_the_word(spark):
    texts = ["lower newest widest lowest", "", "zebra low"]
    docs = frame(spark, texts)
    merges = sw.learn_subwords(docs, 4)
    got = {r["doc_id"]: r["pieces"] for r in sw.apply_subwords(docs, merges).collect()}
    for i, text in enumerate(texts):
        assert "".join(got[i]) == "".join(text.split())
    assert got[2][-1] == "low"


def test_split_word_takes_earliest_merge_first():
    rank = {("b", "c"): 0, ("a", "b"): 1, ("a", "bc"): 2}
    assert sw.split_word("abcab", rank) == ["abc", "ab"]
    assert sw.split_word("a", rank) == ["a"] and sw.split_word("", rank) == []
