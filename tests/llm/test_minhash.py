from __future__ import annotations

import random

import numpy as np
import pytest

from lexloom.llm import minhash
from lexloom.llm.minhash import Sketch, near_duplicates, parities


def shingles(text: str | None, width: int) -> frozenset:
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def slow_components(rows: list[tuple[int, str]], width: int) -> dict[int, int]:
    sets = {d: shingles(t, width) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                i = len(sets[a] & sets[b])
                if 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, width):
    rng = random.Random(width)
    vocabulary = [f"w{k}" for k in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 90))] for _ in range(12)]
    rows = []
    for d in range(150):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = near_duplicates(docs, Sketch(shingle=width)).collect()
    want = slow_components(rows, width)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {d: len(shingles(t, width)) for d, t in rows}


def test_parities_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, k).astype(np.uint64)) for k in (0, 1, 150, 160, 300, 0)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    for words in (4, 32):
        bits = np.stack(parities(np.concatenate(sets), at, words), axis=1).view(np.uint64)
        assert bits.shape == (6, words) and bits[[0, 5]].sum() == 0
        for a in range(6):
            for b in range(6):
                differ = len(np.setxor1d(sets[a], sets[b]))
                found = int(np.bitwise_count(bits[a] ^ bits[b]).sum())
                assert found <= differ and found % 2 == differ % 2


def test_near_misses_of_a_large_group_are_not_compared_in_full(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for d in range(70):
        # copies change one word, near misses nine, to words that others change to as well
        words = list(base)
        for k in rng.sample(range(1, 149, 3), 1 if d < 45 else 9):
            words[k] = f"x{k}"
        rows.append((d, " ".join(words)))
    sets = {d: shingles(t, 2) for d, t in rows}
    compared, confirm = [], minhash._confirm

    def counted(pairs, *rest):
        compared.extend((r["a"], r["b"]) for r in pairs.collect())
        return confirm(pairs, *rest)

    monkeypatch.setattr(minhash, "_confirm", counted)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), Sketch(shingle=2)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == slow_components(rows, 2)
    missed = {(a, b) for a, b in compared if 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b])}
    near = sum(70 <= 100 * len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < 80 for a in sets for b in sets if a < b)
    assert near > 500 and len(missed) < near / 5


def test_edge_rows(edge_docs):
    got = near_duplicates(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"] and by_id[1]["kept"]
    assert by_id[3]["n_shingles"] == by_id[4]["n_shingles"] == by_id[5]["n_shingles"] == 0
    assert by_id[3]["kept"] and by_id[4]["kept"] and by_id[6]["kept"]
    nameless = sorted((r["component_id"] or 0, r["kept"]) for r in got if r["doc_id"] is None)
    assert nameless == [(0, True), (1, False)]


def test_no_rows(no_docs):
    assert near_duplicates(no_docs).collect() == []
