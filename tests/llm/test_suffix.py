from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from lexloom.llm.suffix_dedup import Repeats, remove_repeats
from lexloom.llm.suffix_sort import CAP, order_in_memory, sorted_suffixes


def slow_order(text: list[int]) -> list[int]:
    return sorted(range(len(text) - 1), key=lambda i: text[i:], reverse=True)


@pytest.mark.parametrize(("symbols", "length", "limit", "in_memory"), [(2, 300, 1 << 20, 1 << 22), (3, 500, 16, 8), (200, 800, 50, 8), (1, 200, 10, 8)])
def test_suffixes_and_common_prefixes(tmp_path, symbols, length, limit, in_memory):
    rng = np.random.default_rng(symbols)
    text = np.append(rng.integers(1, symbols + 1, length), 0).astype(np.int32)
    blocks = list(sorted_suffixes(text, symbols + 1, tmp_path / "sort", limit, in_memory))
    order = np.concatenate([p for p, _ in blocks]).tolist()
    common = np.concatenate([c for _, c in blocks]).tolist()
    plain = text.tolist()
    assert order == slow_order(plain)
    for a, b, c in zip(order, order[1:], common[1:], strict=False):
        n = 0
        while plain[a + n] == plain[b + n]:
            n += 1
        assert c == min(n, CAP)


@pytest.mark.parametrize("cap", [3, 150, 1 << 16])
def test_common_prefixes_up_to_any_length(tmp_path, cap):
    rng = np.random.default_rng(cap)
    part = rng.integers(1, 4, 200)
    text = np.concatenate([part, [4], part[30:], rng.integers(1, 4, 50), part, [0]]).astype(np.int32)
    blocks = list(sorted_suffixes(text, 5, tmp_path / "sort", 64, 8, cap=cap))
    order, common = (np.concatenate(x).tolist() for x in zip(*blocks, strict=True))
    plain = text.tolist()
    assert order == slow_order(plain)
    for a, b, c in zip(order, order[1:], common[1:], strict=False):
        n = 0
        while plain[a + n] == plain[b + n]:
            n += 1
        assert c == min(n, cap)


def test_order_in_memory():
    names = np.append(np.tile([3, 1, 2, 1], 20), 0)
    plain = names.tolist()
    assert order_in_memory(names).tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])


def slow_repeats(rows: list[tuple[int, str]], length: int) -> dict[int, tuple]:
    texts = {d: (t or "").encode() for d, t in rows}
    first: dict[bytes, int] = {}
    for d in sorted(texts):
        for p in range(len(texts[d]) - length + 1):
            first.setdefault(texts[d][p : p + length], d)
    out = {}
    for d, t in texts.items():
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < d:
                gone[p : p + length] = [True] * length
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        left = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[d] = (len(t), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def planted(seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    rows, earlier = [], []
    for d in rng.sample(range(1000), 60):
        parts = ["".join(rng.choices("abcdé \n", k=rng.randrange(90)))]
        for _ in range(rng.randrange(3)):
            if earlier:
                source = rng.choice(earlier)
                a = rng.randrange(len(source) + 1)
                parts += [source[a : a + rng.randrange(30, 140)], "".join(rng.choices("xyz", k=rng.randrange(9)))]
        text = "".join(parts) if rng.random() > 0.1 or not earlier else rng.choice(earlier)
        earlier.append(text)
        rows.append((d, text))
    return rows


@pytest.mark.parametrize("spec", [Repeats(), Repeats(part_bytes=1500, shard_bytes=400, queue_items=64, held=64, table_bits=256, known_copies=0), Repeats(length=65), Repeats(length=100), Repeats(length=100, shard_bytes=400, queue_items=64, part_bytes=1500)])
def test_repeats_equal_brute_force(spark, spec):
    rows = planted(spec.shard_bytes % 97)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(docs, spec).collect()}
    assert got == slow_repeats(rows, spec.length)


def test_edge_rows(edge_docs):
    got = remove_repeats(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[1]["n_removed"] == 0 and by_id[2]["n_removed"] == by_id[2]["n_bytes"] > 0
    assert by_id[3]["n_bytes"] == 0 and by_id[3]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by_id[8]["n_removed"] == 0
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] is None)


def test_no_rows(no_docs):
    assert remove_repeats(no_docs).collect() == []
