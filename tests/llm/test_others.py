from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexloom.llm import lines, plans
from lexloom.llm.arrays import prefix_hash
from lexloom.llm.chunking import GEAR, Chunks, chunk_spans, gear_hashes, remove_chunks
from lexloom.llm.components import connected_components
from lexloom.llm.decontaminate import Lemma, banded_distance, find_leaks, index_patterns, matches, normalised
from lexloom.llm.hmm import Chain, Model, expected_counts, first_model, forward, hmm_scores
from lexloom.llm.licences import NOTICES, _lined, licences, notice_index, windows
from lexloom.llm.lines import LineRule, banded_edit_distance, line_report, remove_lines, repeated_lines, window_keys, window_probes, within_edits
from lexloom.llm.mixing import Mix, fill_budget, mix_sources
from lexloom.llm.pu import pu_scores
from lexloom.llm.sizes import join_checked, least_of_heaviest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def edit_distance(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def edited(rng: random.Random, text: str, n: int, letters: str) -> str:
    out = list(text)
    for _ in range(n):
        k = rng.randrange(max(1, len(out)))
        out[k : k + 1] = rng.choice([[], [rng.choice(letters)], [*out[k : k + 1], rng.choice(letters)]])
    return "".join(out)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 130)]
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in got} == {k: v for k, v in root.items() if k not in alone}


def test_sizes(spark):
    frame = spark.createDataFrame([(k, 1 + k // 10) for k in range(100)], "k bigint, c bigint")
    assert least_of_heaviest(frame, "c", 25) == 9
    assert least_of_heaviest(frame, "c", 1000) == 1
    other = spark.createDataFrame([(1, "x"), (2, "y")], "c bigint, v string")
    assert join_checked(frame, other, ["c"], most=1).count() == join_checked(frame, other, ["c"]).count() == 20


# --- benchmark decontamination


def test_banded_distance_finds_the_best_stretch():
    rng = random.Random(3)
    for _ in range(60):
        pattern = bytes(rng.choices(b"abcd", k=rng.randrange(8, 30)))
        inside = edited(rng, pattern.decode(), rng.randrange(4), "abcd").encode()
        text = bytes(rng.choices(b"abcd", k=10)) + inside + bytes(rng.choices(b"abcd", k=10))
        want = min(edit_distance(pattern, text[i:j]) for i in range(len(text)) for j in range(i, min(len(text), i + len(pattern) + 12) + 1))
        data = np.frombuffer(text, np.uint8)
        start = np.array([-len(pattern) - 5])
        got = banded_distance(data, start, np.frombuffer(pattern, np.uint8), len(text) + 2 * len(pattern) + 10)
        assert got[0] == want


def slow_leaks(text: str | None, items: list[tuple[int, str]], spec: Lemma) -> list[int]:
    data, _ = normalised(pa.array([text], pa.string()))
    found = []
    for item, passage in items:
        p = index_patterns([(item, passage)], spec)
        for pattern in p.texts:
            m = len(pattern)
            if len(data) and banded_distance(data, np.array([-m]), pattern, len(data) + 2 * m)[0] <= spec.edits(m):
                found.append(item)
    return sorted(set(found))


def test_leaks_equal_search_without_filter(spark):
    rng = random.Random(5)
    spec = Lemma(q=8, bytes_per_edit=10, shortest=20, longest=60, block_bytes=300)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 7))) for _ in range(40)]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(4, 40)))) for k in range(12)] + [(90, "short one"), (91, None)]
    docs = []
    for d in range(60):
        text = " ".join(rng.choices(words, k=rng.randrange(60)))
        if rng.random() < 0.6:
            leak = rng.choice(items[:12])[1]
            text += " " + edited(rng, leak, rng.randrange(8), "abc,.").upper() + "!\n" + " ".join(rng.choices(words, k=5))
        docs.append((d, text))
    docs += [(100, None), (101, "")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_ids", F.lit("clash"))
    got = {r["doc_id"]: r["item_ids"] for r in find_leaks(frame, spark.createDataFrame(items, "item_id bigint, text string"), spec).collect()}
    want = {d: slow_leaks(t, [x for x in items if x[1]], spec) for d, t in docs}
    assert got == want
    assert sum(map(bool, want.values())) > 10


def test_excerpts_of_items_are_leaks(spark):
    rng = random.Random(15)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9))) for _ in range(300)]
    long = [" ".join(rng.choices(words, k=200))[:m] for m in (394, 600, 256, 90)]
    excerpts = [long[0][60:330], long[1][100:450], long[2][:200], long[2][56:], long[0][125:270], long[3], long[0][:70], "nothing of them"]
    rest = " ".join(rng.choices([w[::-1] + "q" for w in words], k=60))
    docs = spark.createDataFrame([(k, f"{rest} {x}. {rest}") for k, x in enumerate(excerpts)], "doc_id bigint, text string")
    items = spark.createDataFrame(list(enumerate(long)), "item_id bigint, text string")
    got = {r["doc_id"]: r["item_ids"] for r in find_leaks(docs, items).collect()}
    assert got == {0: [0], 1: [1], 2: [2], 3: [2], 4: [0], 5: [3], 6: [], 7: []}


def test_leaks_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r["item_ids"] == [] for r in find_leaks(edge_docs, none).collect())
    assert find_leaks(edge_docs, none).columns == [*edge_docs.columns, "item_ids"]
    assert find_leaks(no_docs, none).collect() == []
    assert matches(np.zeros(0, np.uint8), np.zeros(1, np.int64), index_patterns([], Lemma()), Lemma())[0].size == 0


def test_alignments_of_many_texts_are_one_call():
    """Every text and pattern was aligned by itself, which was most of the CPU time."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(3, 9))) for _ in range(200)]
    passages = [" ".join(rng.choices(words, k=60)) for _ in range(4)]
    p = index_patterns(list(enumerate(passages)), Lemma())

    def calls(n: int) -> int:
        texts = [edited(rng, passages[k % 4], 3, "abc") + " " + " ".join(rng.choices(words, k=9)) for k in range(n)]
        data, at = normalised(pa.array(texts))
        seen = []
        sys.setprofile(lambda frame, event, arg: seen.append(event) if event.endswith("call") else None)
        try:
            rows, items = matches(data, at, p, Lemma())
        finally:
            sys.setprofile(None)
        assert list(zip(rows.tolist(), items.tolist(), strict=True)) == [(k, k % 4) for k in range(n)]
        return len(seen)

    assert calls(200) < 3 * calls(20)


# --- licences


def test_licences_inherit_from_the_nearest_directory(spark):
    rows = [
        ("top/LICENSE", "Released under the MIT License."), ("top/a/x.py", "print(1)"), ("top/a/b/COPYING", "intro\nLicensed under CC BY-NC 4.0."),
        ("top/a/b/c/y.py", "code of some kind"), ("top/a/b/z.py", "code\nLicensed under the Apache License, Version 2.0.\n" + "more code here " * 50),
        ("other/q.py", "nothing"), ("lone.py", None), (None, "Released under the MIT License."), ("top/e.py", ""), ("top/e.py", ""),
    ]
    files = spark.createDataFrame([(k, p, t, "mine") for k, (p, t) in enumerate(rows)], "k int, path string, text string, licence string")
    got = {r["k"]: (r["own_licence"], r["licence"], r["licence_dir"]) for r in licences(files).collect()}
    assert got == {
        0: ("MIT", "MIT", None), 1: (None, "MIT", "top"), 2: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None), 3: (None, "CC-BY-NC-4.0", "top/a/b"),
        4: ("Apache-2.0", "Apache-2.0", None), 5: (None, None, None), 6: (None, None, None), 7: ("MIT", "MIT", None), 8: (None, "MIT", "top"), 9: (None, "MIT", "top"),
    }
    assert licences(files.limit(0)).collect() == []


def test_licences_beside_other_words(spark):
    lgpl = """This file is part of it. It is free software: you can redistribute it and/or modify it under the
terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version. It comes without any warranty."""
    mit = "Copyright 2020 Somebody\n\nPermission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation"
    cases = {
        "Copyright (c) 2019 Jane Doe. Released under the MIT License.": "MIT", "# SPDX-License-Identifier: MIT\nimport os": "MIT",
        "Copyright 2021 A. B., all texts. Licensed under CC BY-NC 4.0. See the site.": "CC-BY-NC-4.0", lgpl: "LGPL-3.0", mit: "MIT",
        lgpl.replace("Lesser General", "General"): "GPL-3.0", "/* SPDX-License-Identifier: GPL-2.0-or-later */ int x;": "GPL-2.0",
        "# SPDX-License-Identifier: BSD-4-Clause": None, "The licence of this text is not known to anyone here.": None,
        "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright (C) 2007 Free Software Foundation": "GPL-3.0",
    }
    files = spark.createDataFrame([(k, f"d{k}/x.py", text) for k, text in enumerate(cases)], "k int, path string, text string")
    assert {r["k"]: r["own_licence"] for r in licences(files).collect()} == dict(enumerate(cases.values()))


def test_windows_equal_a_plain_cosine():
    rng = random.Random(21)
    index = notice_index()
    texts = [" ".join([*rng.choices("of the a b c d".split(), k=5), *edited(rng, rng.choice(NOTICES)[1], rng.randrange(6), "ab ").split(), "end"]) for _ in range(60)]
    words, _, row, _ = _lined(pa.array(texts, pa.string()))
    _, cosine, _ = windows(index, words, row, len(texts), 0.7)
    for t in range(len(texts)):
        own, most = words[row == t], 0.0
        for k, size in enumerate(index.sizes.tolist()):
            if index.exact[k] or size > len(own):
                continue
            for lo in range(len(own) - size + 1):
                part, count = np.unique(own[lo : lo + size], return_counts=True)
                place = np.minimum(np.searchsorted(index.terms, part), len(index.terms) - 1)
                known = index.terms[place] == part
                w = count * np.where(known, index.idf[place], index.unseen)
                most = max(most, float((w * np.where(known, index.weights[place, k], 0)).sum() / np.linalg.norm(w)))
        if most >= 0.7 + 1e-6 and cosine[t] < 1 - 1e-6:
            assert math.isclose(cosine[t], most, abs_tol=1e-6)


# --- mixing


def test_fill_budget_meets_budgets_that_can_be_met():
    rng = np.random.default_rng(3)
    for seed in range(20):
        sizes = np.unique(rng.integers(0, 400, 60))
        counts = rng.integers(1, 6, len(sizes))
        take = rng.integers(0, counts + 1)
        budget = float((sizes * take).sum())
        found = fill_budget(sizes, counts, budget, Mix(table=500), seed)
        assert (found <= counts).all() and (found >= 0).all() and (sizes * found).sum() == budget


def slow_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    low, high = 0.0, 1e12
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * sizes[s], level * weight[s]) for s in order) < sum(sizes.values()) else (low, level)
    return {s: min(3 * sizes[s], high * weight[s]) for s in order}


def test_mix(spark):
    rng = random.Random(8)
    rows = [(d, " w" * rng.choice([0, 3, 7, 7, 7, 20, 55]), rng.choice(["ab", "aé", "b", None, "c", "big", "big", "big"])) for d in range(400)]
    rows += [(401, None, "b"), (402, "x y", "tiny"), (None, "x y z", "b"), (3, "again", "b"), (3, "again", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("copies", F.lit("clash"))
    spec = Mix(table=50, buckets=4)
    got = mix_sources(docs, spec).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, mix_sources(docs.repartition(5), spec).collect()))
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = slow_targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-6)
        assert r["taken"] in {k * r["size"] for k in range(4)}
    for source, target in want.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == source) - target) <= 2
    assert mix_sources(docs.limit(0)).collect() == []


# --- lines


def test_banded_edit_distance():
    rng = random.Random(6)
    a = ["".join(rng.choices("abc", k=rng.randrange(6, 40))) for _ in range(300)]
    b = [edited(rng, x, rng.randrange(5), "abc") for x in a]
    for most in (1, 2, 4):
        want = [min(edit_distance(x.encode(), y.encode()), most + 1) for x, y in zip(a, b, strict=True)]
        assert banded_edit_distance([x.encode() for x in a], [y.encode() for y in b], most).tolist() == want


def test_within_edits():
    rng = random.Random(7)
    a = ["".join(rng.choices("abc", k=rng.randrange(6, 60))) for _ in range(300)]
    b = [edited(rng, x, rng.randrange(9), "abc") for x in a]
    budget = np.array([rng.randrange(9) for _ in a])
    want = [edit_distance(x.encode(), y.encode()) <= t for x, y, t in zip(a, b, budget.tolist(), strict=True)]
    for cells in (1 << 19, 300):
        assert within_edits([x.encode() for x in a], [y.encode() for y in b], budget, cells).tolist() == want
    assert 50 < sum(want) < 250


def test_windows_meet_every_line_in_reach():
    rng = random.Random(8)
    rule = LineRule(bytes_per_edit=10)
    met = 0
    for _ in range(400):
        one = "".join(rng.choices("abcdefgh", k=rng.randrange(30, 400)))
        two = edited(rng, one, rng.randrange(1, 2 + len(one) // 10), "abcdefgh")
        a, b = sorted([one.encode(), two.encode()], key=len)
        t = len(a) // 10
        if t <= 2 or edit_distance(a, b) > t:
            continue
        at = np.array([0])
        sums_a, sums_b = (prefix_hash(np.frombuffer(x, np.uint8)) for x in (a, b))
        _, keys, _ = window_keys(sums_a, at, np.array([len(a)]), rule)
        _, own, _ = window_keys(sums_b, at, np.array([len(b)]), rule)
        _, probes = window_probes(sums_b, at, np.array([len(b)]), rule, lambda k: np.ones(len(k), dtype=bool))
        assert set(keys.tolist()) & {*probes.tolist(), *own.tolist()}
        met += 1
    assert met > 100


def test_long_lines_have_more_edits(spark):
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(400)]
    line = [" ".join(rng.choices(words, k=k)) for k in (18, 45, 300, 2000)]
    near = [edited(rng, x, len(x) // 32 - 1, "xyz") for x in line]
    swapped = line[1].replace(line[1].split()[20], "qqqqqqqq", 1)
    far = "".join(c if k % 16 else "#" for k, c in enumerate(line[2]))
    rows = [(1, "\n".join(line)), (2, "\n".join(near)), (3, swapped), (4, far), (5, "end " + " ".join(rng.choices(words, k=60)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["line"]) for r in repeated_lines(docs).where("repeated").collect()}
    assert got == {(2, 0), (2, 1), (2, 2), (2, 3), (3, 0)}


def slow_repeated(rows: list[tuple[int, str]], rule: LineRule) -> dict[int, set[int]]:
    lines = [(d, k, x.strip(" \t\r\v\f").encode()) for d, t in rows for k, x in enumerate(t.split("\n")) if len(WORD.findall(x)) >= rule.min_words]
    distinct = sorted({x for _, _, x in lines})
    root = {x: x for x in distinct}
    for a in distinct:
        for b in distinct:
            edits = min(min(len(a), len(b)) // rule.bytes_per_edit, rule.most_edits)
            if a < b and abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits:
                old, new = root[b], root[a]
                root = {x: new if r == old else r for x, r in root.items()}
    out: dict[int, set[int]] = {d: set() for d, _ in rows}
    for c in set(root.values()):
        places = sorted((d, k) for d, k, x in lines if root[x] == c)
        if len({d for d, _ in places}) >= rule.min_docs:
            for d, k in places[1:]:
                out[d].add(k)
    return out


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_repeated_lines_equal_brute_force(spark, sent):
    rng = random.Random(9)
    rule = LineRule(bytes_per_edit=10, most_edits=2, min_words=2, min_docs=2, sent=sent)
    base = [" ".join("".join(rng.choices("abcd", k=rng.randrange(1, 8))) for _ in range(rng.randrange(1, 9))) for _ in range(25)]
    rows = []
    for d in range(50):
        lines = [edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3]), "abcd") for _ in range(rng.randrange(1, 6))]
        rows.append((d, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got: dict[int, set[int]] = {d: set() for d, _ in rows}
    for r in repeated_lines(docs, rule).where("repeated").collect():
        got[r["doc_id"]].add(r["line"])
    assert got == slow_repeated(rows, rule)
    cut = {r["doc_id"]: r["text"] for r in remove_lines(docs, rule).collect()}
    for d, text in rows:
        assert cut[d] == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in got[d])


@pytest.mark.parametrize("most_edits", [2, 1 << 30])
def test_keys_of_several_tables_give_the_same_lines(spark, most_edits, monkeypatch):
    rng = random.Random(10)
    rule = LineRule(bytes_per_edit=10, most_edits=most_edits, table_bits=1 << 20)
    made = lines._key_tables
    monkeypatch.setattr(lines, "_key_tables", lambda rows, found, n_keys, rule: made(rows, found, 1 << 19, rule))
    base = [" ".join("".join(rng.choices("abcd", k=rng.randrange(1, 8))) for _ in range(rng.randrange(1, 16))) for _ in range(20)]
    rows = []
    for d in range(30):
        texts = [edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3]), "abcd") for _ in range(rng.randrange(1, 6))]
        rows.append((d, "\n".join(texts)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = lines._asked(rule)
    tables = list(made(docs, found, 1 << 20, rule))
    assert len(tables) == 8 and all(64 * len(t.some) <= rule.table_bits for t in tables)
    keys = np.concatenate([key for key, _ in found(iter(docs.toArrow().to_batches()))])
    assert (sum(t.has(keys).astype(int) for t in tables) == 1).all()
    got: dict[int, set[int]] = {d: set() for d, _ in rows}
    for r in repeated_lines(docs, rule).where("repeated").collect():
        got[r["doc_id"]].add(r["line"])
    assert got == slow_repeated(rows, rule)


def test_lines_that_repeat_themselves_are_no_probes():
    rule = LineRule()
    text = "be " * 100 + "\n" + " ".join(f"w{k * k}" for k in range(60))
    piece = pa.record_batch([pa.array([text])], names=["text"])
    keys = np.concatenate([key for key, _ in lines._asked(rule)(iter([piece]))])
    known = SimpleNamespace(value=SimpleNamespace(has=lambda k: np.isin(k, keys), shared=lambda k: np.zeros(len(k), bool)))
    assert sum(b.num_rows for b in lines._prober(known, rule)(iter([piece]))) == 0


def test_variants_inside_one_document_are_one_document(spark):
    row = "2024-01-{:02d} 10:00:00 INFO worker finished the nightly import of all tables without errors"
    rows = [(1, "\n".join(row.format(k) for k in range(10, 19))), (2, "a line of its own in another document\n" + row.format(30)), (3, "nothing shared")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = repeated_lines(docs.where("doc_id <> 2")).collect()
    assert not any(r["repeated"] for r in got)
    got = {(r["doc_id"], r["line"]): (r["repeated"], r["n_docs"]) for r in repeated_lines(docs).collect()}
    assert got[2, 1] == (True, 2) and got[1, 0] == (False, 2) and got[1, 8] == (True, 2) and not got[2, 0][0]
    assert not any(r["repeated"] for r in repeated_lines(docs, LineRule(min_docs=3)).collect())


def test_short_lines_have_exact_copies(spark):
    rows = [(1, "All rights reserved.\n \nonly here"), (2, "first\n  All rights reserved.\t\n\n版权所有不得转载"), (3, "版权所有不得转载\nAll rights reserve."), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {(r["doc_id"], r["line"]) for r in repeated_lines(docs).where("repeated").collect()} == {(2, 1), (3, 0)}
    assert {r["doc_id"]: r["n_lines"] for r in line_report(docs).collect()} == {1: 2, 2: 3, 3: 2, 4: 0}


def test_line_edges(edge_docs, no_docs):
    got = remove_lines(edge_docs.withColumn("n_lines", F.lit("clash"))).collect()
    assert len(got) == edge_docs.count()
    assert {r["doc_id"]: r["text"] for r in got if r["doc_id"] == 3} == {3: None}
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] in (None, 1))
    assert [r["text"] for r in got if r["doc_id"] == 2] == [""]
    assert remove_lines(no_docs).collect() == line_report(no_docs).collect() == []


# --- chunks


def slow_chunks(text: bytes, spec: Chunks) -> list[tuple[int, int]]:
    out, start, h = [], 0, 0
    for k, byte in enumerate(text):
        h = (2 * h + int(GEAR[byte])) % (1 << 32)
        size = k + 1 - start
        if size == spec.most or (size >= spec.least and h >> (32 - spec.bits) == 0):
            out.append((start, k + 1))
            start = k + 1
    return [*out, (start, len(text))] if start < len(text) else out


def test_chunks_equal_a_plain_loop():
    rng = random.Random(12)
    texts = ["".join(rng.choices("abc é", k=rng.choice([0, 1, 40, 900]))) for _ in range(40)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.cumsum([0, *(len(t.encode()) for t in texts)])
    spec = Chunks(least=8, most=60, bits=4)
    start, end, row = chunk_spans(data, at, spec)
    for k, text in enumerate(texts):
        own = row == k
        assert list(zip((start[own] - at[k]).tolist(), (end[own] - at[k]).tolist(), strict=True)) == slow_chunks(text.encode(), spec)
    assert len(gear_hashes(data, at)) == len(data)


def test_removed_chunks_equal_a_plain_loop(spark):
    rng = random.Random(13)
    base = ["".join(rng.choices("abcdefgh ", k=400)) for _ in range(4)]
    rows = [(d, "".join(rng.choices("xyz", k=rng.randrange(40))) + rng.choice(base)[rng.randrange(100) :] + rng.choice(base)) for d in rng.sample(range(99), 30)]
    spec = Chunks()
    seen, want = set(), {}
    for d, text in sorted(rows):
        raw, left, gone = text.encode(), b"", 0
        for a, b in slow_chunks(raw, spec):
            if b - a >= spec.least and raw[a:b] in seen:
                gone += b - a
            else:
                left += raw[a:b]
            seen.add(raw[a:b])
        want[d] = (gone, hashlib.sha256(left).hexdigest())
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in remove_chunks(docs, spec).collect()}
    assert got == want and any(g for g, _ in want.values())


def test_chunk_edges(edge_docs, no_docs):
    got = remove_chunks(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] in (None, 1, 3, 4, 7))
    assert remove_chunks(no_docs).collect() == []


# --- hidden Markov model


def slow_likelihood(model: Model, symbols: list[int]) -> float:
    alpha = model.start * model.emit[symbols[0]]
    for s in symbols[1:]:
        alpha = (alpha @ model.move) * model.emit[s]
    return math.log10(alpha.sum())


def test_forward_and_expected_counts():
    model = first_model(np.full(6, 1 / 6), Chain(states=3, seed=2))
    rng = np.random.default_rng(1)
    length = np.array([5, 3, 1])
    table = np.where(np.arange(5)[:, None] < length, rng.integers(0, 6, (5, 3)), 0)
    got = forward(model, table, length, False)[0]
    assert np.allclose(got, [slow_likelihood(model, table[:n, k].tolist()) for k, n in enumerate(length)])
    # every path by its weight
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    for k, n in enumerate(length):
        paths = [[]]
        for _ in range(n):
            paths = [[*p, s] for p in paths for s in range(3)]
        weights = []
        for p in paths:
            w = model.start[p[0]] * model.emit[table[0, k], p[0]]
            for t in range(1, n):
                w *= model.move[p[t - 1], p[t]] * model.emit[table[t, k], p[t]]
            weights.append(w)
        for p, w in zip(paths, np.array(weights) / sum(weights), strict=True):
            start[p[0]] += w
            for t in range(n):
                emit[table[t, k], p[t]] += w
                if t:
                    move[p[t - 1], p[t]] += w
    for a, b in zip(expected_counts(model, table, length), (start, move, emit), strict=True):
        assert np.allclose(a, b)


def test_hmm_scores(spark, sf_docs):
    docs = sf_docs.withColumn("held_out", plans.fold(7) == 2)
    spec = Chain(frequent=200, classes=16, known=400, rounds=3)
    got = {r["doc_id"]: r for r in hmm_scores(docs, spec).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in sf_docs.select("doc_id", "text").collect()}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {d: [*WORD.findall(t.translate(low)), None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    counts: dict = {}
    for d, words in tokens.items():
        for w in () if held[d] else words:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for d, words in tokens.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[d], len(words), n)
        assert r["n_known"] == sum(w in counts for w in words)
        assert math.isclose(r["base_score"], sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
    assert sum(r["score"] for r in got.values() if r["held_out"]) > sum(r["base_score"] for r in got.values() if r["held_out"])


def test_hmm_probabilities_add_up(spark):
    docs = spark.createDataFrame([(k, t, False) for k, t in enumerate(["a b a", "b c", "a", "d d e"])], "doc_id bigint, text string, held_out boolean")
    # texts of one word: the known ones, and one unknown for every class
    spec = Chain(states=2, frequent=3, classes=4, known=4, rounds=2)
    probes = [chr(c) for c in range(ord("a"), ord("f"))]
    asked = spark.createDataFrame([(100 + k, w, True) for k, w in enumerate(probes)], "doc_id bigint, text string, held_out boolean")
    got = hmm_scores(docs.union(asked), spec).where("held_out").collect()
    assert 0 < sum(10 ** r["score"] for r in got) < 1


def test_hmm_edges(edge_docs, no_docs):
    got = hmm_scores(edge_docs.withColumn("held_out", F.col("doc_id") == 2), Chain(frequent=50, classes=8, known=90, rounds=1)).collect()
    assert len(got) == edge_docs.count()
    assert all(r["n_tokens"] == 1 for r in got if r["doc_id"] in (3, 4, 5))
    assert all(math.isfinite(r["score"]) for r in got)
    pairs = [r for r in got if r["doc_id"] == 1]
    assert pairs[0] == pairs[1]
    assert hmm_scores(no_docs.withColumn("held_out", F.lit(False)), Chain(rounds=1)).collect() == []


# --- quality classifier


def test_pu_scores_tell_junk_from_prose(spark):
    sf = "/root/testdata/sf0.01"
    got = plans.QUERIES["op8_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r["score"] for r in got if r["quality"] == 1]
    junk = [r["score"] for r in got if r["quality"] == 0]
    order = sum((a > b) + (a == b) / 2 for a in good for b in junk) / (len(good) * len(junk))
    assert order > 0.95
    assert sum(r["predicted"] == r["quality"] for r in got) / len(got) > 0.9


def test_pu_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (6, None), (None, 1), (99, 1), (4, 0)], "doc_id bigint, quality int")
    got = pu_scores(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    empty = labels.limit(0)
    assert {round(r["score"], 9) for r in pu_scores(edge_docs, empty).collect()} == {0.5}
    assert pu_scores(no_docs, empty).collect() == []
