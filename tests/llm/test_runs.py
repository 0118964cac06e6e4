from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lexloom.llm.plans import QUERIES, planted_repeats
from lexloom.llm.runs import RunRule, find_runs, periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words: list[str], least: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """Every lag scanned over all words; the smallest period of a stretch counts."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, exponent * q):
                found.setdefault((start, i + q), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {j for start, length, q in runs for j in range(start + q, start + length)}
    return " ".join(w for j, w in enumerate(words) if j not in gone)


def plain_planted(doc_id: int | None, text: str | None) -> list[str]:
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if words and h % 10 == 0:
        a = h // 10 % len(words)
        p = 1 + (len(words) - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def stretches(rng: random.Random) -> list[str]:
    """Runs of many periods and alphabets, cut off anywhere, overlapping and disturbed."""
    words, letters = [], rng.choice([1, 2, 3, 5, 50])
    for _ in range(rng.randrange(7)):
        base = [str(rng.randrange(letters)) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64]))]
        words += (base * rng.randrange(1, 8))[: rng.randrange(1, 300)]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = "x"
    return words


@pytest.mark.parametrize("seed", range(40))
@pytest.mark.parametrize("scan", [1, 8])
def test_runs_are_those_of_all_lags(seed, scan):
    rng = random.Random(seed)
    texts = [stretches(rng) for _ in range(8)]
    names = {w: k for k, w in enumerate({w for t in texts for w in t})}
    at = np.cumsum([0, *map(len, texts)])
    got = list(zip(*(x.tolist() for x in find_runs(np.array([names[w] for t in texts for w in t], np.int64), at, RunRule(scan=scan))), strict=True))
    assert got == [(a + int(at[k]), n, q) for k, t in enumerate(texts) for a, n, q in plain_runs(t)]


def test_periods_of_words_that_repeat_inside_the_period():
    # the morphism a -> ab, b -> ba: no run of its own, but its words repeat at every distance
    word = "a"
    for _ in range(7):
        word = "".join("ab" if c == "a" else "ba" for c in word)
    words = list(word * 5)
    got = find_runs(np.array([ord(c) for c in words], np.int64), np.array([0, len(words)]))
    assert list(zip(*(x.tolist() for x in got), strict=True)) == plain_runs(words)


def test_rules_that_minimizers_cannot_hold_are_refused():
    for wrong in ({"exponent": 3}, {"scan": 6}, {"scan": 0}):
        with pytest.raises(ValueError):
            RunRule(**wrong)


def test_edges(edge_docs, no_docs):
    got = periodic_runs(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by_text = [(r["doc_id"], r["n_words"], r["collapsed"]) for r in got]
    assert (3, 0, "") in by_text and (4, 0, "") in by_text and (5, 0, "") in by_text and (None, 0, "") in by_text and (7, 1, "one") in by_text
    assert sum(r["doc_id"] == 1 for r in got) == 2
    long = next(r for r in got if r["doc_id"] == 6)
    assert long["n_words"] == 20_000
    empty = periodic_runs(no_docs)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_a_very_long_run_and_words_of_other_scripts(spark):
    long = " ".join(["käse", "東京", "x"] * 40_000)
    rows = [(1, f"ein\n{long} y"), (2, "a\ta\na a a a a a a a")]
    got = {r["doc_id"]: r for r in periodic_runs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(1, 119_999, 3)] and got[1]["collapsed"] == "ein käse 東京 x x y"
    # a blank of another kind belongs to its word
    assert [tuple(r) for r in got[2]["runs"]] == plain_runs("a|a|a|a a|a|a|a|a|a".split("|"))


def test_query_on_planted_documents_against_every_lag(spark, sf_docs):
    rows = {r["doc_id"]: r for r in QUERIES["op13_runs"](spark, "/root/testdata/sf0.001").collect()}
    planted = {r["doc_id"]: r["text"] for r in planted_repeats(sf_docs).collect()}
    some = 0
    for doc in sf_docs.collect():
        words, got = plain_planted(doc["doc_id"], doc["text"]), rows[doc["doc_id"]]
        assert WORD.findall(planted[doc["doc_id"]] or "") == words
        if len(words) > 3_000:
            continue  # every lag over every word takes too long here; the query's SQL covers these
        runs = plain_runs(words)
        best = min(((-n, a, q) for a, n, q in runs), default=None)
        assert got["n_runs"] == len(runs)
        assert got["runs_sha256"] == hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest()
        assert got["collapsed_sha256"] == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
        if best is None:
            assert [got[c] for c in ("start", "length", "period", "exponent_milli")] == [None] * 4
        else:
            assert (got["start"], got["length"], got["period"]) == (best[1], -best[0], best[2])
            assert got["exponent_milli"] == 1000 * -best[0] // best[2]
        some += bool(runs)
    assert some > 5
