from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from lexloom.llm import plans
from lexloom.llm.perplexity import Rules, perplexities, quality_rules


def slow_model(texts: list[str], order: int):
    """Interpolated modified Kneser-Ney over bytes, texts padded with zeros, as plain dictionaries."""
    counts: list[Counter] = [Counter() for _ in range(order + 1)]
    for text in texts:
        raw = b"\0" * (order - 1) + text.encode()
        for k in range(order - 1, len(raw)):
            counts[order][raw[k - order + 1 : k + 1]] += 1
    for n in range(order - 1, 0, -1):
        for gram in counts[n + 1]:
            counts[n][gram[1:]] += 1

    def discounts(n):
        c = [sum(v == k for v in counts[n].values()) for k in range(5)]
        out = {1: 0.5, 2: 1.0, 3: 1.5}
        if c[1] and c[2] and c[3]:
            y = c[1] / (c[1] + 2 * c[2])
            for k, top in ((1, 1), (2, 2), (3, 3)):
                d = k - (k + 1) * y * c[k + 1] / c[k]
                if 0 < d <= top:
                    out[k] = d
        return out

    d = {n: discounts(n) for n in range(1, order + 1)}
    contexts: list[dict] = [defaultdict(list) for _ in range(order + 1)]
    for n in range(1, order + 1):
        for gram, c in counts[n].items():
            contexts[n][gram[:-1]].append(c)

    def p(gram, n):
        if n == 0:
            return 1 / 256
        seen = contexts[n].get(gram[:-1])
        lower = p(gram[1:], n - 1)
        if not seen:
            return lower
        total = sum(seen)
        off = lambda c: min(d[n][min(c, 3)], c)
        c = counts[n].get(gram, 0)
        return (c - off(c) if c else 0) / total + sum(off(x) for x in seen) / total * lower

    return p


@pytest.mark.parametrize("order", [1, 3, 4])
def test_perplexity_equals_a_plain_model(spark, order):
    rng = random.Random(order)
    words = ["".join(rng.choices("abcdé", k=rng.randrange(1, 6))) for _ in range(30)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 40))), rng.choice(["en", "de"])) for k in range(30)]
    rows += [(50, "zzz qqq", "en"), (51, None, "en"), (52, "", "de"), (53, "abc " * 5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    got = {r["doc_id"]: r["log_perplexity"] for r in perplexities(docs, Rules(order=order)).collect()}
    for lang in ("en", "de", None):
        own = [(d, t or "") for d, t, x in rows if x == lang]
        p = slow_model([t for _, t in own], order)
        for d, text in own:
            raw = b"\0" * (order - 1) + text.encode()
            total = sum(math.log10(p(raw[k - order + 1 : k + 1], order)) for k in range(order - 1, len(raw)))
            assert math.isclose(got[d], -total / max(1, len(text.split())), rel_tol=1e-5, abs_tol=1e-9), (d, text)


def test_pruned_model_still_scores_every_text(spark, sf_docs):
    whole = {r["doc_id"]: r["log_perplexity"] for r in perplexities(sf_docs, Rules()).collect()}
    pruned = {r["doc_id"]: r["log_perplexity"] for r in perplexities(sf_docs, Rules(max_grams=500)).collect()}
    assert whole.keys() == pruned.keys() and all(math.isfinite(x) for x in pruned.values())


@pytest.mark.parametrize("most", [1 << 13])
def test_a_model_in_shares_gives_the_same_scores_and_verdicts(spark, sf_docs, most):
    def of(rules):
        return {r["doc_id"]: r for r in quality_rules(sf_docs, rules).collect()}

    whole, shared = of(Rules(order=3)), of(Rules(order=3, max_grams=most))
    assert whole.keys() == shared.keys()
    for d, r in whole.items():
        assert math.isclose(r["log_perplexity"], shared[d]["log_perplexity"], rel_tol=1e-5, abs_tol=1e-6)
        assert [r[c] for c in ("kept", "base_failed", "n_words", "n_dup_lines")] == [shared[d][c] for c in ("kept", "base_failed", "n_words", "n_dup_lines")]


def test_a_text_is_scored_by_the_fold_without_it(spark):
    rng = random.Random(8)
    words = ["the", "cat", "sat", "on", "mats", "été"]
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(2, 30))), "en") for k in range(24)]
    rows += [(100 + k, t, x) for k, t, x in rows[:5]] + [(200, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    fold = {r["doc_id"]: r["f"] for r in docs.selectExpr("doc_id", "pmod(xxhash64(coalesce(text, '')), 2) AS f").collect()}
    assert set(fold.values()) == {0, 1} and all(fold[k] == fold[100 + k] for k in range(5))
    got = {r["doc_id"]: r["log_perplexity"] for r in perplexities(docs, Rules(order=3), folds=2).collect()}
    for side in (0, 1):
        p = slow_model([t or "" for d, t, _ in rows if fold[d] != side], 3)
        for d, text, _ in rows:
            if fold[d] == side:
                raw = b"\0\0" + (text or "").encode()
                total = sum(math.log10(p(raw[k - 2 : k + 1], 3)) for k in range(2, len(raw)))
                assert math.isclose(got[d], -total / max(1, len((text or "").split())), rel_tol=1e-5, abs_tol=1e-9), (d, text)


def test_bands_and_verdicts_follow_from_medians(spark, sf_docs):
    rules = Rules()
    rows = quality_rules(sf_docs, rules).collect()
    lang = {r["doc_id"]: r["lang"] for r in sf_docs.select("doc_id", "lang").collect()}

    def middle(values):
        return sorted(values)[(len(values) + 1) // 2 - 1]

    for name in set(lang.values()):
        mine = [r for r in rows if lang[r["doc_id"]] == name]
        usual = [r["log_perplexity"] for r in mine if not r["base_failed"]]
        centre = middle(usual)
        spread = max(1.4826 * middle([abs(x - centre) for x in usual]), rules.least_spread)
        for r in mine:
            reach = rules.width * spread * math.sqrt(1 + rules.settle / max(r["n_words"], 1))
            assert math.isclose(r["lower_band"], centre - reach, abs_tol=1e-9) and math.isclose(r["upper_band"], centre + reach, abs_tol=1e-9)
            assert r["kept"] == (not r["base_failed"] and centre - reach <= r["log_perplexity"] <= centre + reach)


def test_rules_keep_prose_and_reject_noise(spark, sf_docs):
    noise = [(10_000 + k, " ".join("".join(random.Random(31 * k + j).choices("QXZJ#~^", k=9)) for j in range(80)), "en", "s", 1) for k in range(3)]
    docs = sf_docs.union(spark.createDataFrame(noise, sf_docs.schema))
    got = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert not any(got[d]["kept"] for d, *_ in noise) and not any(got[d]["base_failed"] for d, *_ in noise)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1").collect()
    clean = [got[r["doc_id"]] for r in labels if not got[r["doc_id"]]["base_failed"]]
    assert sum(r["kept"] for r in clean) >= 0.97 * len(clean)
    for r in got.values():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_edge_rows(edge_docs, no_docs):
    got = quality_rules(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert all(r["base_failed"] and not r["kept"] and r["n_words"] == 0 for r in got if r["doc_id"] in (3, 4, 5))
    assert quality_rules(no_docs).collect() == []


def test_queries_cover_their_tables(spark):
    for name, query in plans.QUERIES.items():
        n = query(spark, "/root/testdata/sf0.001").count()
        if name == "op12_trie":
            assert n > 30  # a row per node of the conversations' trie
        else:
            assert n == 200 or (name == "op1_decontaminate" and 0 < n < 20), name
