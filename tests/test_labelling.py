from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexloom.operators import classify as cl
from lexloom.operators import encode as en
from lexloom.operators import metrics as mt

NAMES = {0: "Negative Review", 1: "Positive Review"}
# Counts (tn, fp, fn, tp) and the two-decimal reports they must give: precision,
# recall and F1 of both classes, accuracy, macro and weighted average F1.
REPORTS = {
    "classifier": ((469, 64, 150, 383), (0.76, 0.88, 0.81), (0.86, 0.72, 0.78), 0.80),
    "logistic": ((457, 76, 80, 453), (0.85, 0.86, 0.85), (0.86, 0.85, 0.85), 0.85),
    "plain labels": ((410, 123, 113, 420), (0.78, 0.77, 0.78), (0.77, 0.79, 0.78), 0.78),
    "sharp labels": ((388, 145, 65, 468), (0.86, 0.73, 0.79), (0.76, 0.88, 0.82), 0.80),
    "prompt": ((454, 79, 92, 441), (0.83, 0.85, 0.84), (0.85, 0.83, 0.84), 0.84),
}


@pytest.fixture(scope="module")
def golden(spark):
    rows = []
    for model, ((tn, fp, fn, tp), *_) in REPORTS.items():
        for label, pred, n in ((0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)):
            rows += [(model, label, pred)] * n
    return spark.createDataFrame(rows, "model string, label int, pred int").cache()


def test_published_reports(golden):
    rows = {(r["model"], r["row"]): r for r in mt.classification_report(golden, NAMES).collect()}
    for model, (_, negative, positive, accuracy) in REPORTS.items():
        for name, want in (("Negative Review", negative), ("Positive Review", positive)):
            r = rows[model, name]
            assert (round(r["precision"], 2), round(r["recall"], 2), round(r["f1"], 2)) == want, model
            assert r["support"] == 533
        assert round(rows[model, "accuracy"]["f1"], 2) == accuracy
        assert rows[model, "accuracy"]["support"] == 1066
        assert rows[model, "macro avg"]["f1"] == pytest.approx(rows[model, "weighted avg"]["f1"])


def test_confusion_and_ranking(golden):
    counts = {r["model"]: (r["tn"], r["fp"], r["fn"], r["tp"]) for r in mt.confusion(golden).collect()}
    assert counts == {m: v[0] for m, v in REPORTS.items()}
    ranks = {r["model"]: r["rank"] for r in mt.compare_models(golden, NAMES).collect()}
    assert ranks["logistic"] == 1 and ranks["prompt"] == 2 and ranks["plain labels"] == 5


def test_ties_share_a_rank(spark):
    rows = [(m, 1, p) for m, ps in (("a", (1, 0)), ("b", (0, 1)), ("c", (0, 0))) for p in ps]
    frame = spark.createDataFrame(rows, "model string, label int, pred int")
    assert {r["model"]: r["rank"] for r in mt.compare_models(frame, NAMES).collect()} == {"a": 1, "b": 1, "c": 3}


def test_classes_without_predictions_or_truth(spark):
    frame = spark.createDataFrame([("m", 0, 0), ("m", 0, 0)], "model string, label int, pred int")
    rows = {r["row"]: r for r in mt.classification_report(frame, NAMES).collect()}
    assert tuple(rows["Positive Review"])[2:] == (0.0, 0.0, 0.0, 0)
    assert rows["Negative Review"]["f1"] == 1.0 and rows["macro avg"]["f1"] == 0.5
    assert rows["weighted avg"]["f1"] == 1.0


def test_class_counts_with_odd_labels(spark):
    frame = spark.createDataFrame([("a", 0), ("a", 1), ("a", 1), ("a", 2), ("a", None)], "split string, label int")
    assert tuple(mt.class_counts(frame).first()) == ("a", 2, 1, 2)
    assert tuple(mt.count_rows(frame).first()) == ("a", 5)


def test_alignment(spark):
    preds = spark.createDataFrame([(1, 0), (2, 1)], "doc_id int, pred int")
    truth = spark.createDataFrame([(2, 1), (3, 0)], "doc_id int, label int")
    assert [tuple(r) for r in mt.align_predictions(preds, truth).collect()] == [(2, 1, 1)]
    assert tuple(mt.unmatched(preds, truth).first()) == (1, 1, 1)


def test_classify_scores(spark):
    frame = spark.createDataFrame(
        [(0, [0.2, 0.6, 0.2]), (1, [0.1, 0.8, 0.2]), (2, [0.5, 0.1, 0.4])], "k int, scores array<double>"
    )
    assert {r["k"]: r["pred"] for r in cl.classify_scores(frame).collect()} == {0: 0, 1: 1, 2: 0}


def hashed(text, dims=64):
    counts = Counter(int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dims for w in text.lower().split())
    norm = math.sqrt(sum(n * n for n in counts.values()))
    return [counts.get(i, 0) / norm if norm else 0.0 for i in range(dims)]


def test_hash_encode_matches_plain_python(spark):
    texts = ["A b a", "", "   ", "Éé ß　x", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r["doc_id"]: r["vec"] for r in en.hash_encode(frame).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(hashed(text or ""))
    literals = en.encode_literals(spark, ["second words", "A b a", ""])
    assert literals == [pytest.approx(hashed(t)) for t in ("second words", "A b a", "")]


def test_zero_shot_ties_and_empty_texts(spark):
    labels = {"s": ["bad film", "good film"], "t": ["bad", "bad"]}
    frame = spark.createDataFrame([(0, "good good film"), (1, ""), (2, "bad thing")], "doc_id int, text string")
    rows = {(r["label_set"], r["doc_id"]): (r["pred"], r["sim"]) for r in cl.zero_shot(en.hash_encode(frame), labels).collect()}
    assert rows["s", 0][0] == 1 and rows["s", 2][0] == 0
    assert rows["s", 1] == (0, 0.0) and rows["t", 0][0] == 0
    assert len(rows) == 6


def test_tfidf_against_plain_python(spark):
    texts = {0: "a a b", 1: "b c", 2: "c c c d", 3: "zzz"}
    labels = {"x": "a c", "y": "d"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    label_rows = spark.createDataFrame(list(labels.items()), "label string, text string")
    terms = en.term_counts(docs)
    idf = en.fit_idf(terms.filter("doc_id < 3"), F.lit(3))
    label_w = en.weigh_few_terms(en.term_counts(label_rows, key="label"), idf)
    got = {(r["doc_id"], r["label"]): r["sim"] for r in en.tfidf_cosine(docs, en.weigh_terms(terms, idf), label_w).collect()}
    df = Counter(t for i in range(3) for t in set(texts[i].split()))
    weight = {t: math.log(4 / (n + 1)) + 1 for t, n in df.items()}

    def vector(text):
        return {t: n * weight[t] for t, n in Counter(text.split()).items() if t in weight}

    want = {}
    for i, text in texts.items():
        for name, label in labels.items():
            a, b = vector(text), vector(label)
            d = sum(a[t] * b[t] for t in a if t in b)
            size = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
            want[i, name] = d / size if d else 0.0
    assert got == pytest.approx(want)


def test_logistic_on_separable_points(spark):
    rnd = random.Random(1)
    rows = [(i, [(1 if i % 2 else -1) * (1 + rnd.random()), rnd.random()], i % 2) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id int, vec array<double>, label int")
    preds = cl.predict_logistic(cl.fit_logistic(frame), frame).join(frame, "doc_id").collect()
    assert all(r["pred"] == r["label"] and 0 <= r["prob"] <= 1 for r in preds)


def test_prompt_classifier_takes_any_model(spark):
    frame = spark.createDataFrame([(0, "bad"), (1, "fine")], "doc_id int, text string")
    out = cl.classify_with_prompt(frame, cl.word_rule(["bad"])).orderBy("doc_id").collect()
    assert [r["pred"] for r in out] == [0, 1]
    assert out[0]["prompt"] == cl.SENTIMENT_PROMPT + "bad"
