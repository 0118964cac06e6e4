from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.functions import vectors as vc
from lexloom.operators import vectors as vo


def vec_frame(spark, rows):
    return spark.createDataFrame(rows, "key int, vec array<double>")


def random_vectors(n, dim, seed=1):
    return np.random.default_rng(seed).normal(size=(n, dim))


@pytest.mark.parametrize(
    "a, b, want",
    [
        ([1.0, 0.0], [1.0, 0.0], 1.0),
        ([1.0, 0.0], [-2.0, 0.0], -1.0),
        ([1.0, 0.0], [0.0, 3.0], 0.0),
        ([0.0, 0.0], [1.0, 0.0], None),
        ([1.0], [1.0, 0.0], None),
        (None, [1.0], None),
    ],
)
def test_cosine(spark, a, b, want):
    frame = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    got = frame.select(vc.cosine("a", "b")).first()[0]
    assert got == want if want is None else got == pytest.approx(want)


def test_argmax_topk_and_positions(spark):
    frame = vec_frame(spark, [(0, [1.0, 5.0, 5.0]), (1, [2.0]), (2, None)])
    got = {r[0]: r[1:] for r in frame.select("key", vc.argmax("vec"), vc.topk("vec", 2), vc.vec_at("vec", -2)).collect()}
    assert got[0][0] == 1 and [tuple(s) for s in got[0][1]] == [(1, 5.0), (2, 5.0)] and got[0][2] == 5.0
    assert got[1][0] == 0 and [tuple(s) for s in got[1][1]] == [(0, 2.0)] and got[1][2] is None
    assert got[2][0] is None


def test_softmax_of_large_and_equal_scores(spark):
    frame = vec_frame(spark, [(0, [1000.0, 1001.0]), (1, [3.0, 3.0])])
    got = {r[0]: r[1] for r in frame.select("key", vc.softmax("vec")).collect()}
    assert got[0] == pytest.approx([1 / (1 + math.e), math.e / (1 + math.e)])
    assert got[1] == [0.5, 0.5]


def test_unit_keeps_zero(spark):
    frame = vec_frame(spark, [(0, [3.0, 4.0]), (1, [0.0, 0.0])])
    got = {r[0]: r[1] for r in frame.select("key", vc.unit("vec")).collect()}
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1] == [0.0, 0.0]


def test_mean_vec_and_dims(spark):
    frame = spark.createDataFrame(
        [("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("a", [5.0, 6.0]), ("b", [7.0, 8.0])], "g string, vec array<double>"
    )
    means = {r["g"]: r["vec"] for r in vo.mean_vec(frame, "g").collect()}
    assert means == {"a": pytest.approx([3.0, 4.0]), "b": pytest.approx([7.0, 8.0])}
    assert tuple(vo.vec_dim(frame).first()) == (4, 2, 2)


def brute(data, query, k, skip=None):
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    sims = np.round(unit @ (query / np.linalg.norm(query)), 6)
    order = sorted((i for i in range(len(data)) if i != skip), key=lambda i: (-sims[i], i))[:k]
    return [(i, sims[i]) for i in order]


@pytest.mark.parametrize("partitions", [1, 8])
def test_nearest_vectors_match_brute_force(spark, partitions):
    data = np.round(random_vectors(300, 5), 1)  # coarse values make ties
    frame = vec_frame(spark, [(i, v.tolist()) for i, v in enumerate(data)]).repartition(partitions)
    queries = spark.createDataFrame([(7, data[7].tolist()), (1000, [1.0] * 5)], "query int, vec array<double>")
    rows = vo.most_similar_to_vector(frame, queries, 6).collect()
    for query, vec in ((7, data[7]), (1000, np.ones(5))):
        got = [(r["key"], r["sim"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query"] == query]
        assert got == brute(data, vec, 6)


def test_queries_beyond_one_block(spark, monkeypatch):
    monkeypatch.setattr(vo, "BLOCK_VECTORS", 4)
    data = random_vectors(40, 4)
    frame = vec_frame(spark, [(i, v.tolist()) for i, v in enumerate(data)])
    rows = vo.most_similar_to_key(frame, frame.select("key").filter("key < 18"), 3).collect()
    for query in range(18):
        got = [(r["key"], r["sim"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query"] == query]
        assert got == brute(data, data[query], 3, skip=query)
    sims = vo.cross_score(frame, frame.select(F.col("key").alias("label"), "vec"))
    assert sims.count() == 1600


def test_self_and_unknown_keys(spark):
    frame = vec_frame(spark, [(i, v.tolist()) for i, v in enumerate(random_vectors(20, 3))])
    known = vo.most_similar_to_key(frame, spark.createDataFrame([(3,)], "key int"), 4).collect()
    assert len(known) == 4 and all(r["key"] != 3 for r in known)
    assert vo.most_similar_to_key(frame, spark.createDataFrame([(99,)], "key int"), 4).count() == 0


def test_cross_score_zero_vector(spark):
    left = vec_frame(spark, [(0, [0.0, 0.0]), (1, [1.0, 1.0])])
    right = spark.createDataFrame([("x", [1.0, 0.0])], "label string, vec array<double>")
    got = {r["key"]: r["sim"] for r in vo.cross_score(left, right).collect()}
    assert got == {0: 0.0, 1: pytest.approx(math.sqrt(0.5))}


@pytest.fixture(scope="module")
def clusters(spark):
    """Four tight clusters; the first one holds most of the vectors."""
    rng = np.random.default_rng(5)
    centers = np.eye(8)[:4]
    rows = []
    for i in range(600):
        c = 0 if i % 2 == 0 else 1 + i % 3
        rows.append((i, (centers[c] + rng.normal(scale=0.05, size=8)).tolist()))
    return vec_frame(spark, rows).repartition(4).cache(), np.array([r[1] for r in rows])


def test_cell_search_recall_and_candidates(spark, clusters):
    frame, data = clusters
    model = vo.fit_cells(frame, 4)
    cells = vo.assign_cells(frame, model)
    queries = frame.filter("key < 40").withColumnRenamed("key", "query")
    rows = vo.approx_most_similar(cells, model, queries, 5, nprobe=1).collect()
    hits = 0
    for q in range(40):
        want = {i for i, _ in brute(data, data[q], 5)}
        hits += len(want & {r["key"] for r in rows if r["query"] == q})
    assert hits / 200 >= 0.9
    candidates = vo.probed_pairs(cells, model, queries, 1).count()
    assert candidates < 0.55 * 40 * 600


def test_all_cells_are_exact(spark, clusters):
    frame, data = clusters
    model = vo.fit_cells(frame, 4)
    queries = frame.filter("key < 10").withColumnRenamed("key", "query")
    rows = vo.approx_most_similar(vo.assign_cells(frame, model), model, queries, 5, nprobe=4).collect()
    for q in range(10):
        got = [(r["key"], r["sim"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query"] == q]
        assert got == brute(data, data[q], 5)


def test_context_vectors_against_plain_python(spark):
    rnd = random.Random(3)
    texts = [[rnd.choice("abcd") for _ in range(n)] for n in (1, 2, 7, 12)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, tokens array<string>")
    buckets = F.transform("tokens", lambda t: (F.ascii(t) % 3).cast("int"))
    got = vo.context_vectors(frame.withColumn("buckets", buckets), "buckets", 2).collect()
    found = {(r["doc_id"], r["pos"], r["bucket"]): r["x"] for r in got}
    assert len(found) == len(got)
    want = {}
    for d, tokens in enumerate(texts):
        for p in range(len(tokens)):
            near = [ord(t) % 3 for t in tokens[max(0, p - 2) : p + 3]]
            for b in set(near):
                want[d, p, b] = near.count(b) / len(near)
    assert found == pytest.approx(want)


def test_same_word_in_two_contexts(spark):
    frame = spark.createDataFrame([(0, ["a", "x", "b", "c", "x", "d"])], "doc_id int, tokens array<string>")
    buckets = F.transform("tokens", lambda t: F.ascii(t))
    rows = vo.context_vectors(frame.withColumn("buckets", buckets), "buckets", 1).filter("token = 'x'").collect()
    by_pos = {}
    for r in rows:
        by_pos.setdefault(r["pos"], set()).add(r["bucket"])
    assert by_pos[1] != by_pos[4]


def test_closer_of_prefers_second_on_tie(spark):
    means = spark.createDataFrame(
        [
            (0, "it", 1, 1.0), (0, "dog", 1, 1.0), (0, "cat", 1, 1.0),
            (1, "it", 1, 1.0), (1, "dog", 1, 2.0), (1, "cat", 2, 2.0),
            (2, "it", 1, 1.0), (2, "dog", 1, 1.0),
        ],
        "doc_id int, token string, bucket int, x double",
    )
    got = {r["doc_id"]: r["closer"] for r in vo.closer_of(means, "it", "dog", "cat").collect()}
    assert got == {0: "cat", 1: "dog"}
    assert "closer" in vo.closer_of(means, "it", "dog", "cat").columns


def test_closer_label(spark):
    row = spark.range(1).select(
        vc.closer_label(F.lit(0.5), F.lit(0.5), "a", "b"), vc.closer_label(F.lit(0.6), F.lit(0.5), "a", "b")
    ).first()
    assert tuple(row) == ("b", "a")


def test_vectors_of_other_lengths_and_nulls_are_no_match(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0]), (3, None), (4, [0.0, 2.0]), (5, [None, 1.0]), (6, [0.0, 0.0])]
    vecs = spark.createDataFrame(rows, "key bigint, vec array<double>")
    labels = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0]), ("z", None)], "label string, vec array<double>")
    got = {(r["key"], r["label"]): r["sim"] for r in vo.cross_score(vecs, labels).collect()}
    assert {k: v for k, v in got.items() if v is not None} == {(4, "x"): 0.0, (4, "y"): 1.0, (6, "x"): 0.0, (6, "y"): 0.0}
    assert len(got) == 12
    near = vo.most_similar_to_vector(vecs, labels.withColumnRenamed("label", "query"), k=5).collect()
    assert {r["key"] for r in near} == {4, 6}
    with pytest.raises(ValueError):
        vo.cross_score(vecs, vecs.withColumnRenamed("key", "label").where("vec is not null"))


def test_many_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vo, "BLOCK_VECTORS", 300)
    vecs = spark.range(1000).selectExpr("id AS key", "array(cast(cos(id) as double), cast(sin(id) as double)) AS vec")
    queries = vecs.selectExpr("key AS query", "vec")
    best = vo.most_similar_to_vector(vecs, queries, k=1).collect()
    assert len(best) == 1000 and sum(r["sim"] > 0.999999 for r in best) == 1000


@pytest.mark.parametrize("block", [1, 7, 4096])
@pytest.mark.parametrize("names", [int, str])
def test_queries_of_any_number_meet_all_vectors(spark, monkeypatch, block, names):
    rng = np.random.default_rng(3)
    points = rng.integers(-1, 2, (60, 3)).astype(float)  # many ties and some zeros
    rows = [(names(k), p.tolist()) for k, p in enumerate(points)] + [(names(97), None), (names(98), [1.0, 2.0])]
    vecs = spark.createDataFrame(rows, f"key {'bigint' if names is int else 'string'}, vec array<double>")
    asked = vecs.where("size(vec) = 3 and cast(key as int) % 2 = 0").withColumnRenamed("key", "query")
    monkeypatch.setattr(vo, "BLOCK_VECTORS", block)
    norm = np.linalg.norm(points, axis=1, keepdims=True)
    unit = np.divide(points, norm, out=np.zeros_like(points), where=norm > 0)
    sims = np.round(unit @ unit.T, 6) + 0.0
    for alone in (False, True):
        got = vo.most_similar_to_vector(vecs, asked, 4, exclude_self=alone).orderBy("query", "rank").collect()
        want = []
        for q in sorted(map(names, range(0, 60, 2))):
            best = sorted((-sims[int(q), j], names(j)) for j in range(60) if not (alone and names(j) == q))[:4]
            want += [(q, key, -s, r + 1) for r, (s, key) in enumerate(best)]
        assert [(r["query"], r["key"], r["sim"], r["rank"]) for r in got] == [(q, key, pytest.approx(s, abs=1e-9), r) for q, key, s, r in want]
    scored = vo.cross_score(vecs, asked, right_key="query").collect()
    assert len(scored) == 62 * 30
    for r in scored:
        k = int(r["key"])
        assert r["sim"] is None if k >= 97 else r["sim"] == pytest.approx(sims[k, int(r["query"])], abs=1e-6)


def test_unequal_lengths_are_an_error_in_a_cell_too(spark, monkeypatch):
    monkeypatch.setattr(vo, "BLOCK_VECTORS", 2)
    vecs = spark.createDataFrame([(k, [1.0, float(k)]) for k in range(4)], "key bigint, vec array<double>")
    asked = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0, 3.0]), (4, [1.0]), (5, [1.0, 1.0])], "query bigint, vec array<double>")
    with pytest.raises(Exception, match="one length"):
        vo.most_similar_to_vector(vecs, asked, 2).collect()


def test_context_vectors_look_through_no_text_place_by_place(spark):
    frame = spark.createDataFrame([(1, ["a", "b", "a"], [0, 1, 0])], "doc_id bigint, tokens array<string>, buckets array<int>")
    got = vo.context_vectors(frame, "buckets", 1)
    assert "transform(" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["pos"], r["bucket"]): round(r["x"], 6) for r in got.collect()} == {
        (0, 0): 0.5, (0, 1): 0.5, (1, 0): 0.666667, (1, 1): 0.333333, (2, 0): 0.5, (2, 1): 0.5,
    }
