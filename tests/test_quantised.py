from __future__ import annotations

import numpy as np
import pytest

from lexloom.operators.quantised import Quantiser, encode_vectors, fit_quantiser, lloyd, search_quantised
from lexloom.operators.vectors import most_similar_to_vector
from lexloom.session import cut_lineage


def frame(spark, points, key="key", kind="bigint", names=None):
    names = names or range(len(points))
    return spark.createDataFrame([(k, p.tolist()) for k, p in zip(names, points, strict=True)], f"{key} {kind}, vec array<double>")


def test_lloyd_fills_every_centre():
    rows = np.concatenate([np.zeros((50, 2)), np.ones((3, 2)), np.full((1, 2), 9.0)])
    centres = lloyd(rows, 3, 8, np.random.default_rng(1))
    assert sorted(map(tuple, centres.tolist())) == [(0.0, 0.0), (1.0, 1.0), (9.0, 9.0)]


def test_tables_give_the_product_with_the_decoded_vector():
    rng = np.random.default_rng(2)
    known = Quantiser(rng.normal(size=(3, 8)), rng.normal(size=(4, 5, 2)))
    rows, queries = rng.normal(size=(20, 8)), rng.normal(size=(6, 8))
    cell, codes = known.encode(rows)
    decoded = known.centres[cell] + np.stack([known.books[j][codes[:, j]] for j in range(4)], axis=1).reshape(20, 8)
    tables = known.tables(queries)
    sums = queries @ known.centres[cell].T + sum(tables[:, j, :][:, codes[:, j]] for j in range(4))
    assert np.allclose(sums, queries @ decoded.T)
    for k in range(20):
        others = ((rows[k] - known.centres) ** 2).sum(1)
        assert others[cell[k]] == others.min()


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("block", [1, 4096])
def test_all_cells_and_a_whole_rerank_are_exact(spark, kind, block):
    points = np.random.default_rng(4).normal(size=(120, 8))
    names = [k if kind == "bigint" else f"v{k}" for k in range(120)]
    vecs = cut_lineage(frame(spark, points, kind=kind, names=names))
    queries = vecs.limit(9).withColumnRenamed("key", "query")
    known = fit_quantiser(vecs, 6, parts=4, codes=8)
    index = cut_lineage(encode_vectors(vecs, known))
    got = search_quantised(index, known, vecs, queries, 5, nprobe=6, rerank=120, salts=3, block=block).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, most_similar_to_vector(vecs, queries, 5).collect()))


def test_recall_on_groups_with_few_cells_and_a_short_rerank(spark):
    rng = np.random.default_rng(6)
    points = np.repeat(rng.normal(size=(20, 16)), 30, axis=0) + rng.normal(scale=0.2, size=(600, 16))
    vecs = cut_lineage(frame(spark, points))
    queries = vecs.where("key % 20 = 0").withColumnRenamed("key", "query")
    known = fit_quantiser(vecs, 20, parts=4, codes=32, sample=400)
    assert known.centres.shape == (20, 16) and known.books.shape == (4, 32, 4)
    again = fit_quantiser(vecs.repartition(7), 20, parts=4, codes=32, sample=400)
    assert (known.centres == again.centres).all() and (known.books == again.books).all()
    index = cut_lineage(encode_vectors(vecs, known))
    assert index.count() == 600 and {len(r["codes"]) for r in index.collect()} == {4}
    found = {(r["query"], r["key"]) for r in search_quantised(index, known, vecs, queries, 5, nprobe=3, rerank=25).collect()}
    exact = {(r["query"], r["key"]) for r in most_similar_to_vector(vecs, queries, 5).collect()}
    assert len(found & exact) >= 0.9 * len(exact)


def test_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [0.0, 2.0])]
    vecs = spark.createDataFrame(rows, "key bigint, vec array<double>")
    known = fit_quantiser(vecs.where("key in (1, 3, 6)"), 9, parts=2, codes=16)
    index = cut_lineage(encode_vectors(vecs, known))
    assert sorted(r["key"] for r in index.collect()) == [1, 3, 6]
    queries = vecs.where("key in (1, 2)").withColumnRenamed("key", "query")
    got = search_quantised(index, known, vecs.where("key in (1, 3, 6)"), queries, 2, nprobe=9, rerank=9).collect()
    assert [(r["query"], r["key"], r["rank"]) for r in got] == [(1, 1, 1), (1, 3, 2)]
    for wrong in ({"parts": 3}, {"codes": 257}):
        with pytest.raises(ValueError):
            fit_quantiser(vecs.where("key = 1"), 2, **{"parts": 1, **wrong})
    with pytest.raises(ValueError):
        fit_quantiser(vecs.where("key = 2"), 2, parts=1)
