"""What must not grow with the input: rows sent or repeated for a join, rows shuffled for few prefixes, slices in Python."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexloom.operators import frames as fr
from lexloom.operators import ngrams as ng
from lexloom.operators import sequences as sq
from lexloom.operators import subwords as sw
from lexloom.operators import tokens as tk


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("join", [fr.salted_join, lambda *a: fr.checked_join(*a, most=5)])
def test_a_large_right_side_is_neither_sent_nor_repeated(spark, join):
    left = spark.range(1000).selectExpr("id AS k", "id % 50 AS w")
    right = spark.range(50).selectExpr("id AS w", "id * 2 AS v")
    joined = join(left, right, "w", "k")
    assert "Broadcast" not in plan_of(joined) and "Generate" not in plan_of(joined)
    assert joined.agg(F.sum("v")).first()[0] == sum(2 * (i % 50) for i in range(1000))


def test_item_vectors_are_a_table_with_all_items(spark):
    rows = [(1, 0, "a"), (1, 1, "b"), (1, 2, "a"), (2, 0, "alone"), (3, 0, None)]
    frame = spark.createDataFrame(rows, "seq_id bigint, pos bigint, item string")
    model = sq.train_item_vectors(frame, dim=4, window=2)
    assert {r["item"]: len(r["vec"]) for r in model.table.collect()} == {"a": 4, "b": 4, "alone": 4, None: 4}
    assert [r["word"] for r in model.findSynonyms("a", 1).collect()] in (["b"], ["alone"])


def test_prefixes_drop_other_runs_before_counting(spark):
    docs = spark.createDataFrame([("a b c a b d x y",), ("b c a b c",), (None,)], "text string")
    wanted = spark.createDataFrame([(1, "b"), (2, "a b"), (2, "z z")], "prefix_len int, prefix string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = ng.next_counts(docs, 2, prefixes=wanted)
        plan = plan_of(counts)
        assert "BroadcastHashJoin" in plan[plan.index("HashAggregate") :]
        got = {tuple(r) for r in counts.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(1, "b", "c", 3), (1, "b", "d", 1), (2, "a b", "c", 2), (2, "a b", "d", 1)}


def test_slices_of_lists_are_bounded():
    lists = pa.array([["a"] * 3, None, [], ["b"] * 9, ["c"], ["d"] * 4])
    assert list(tk.row_slices(lists, 5)) == [(0, 3), (3, 1), (4, 2)]
    assert list(tk.row_slices(pa.array([], pa.list_(pa.string())), 5)) == []


class Sent:
    value = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "w"]


def test_encoder_and_decoder_take_a_batch_in_slices():
    n = tk.SLICE_ELEMENTS // 2
    batch = pa.record_batch([pa.array([1, 2, 3]), pa.array([["w"] * n, ["w", "?"], ["w"] * n])], names=["k", "tokens"])
    found = list(tk._encoder(Sent, ["k"])(iter([batch])))
    assert [b.num_rows for b in found] == [1, 2] or [b.num_rows for b in found] == [2, 1]
    table = pa.Table.from_batches(found)
    assert table["ids"][1].as_py() == [2, 4, 1, 3] and [len(x) for x in table["ids"].to_pylist()] == [n + 2, 4, n + 2]
    back = [b for x in found for b in tk._decoder(Sent, ["k"], [0, 2, 3])(iter([x]))]
    assert pa.Table.from_batches(back)["text"].to_pylist()[1] == "w [UNK]"


def test_words_are_split_slice_by_slice():
    rows = pa.array([["ab", "c"], None, [], ["c", "ab", "ab"]])
    known: dict[str, list[str]] = {}
    assert sw._slice_pieces(rows, list, known).to_pylist() == [["a", "b", "c"], None, [], ["c", "a", "b", "a", "b"]]
    assert sw._slice_pieces(rows.slice(1, 3), list, known).to_pylist() == [None, [], ["c", "a", "b", "a", "b"]]
