"""Every registered query against its SQL, and the plans that must hold at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from lexloom import plans
from lexloom.sources import tables as tb
from tools.check_oracles import compare, connect

WITHOUT_SQL = {"logistic_predictions", "similar_approx", "held_out_compare"}
# these run jobs of their own before they return a frame
TRAINED = {"similar_all_cells", "subword_merges", "subword_pieces", "item_vectors", "logistic_gradient", "logistic_follows"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    line = compare(name, spark, con, sf_dir)
    assert line.startswith("ok"), line


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert plans.QUERIES[name](spark, sf_dir).count() > 0


def test_contract(spark):
    assert set(plans.QUERIES) - set(plans.ORACLES) == WITHOUT_SQL
    assert set(plans.QUERIES) <= set(contract.queries()) and set(plans.ORACLES) <= set(contract.oracle_sql())
    assert contract.entry(spark).columns == ["model", "row", "precision", "recall", "f1", "support"]


def explained(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - WITHOUT_SQL - TRAINED))
def test_no_cross_joins(spark, sf_dir, name):
    plan = explained(plans.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = explained(plans.QUERIES["top_items"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint>" in plan
    plan = explained(tb.read_table(spark, sf_dir, "documents").filter("doc_id = 3").select("lang"))
    assert "EqualTo(doc_id,3)" in plan and "struct<doc_id:bigint,lang:string>" in plan


@pytest.mark.parametrize("name", ["prompt_column", "template_fill", "clip_and_length", "score_classifier", "topk_dims"])
def test_row_wise_queries_do_not_aggregate_or_join(spark, sf_dir, name):
    plan = explained(plans.QUERIES[name](spark, sf_dir))
    assert "Aggregate" not in plan and "Join" not in plan
