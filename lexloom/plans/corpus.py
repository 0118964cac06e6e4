"""Reviews, splits, previews, prompts, lines, written copies, batch models."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import text as tx
from lexloom.operators.batches import map_batches, score_with_status
from lexloom.operators.classify import SENTIMENT_PROMPT, add_prompt
from lexloom.operators.frames import format_report, preview, top_n
from lexloom.operators.metrics import class_counts as count_classes
from lexloom.operators.metrics import count_rows
from lexloom.plans.registry import EDGE_SPACE, REPLIES, REVIEWS, Registry, words
from lexloom.session import shared_folder
from lexloom.sources import tables as tb
from lexloom.sources.files import inline_table, project_key, take_split, write_if_absent

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles

# The prompt template of the scoring task and its slot.
REVIEW_TEMPLATE = (
    "Predict whether the following document is a positive or negative movie review:\n\n"
    "[DOCUMENT]\n\n"
    "If it is positive return 1 and if it is negative return 0. Do not give any\nother answers.\n"
)
REVIEW_SLOT = "[DOCUMENT]"
# Names of the labels 0 and 1.
LABEL_NAMES = {0: "Negative Review", 1: "Positive Review"}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@_R.add(f"WITH {REVIEWS} SELECT split, count(*) AS n FROM reviews GROUP BY split")
def reviews_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(tb.reviews(spark, sf_dir))


@_R.add(f"WITH {REVIEWS} SELECT doc_id, label, length(text) AS n_chars FROM reviews WHERE split = 'test'")
def held_out_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = take_split(tb.reviews(spark, sf_dir), "test")
    return test.select("doc_id", "label", tx.n_chars("text").cast("bigint").alias("n_chars"))


@_R.add(
    f"""WITH {REVIEWS}
    SELECT split, count(*) FILTER (label = 1) AS positive, count(*) FILTER (label = 0) AS negative,
           count(*) FILTER (label IS NULL OR label NOT IN (0, 1)) AS unrecognised
    FROM reviews GROUP BY split"""
)
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_classes(tb.reviews(spark, sf_dir))


@_R.add(f"WITH {REVIEWS} SELECT doc_id, text, label, split FROM reviews ORDER BY doc_id LIMIT 5")
def preview_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(tb.reviews(spark, sf_dir), 5, "doc_id")


@_R.add(f"WITH {REVIEWS} SELECT doc_id, text FROM reviews")
def project_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_key(tb.reviews(spark, sf_dir), "text")


@_R.add(
    f"""WITH {REVIEWS}, names(label, name) AS (VALUES (0, 'Negative Review'), (1, 'Positive Review'))
    SELECT name, count(*) AS n FROM reviews JOIN names USING (label) GROUP BY name"""
)
def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = inline_table(spark, list(LABEL_NAMES.items()), "label int, name string")
    counts = tb.reviews(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(names, "label").select("name", "n")


@_R.add(f"SELECT doc_id, {_quoted(SENTIMENT_PROMPT)} || text AS prompt FROM documents")
def prompt_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_prompt(tb.docs(spark, sf_dir)).select("doc_id", "prompt")


@_R.add(
    f"""SELECT doc_id, replace({_quoted(REVIEW_TEMPLATE)}, {_quoted(REVIEW_SLOT)}, text) AS prompt
    FROM documents"""
)
def template_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = tx.fill_template(REVIEW_TEMPLATE, {REVIEW_SLOT: "text"})
    return tb.docs(spark, sf_dir).select("doc_id", filled.alias("prompt"))


@_R.add(
    f"""SELECT doc_id, array_to_string(list_filter(
             regexp_split_to_array(text, '{tx.LINE_BREAKS}'),
             lambda l: regexp_replace(l, '{EDGE_SPACE}', '', 'g') <> ''), chr(10)) AS text
    FROM documents"""
)
def blank_lines_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.docs(spark, sf_dir).select("doc_id", tx.drop_blank_lines("text").alias("text"))


@_R.add(
    "SELECT doc_id, substring(text, 1, 300) AS opening, length(text) AS n_chars FROM documents"
)
def clip_and_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.docs(spark, sf_dir).select(
        "doc_id",
        tx.clip_text("text", 300).alias("opening"),
        tx.n_chars("text").cast("bigint").alias("n_chars"),
    )


@_R.add(
    f"""SELECT doc_id, len({words('text')}) AS n_tokens, regexp_replace(text, '{EDGE_SPACE}', '', 'g') AS stripped,
           len(string_split(text, chr(10))) AS n_lines
    FROM documents"""
)
def ws_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.docs(spark, sf_dir).select(
        "doc_id",
        F.size(tx.ws_tokens("text")).cast("bigint").alias("n_tokens"),
        tx.strip("text").alias("stripped"),
        F.size(tx.split_fields("text", "\n")).cast("bigint").alias("n_lines"),
    )


@_R.add(
    f"""WITH {REVIEWS}, c AS (SELECT split, count(*) AS n FROM reviews GROUP BY split)
    SELECT split, n, rpad(split, 12, ' ') || ' | ' || lpad(n::VARCHAR, 8, ' ') AS line FROM c"""
)
def formatted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_report(count_rows(tb.reviews(spark, sf_dir)), [("split", 12, "<"), ("n", 8, ">")])


@_R.add("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10")
def top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tb.read_table(spark, sf_dir, "documents")
    return top_n(count_rows(docs, "source"), 10, "n", "source")


@_R.add(f"WITH {REVIEWS} SELECT doc_id, text, label, split FROM reviews")
def write_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews as written to the shared folder once and read back."""
    tag = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    path = f"{shared_folder(spark)}/reviews-{spark.sparkContext.applicationId}-{tag}"
    return write_if_absent(tb.reviews(spark, sf_dir), path, partition_by=["split"])


def _letter_model():
    """A stand-in batch model: text length and number of the letter e."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"n_chars": batch["text"].str.len().astype("int64"), "n_e": batch["text"].str.count("e").astype("int64")}
        )

    return run


@_R.add(
    """SELECT doc_id, length(text) AS n_chars,
           (length(text) - length(replace(text, 'e', '')))::BIGINT AS n_e FROM documents"""
)
def batch_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_batches(tb.docs(spark, sf_dir), _letter_model, "n_chars bigint, n_e bigint").select("doc_id", "n_chars", "n_e")


def _json_number_model():
    """A stand-in row model that fails on every reply that is not a plain number."""

    def run(body: str) -> str:
        return str(int(json.loads(body)["response"].strip()))

    return run


@_R.add(
    f"""WITH {REPLIES}
    SELECT doc_id,
           CASE WHEN reply IN ('0', '1') THEN reply END AS result,
           coalesce(reply IN ('0', '1'), false) AS ok,
           CASE WHEN reply IN ('0', '1') THEN NULL
                WHEN doc_id % 8 = 6 THEN 'KeyError'
                WHEN doc_id % 8 = 7 THEN 'JSONDecodeError'
                ELSE 'ValueError' END AS error
    FROM reply_text"""
)
def batch_map_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_with_status(tb.replies(spark, sf_dir), "body", _json_number_model)
    return scored.select("doc_id", "result", "ok", "error")
