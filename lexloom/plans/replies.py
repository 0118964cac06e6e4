"""Model replies: extraction, reasoning, verdicts; conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import replies as rp
from lexloom.operators.chat import chat_lines
from lexloom.plans.registry import REPLIES, Registry
from lexloom.sources import tables as tb

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles


def _reply_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = tb.replies(spark, sf_dir).select(
        "doc_id", "status", rp.extract_reply("status", "body").alias("r")
    )
    return extracted.select("doc_id", "status", "r.reply", "r.state")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reply_text(spark, sf_dir).select(
        "doc_id", "reply", rp.split_reasoning("reply").alias("a")
    ).select("doc_id", "reply", "a.*")


@_R.add(f"WITH {REPLIES} SELECT doc_id, status, reply, state FROM reply_text")
def reply_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reply_text(spark, sf_dir)


ANSWERS = REPLIES + r""",
answers AS (
  SELECT doc_id, reply,
         CASE WHEN closed THEN left(reply, cut + 7) END AS reasoning,
         CASE WHEN closed THEN trim(substring(reply, cut + 8), E' \t\n\r') WHEN NOT opened THEN reply END AS answer,
         CASE WHEN closed THEN right(reply, 1) WHEN NOT opened THEN reply END AS answer_last_char,
         CASE WHEN closed THEN 'closed' WHEN opened THEN 'unclosed' WHEN reply IS NOT NULL THEN 'none' END AS status
  FROM (SELECT doc_id, reply, starts_with(reply, '<think>') AS opened, position('</think>' IN reply) AS cut,
               starts_with(reply, '<think>') AND position('</think>' IN reply) > 0 AS closed
        FROM reply_text))"""


@_R.add(f"WITH {ANSWERS} SELECT doc_id, reasoning, answer, answer_last_char, status FROM answers")
def reasoning_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).drop("reply")


def _verdict(df: DataFrame, column: str, mode: str) -> DataFrame:
    return df.select("doc_id", rp.parse_verdict(column, mode).alias("v")).select("doc_id", "v.*")


@_R.add(
    f"""WITH {REPLIES}
    SELECT doc_id, CASE WHEN reply = 'negative' THEN 0 WHEN reply IS NOT NULL THEN 1 END AS verdict,
           reply IS NOT NULL AS ok FROM reply_text"""
)
def verdict_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdict(_reply_text(spark, sf_dir), "reply", "word")


@_R.add(
    f"""WITH {REPLIES}, raw AS (
      SELECT doc_id, CASE WHEN status = 200 THEN json_extract_string(body, '$.response') END AS reply FROM replies)
    SELECT doc_id, CASE WHEN reply = '1' THEN 1 WHEN reply = '0' THEN 0 END AS verdict,
           coalesce(reply IN ('0', '1'), false) AS ok FROM raw"""
)
def verdict_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On the unstripped reply: a trailing newline is rejected."""
    raw = tb.replies(spark, sf_dir).select(
        "doc_id", F.when(F.col("status") == 200, F.get_json_object("body", "$.response")).alias("reply")
    )
    return _verdict(raw, "reply", "strict")


@_R.add(
    f"""WITH {ANSWERS}
    SELECT doc_id, CASE WHEN length(answer_last_char) = 1
                        THEN CASE WHEN answer_last_char = '1' THEN 1 ELSE 0 END END AS verdict,
           coalesce(length(answer_last_char) = 1, false) AS ok FROM answers"""
)
def verdict_char(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdict(_answers(spark, sf_dir), "answer_last_char", "char")


@_R.add(
    """SELECT conv_id, turn, '<|' || role || '|>' || text AS line FROM conversations
    UNION ALL SELECT conv_id, max(turn) + 1, '<|assistant|>' FROM conversations GROUP BY conv_id"""
)
def chat_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_lines(tb.messages(spark, sf_dir))
