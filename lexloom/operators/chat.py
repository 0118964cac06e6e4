"""Conversations as the lines of rendered prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How a role is marked in a rendered chat, and the role that is asked to go on.
ROLE_FORMAT = ("<|", "|>")
NEXT_ROLE = "assistant"


def chat_lines(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``(conv, turn, line)``: each message with its role's marker, then the next role's marker.

    A prompt is the lines of its conversation in turn order; the marker stands one turn behind the last
    message. A conversation of any length stays spread over its lines: only its last turn is aggregated.
    """
    opening, closing = ROLE_FORMAT
    said = F.concat(F.lit(opening), "role", F.lit(closing), "text")
    lines = messages.select(conv, F.col(turn).cast("bigint").alias(turn), said.alias("line"))
    marker = F.lit(f"{opening}{NEXT_ROLE}{closing}")
    ends = messages.groupBy(conv).agg((F.max(turn) + 1).cast("bigint").alias(turn)).withColumn("line", marker)
    return lines.unionByName(ends)
