"""Columns over model replies: HTTP body -> text -> reasoning and answer -> verdict."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.functions.text import _col, strip

# The tags around a model's reasoning.
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"


def extract_reply(status: Column | str, body: Column | str) -> Column:
    """struct<reply, state> of a model HTTP reply.

    ``ok``: status 200 and a JSON body; a missing or null ``response`` is empty text.
    ``http_error``: any other status. ``bad_json``: a body that does not parse.
    """
    code, text = _col(status), _col(body)
    parsed = F.try_parse_json(text)
    reply = strip(F.coalesce(F.get_json_object(text, "$.response"), F.lit("")))
    failed = F.coalesce(code != 200, F.lit(True))
    state = F.when(failed, "http_error").when(parsed.isNull(), "bad_json").otherwise("ok")
    return F.struct(
        F.when(~failed & parsed.isNotNull(), reply).alias("reply"), state.alias("state")
    )


def split_reasoning(reply: Column | str) -> Column:
    """struct<reasoning, answer, answer_last_char, status> of a stripped reply.

    A reply that opens with the reasoning tag is cut behind the first closing tag. ``status``
    is ``none``, ``closed``, ``unclosed`` (no closing tag: no answer) or null for a null reply.
    """
    text = _col(reply)
    opened = F.startswith(text, F.lit(THINK_OPEN))
    at = F.locate(THINK_CLOSE, text)
    behind = at + F.lit(len(THINK_CLOSE))
    closed = opened & (at > 0)
    return F.struct(
        F.when(closed, F.substring(text, F.lit(1), behind - 1)).alias("reasoning"),
        F.when(closed, strip(F.substring(text, behind, F.length(text))))
        .when(~opened, text)
        .alias("answer"),
        F.when(closed, F.right(text, F.lit(1))).when(~opened, text).alias("answer_last_char"),
        F.when(closed, "closed").when(opened, "unclosed").when(text.isNotNull(), "none").alias("status"),
    )


def parse_verdict(reply: Column | str, mode: str) -> Column:
    """struct<verdict, ok>: three different rules that must stay apart.

    ``word``: exactly ``negative`` is 0, any other text is 1.
    ``strict``: exactly ``0`` or ``1``, unstripped; anything else is rejected.
    ``char``: one character; ``1`` is 1, any other single character is 0, else rejected.
    A null reply is rejected in every mode.
    """
    text = _col(reply)
    if mode == "word":
        verdict = F.when(text == "negative", 0).when(text.isNotNull(), 1)
    elif mode == "strict":
        verdict = F.when(text == "1", 1).when(text == "0", 0)
    elif mode == "char":
        verdict = F.when(F.char_length(text) == 1, F.when(text == "1", 1).otherwise(0))
    else:
        raise ValueError(f"unknown verdict mode {mode!r}")
    return F.struct(verdict.alias("verdict"), verdict.isNotNull().alias("ok"))
