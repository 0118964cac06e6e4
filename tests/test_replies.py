from __future__ import annotations

import pytest

from lexloom.functions import replies as rp


def test_extract_reply(spark):
    cases = [
        (200, '{"response": " 1\\n"}', "1", "ok"),
        (200, '{"done": true}', "", "ok"),
        (200, '{"response": null}', "", "ok"),
        (200, "not json", None, "bad_json"),
        (404, '{"response": "1"}', None, "http_error"),
        (None, '{"response": "1"}', None, "http_error"),
        (200, None, None, "bad_json"),
    ]
    frame = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "i int, status int, body string")
    got = frame.orderBy("i").select(rp.extract_reply("status", "body").alias("r")).select("r.*").collect()
    assert [tuple(r) for r in got] == [c[2:] for c in cases]


@pytest.mark.parametrize(
    "reply, want",
    [
        ("<think>a</think>\n1", ("<think>a</think>", "1", "1", "closed")),
        ("<think>a</think> x </think> 0", ("<think>a</think>", "x </think> 0", "0", "closed")),
        ("<think>never", (None, None, None, "unclosed")),
        ("say <think>a</think>1", (None, "say <think>a</think>1", "say <think>a</think>1", "none")),
        ("1", (None, "1", "1", "none")),
        ("", (None, "", "", "none")),
        (None, (None, None, None, None)),
    ],
)
def test_split_reasoning(one, reply, want):
    assert tuple(one(rp.split_reasoning("r"), r=reply)) == want


@pytest.mark.parametrize(
    "reply, word, strict, char",
    [
        ("negative", 0, None, None),
        ("Negative", 1, None, None),
        ("positive", 1, None, None),
        ("", 1, None, None),
        ("0", 1, 0, 0),
        ("1", 1, 1, 1),
        ("1\n", 1, None, None),
        ("x", 1, None, 0),
        ("10", 1, None, None),
        (None, None, None, None),
    ],
)
def test_three_verdict_rules(one, reply, word, strict, char):
    for mode, want in (("word", word), ("strict", strict), ("char", char)):
        got = one(rp.parse_verdict("r", mode), r=reply)
        assert (got["verdict"], got["ok"]) == (want, want is not None), mode


def test_unknown_mode():
    with pytest.raises(ValueError):
        rp.parse_verdict("r", "other")
