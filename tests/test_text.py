from __future__ import annotations

import pytest

from lexloom.functions import text as tx

ODD = ["", "   ", "\t a\nb  c　", "x\x1cy\x85z", " lead", "trail ", "a  b", "plain"]


def rows(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")


def values(frame, column):
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def test_strip_and_tokens_match_python(spark):
    frame = rows(spark, ODD)
    assert values(frame, tx.strip("text")) == [t.strip() for t in ODD]
    assert values(frame, tx.ws_tokens("text")) == [t.split() for t in ODD]


def test_space_characters_are_those_of_python():
    assert set(tx.SPACE_CHARS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_null_text_stays_null(one):
    assert one(tx.ws_tokens("t"), t=None) is None
    assert one(tx.strip("t"), t=None) is None
    assert one(tx.with_prefix("p ", "t"), t=None) is None


def test_split_fields_is_literal_and_keeps_trailing_empty(one):
    assert one(tx.split_fields("t", "\t"), t="1\tDawn\t") == ["1", "Dawn", ""]
    assert one(tx.split_fields("t", "."), t="a.b") == ["a", "b"]


def test_template_is_literal(one):
    template = "x [DOCUMENT] y [DOCUMENT] z"
    nasty = r"cost $1 \ [DOCUMENT] \1"
    assert one(tx.fill_template(template, {"[DOCUMENT]": "t"}), t=nasty) == f"x {nasty} y {nasty} z"


def test_template_with_two_slots(one):
    assert one(tx.fill_template("[A]-[B]", {"[A]": "a", "[B]": "b"}), a="[B]", b="2") == "[B]-2"


@pytest.mark.parametrize("text", ["a\n\n   \n  b", "a\r\n\r\nb\rc", "\n\n", "", "a\x0bb\x0c c\x85", "last\n"])
def test_blank_lines(one, text):
    want = "\n".join(line for line in text.splitlines() if line.strip())
    assert one(tx.drop_blank_lines("t"), t=text) == want


def test_clip_counts_characters(one):
    assert one(tx.clip_text("t", 3), t="äöü€") == "äöü"
    assert one(tx.n_chars("t"), t="äöü€") == 4


def test_leading_space_marks(one):
    assert one(tx.mark_leading_space(tx.ws_tokens("t")), t="the dog ran") == ["the", "Ġdog", "Ġran"]


def test_item_line_and_its_fields(spark):
    frame = spark.createDataFrame(
        [("0", "Dawn", "Some Band"), ("1", "Dawn - Live", "A: B"), ("2", None, None)],
        "i string, title string, artist string",
    )
    lines = values(frame, tx.describe_item("i", "artist", "title"))
    assert lines[0] == "id: 0 - artist: Some Band - title: Dawn"
    assert lines[2] == "id: 2 - artist:  - title: "
    described = frame.withColumn("d", tx.describe_item("i", "artist", "title"))
    assert values(described, tx.pick_field("d", " - ", 2))[0] == "Dawn"
    # names that hold a separator are cut, as documented
    assert values(described, tx.pick_field("d", " - ", 2))[1] == "Dawn"
    assert values(described, tx.pick_field("d", " - ", 1))[1] == "A"


@pytest.mark.parametrize("token", [" the", "a\tb", "x\ny", "it's", 'say "x"', "b\\n", "both ' and \"", "plain"])
def test_show_token_matches_repr(one, token):
    assert one(tx.show_token("t"), t=token) == repr(token)


def test_numbers_and_padding(spark):
    frame = spark.createDataFrame([(0, 0.1234, "ab")], "i int, p double, t string")
    assert values(frame, tx.fmt_prob("p")) == ["12.34"]
    assert values(frame, tx.fmt_score("p", 3)) == ["0.123"]
    assert values(frame, tx.pad_right("t", 4)) == ["ab  "]
    assert values(frame, tx.pad_left("t", 4)) == ["  ab"]
    assert values(frame, tx.pad_right("t", 1)) == ["ab"]
