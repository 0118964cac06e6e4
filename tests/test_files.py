from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from lexloom.operators import frames as fr
from lexloom.operators.batches import map_batches, score_with_status
from lexloom.operators.chat import chat_lines
from lexloom.operators.sequences import drop_short
from lexloom.sources import files as fl


def test_sequence_files_skip_headers_per_file(spark, tmp_path):
    (tmp_path / "one.txt").write_text("meta1\nmeta2\n1 2 3 \n\n7\n4 5\n")
    (tmp_path / "two.txt").write_text("m\nm\n8 9")
    rows = drop_short(fl.read_sequences(spark, str(tmp_path))).orderBy("source", "block_start", "line").collect()
    assert [(r["source"].rsplit("/", 1)[1], r["items"]) for r in rows] == [
        ("one.txt", ["1", "2", "3"]), ("one.txt", ["4", "5"]), ("two.txt", ["8", "9"]),
    ]


def test_large_sequence_files_are_split(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("header\nheader\n" + "".join(f"{name}{k} x\n" for k in range(2000)))
    sizes = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        frame = fl.read_sequences(spark, str(tmp_path))
        assert frame.select("source", "block_start").distinct().count() >= 6
        rows = frame.orderBy("source", "block_start", "line").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r["items"] for r in rows] == [[f"{name}{k}", "x"] for name in ("a", "b") for k in range(2000)]
    assert [r["line"] for r in rows] == [*range(2, 2002)] * 2


@pytest.mark.parametrize("split", ["16", "100", "1g"])
def test_lines_are_numbered_over_the_whole_file_whatever_the_splits(spark, tmp_path, split):
    texts = {"a": "h" * 300 + "\n\nx 1\n" + "\n" * 40 + "last", "b": "one\n", "c": "", "d": "\n\n\n", "e": "no end é"}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    sizes = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        got = sorted((r["source"].rsplit("/", 1)[1][0], r["line"], r["value"]) for r in fl.numbered_lines(spark, str(tmp_path)).collect())
        kept = fl.read_sequences(spark, str(tmp_path)).where("size(items) > 0").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == [(name, k, x) for name, text in sorted(texts.items()) for k, x in enumerate(text.splitlines())]
    # the second header line is in a later split than the first
    assert sorted(r["items"] for r in kept) == [["last"], ["x", "1"]]


def test_catalog_file(spark, tmp_path):
    (tmp_path / "songs.tsv").write_text('0\tDawn - Live\tA: B\n1\tNo "quotes\t\n2\tshort\n\n')
    rows = fl.read_catalog(spark, str(tmp_path / "songs.tsv")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("0", "Dawn - Live", "A: B"), ("1", 'No "quotes', None), ("2", "short", None)]


def test_vector_files(spark, tmp_path):
    (tmp_path / "v.txt").write_text("king 0.5 -1.0\nqueen 1 2\n")
    rows = fl.read_vectors(spark, str(tmp_path / "v.txt"), text_form=True).orderBy("key").collect()
    assert [tuple(r) for r in rows] == [("king", [0.5, -1.0]), ("queen", [1.0, 2.0])]
    table = spark.createDataFrame([("k", [1.0])], fl.VECTOR_SCHEMA)
    table.write.parquet(str(tmp_path / "p"))
    assert tuple(fl.read_vectors(spark, str(tmp_path / "p")).first()) == ("k", [1.0])


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "copy")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, split string")
    assert fl.write_if_absent(first, path, ["split"]).count() == 2
    other = spark.createDataFrame([(3, "c")], "k int, split string")
    kept = fl.write_if_absent(other, path, ["split"])
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a"), (2, "b")]
    assert fl.take_split(kept, "a").count() == 1


def test_unfinished_copy_is_not_used(spark, tmp_path):
    (tmp_path / "half").mkdir()
    with pytest.raises(FileExistsError):
        fl.write_if_absent(spark.createDataFrame([(1,)], "k int"), str(tmp_path / "half"))


def test_inline_and_projection(spark):
    table = fl.inline_table(spark, [(0, "neg"), (1, "pos")], "label int, name string")
    assert fl.project_key(table, "name", key="label").columns == ["label", "name"]


def test_report_lines(spark):
    frame = spark.createDataFrame([("king", 0.98765), ("a word too long", 0.5)], "word string, sim double")
    spec = [("word", 6, "<"), ("sim", 10, ">.4")]
    lines = [r["line"] for r in fr.format_report(frame, spec).orderBy("word").collect()]
    assert lines == ["a word too long |     0.5000", "king   |     0.9877"] or lines[1].startswith("king   |")
    assert fr.report_header(spec, ["Word", "Similarity"]) == ["Word   | Similarity", "-" * 19]


def test_ranking_and_preview(spark):
    frame = spark.createDataFrame([("g", "b", 1), ("g", "a", 1), ("g", "c", 3), ("h", "d", 0)], "g string, k string, n int")
    ranked = {r["k"]: r["rank"] for r in fr.rank_hits(frame, "g", "n", "k").collect()}
    assert ranked == {"c": 1, "a": 2, "b": 3, "d": 1}
    assert [r["k"] for r in fr.top_n(frame, 2, "n", "k").collect()] == ["c", "a"]
    assert [r["k"] for r in fr.preview(frame, 2, "k").collect()] == ["a", "b"]
    best = fr.argmax_rows(spark.createDataFrame([("x", 2, 1.0), ("x", 1, 1.0)], "d string, l int, s double"), ["d"], "l", "s")
    assert tuple(best.first()) == ("x", 1, 1.0)
    named = spark.createDataFrame([("x", "b", 2.0), ("x", "a", 2.0), ("x", "c", 1.0)], "d string, l string, s double")
    assert tuple(fr.argmax_rows(named, ["d"], "l", "s").first()) == ("x", "a", 2.0)


def test_unnest_keeps_null_elements(spark):
    frame = spark.createDataFrame([(1, ["a", None, "b"]), (2, []), (3, None)], "k int, t array<string>")
    assert [r["token"] for r in fr.unnest(frame, "t", "k").collect()] == ["a", None, "b"]
    assert [(r["pos"], r["token"]) for r in fr.unnest(frame, "t", "k", pos="pos").collect()] == [(0, "a"), (1, None), (2, "b")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_and_checked_joins_equal_plain_join(spark, how):
    left = spark.range(500).selectExpr("id AS k", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id % 40 AS string) END AS w")
    right = spark.range(20).selectExpr("cast(id AS string) AS w", "id AS v").union(spark.sql("SELECT 'hot', 99L"))
    plain = left.join(right, "w", how)
    want = sorted(map(repr, plain.collect()))
    for joined in (fr.salted_join(left, right, "w", "k", how), fr.checked_join(left, right, "w", "k", how), fr.checked_join(left, right, "w", "k", how, most=5)):
        assert sorted(map(repr, joined.select(plain.columns).collect())) == want


def test_chat_lines(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(2500)] + [(2, 0, "system", "s")]
    frame = spark.createDataFrame(rows, "conv_id int, turn bigint, role string, text string").repartition(3)
    lines = {c: [r["line"] for r in chat_lines(frame).where(f"conv_id = {c}").orderBy("turn").collect()] for c in (1, 2)}
    assert lines[2] == ["<|system|>s", "<|assistant|>"]
    assert len(lines[1]) == 2501 and lines[1][:2] == ["<|user|>m0", "<|assistant|>m1"] and lines[1][-1] == "<|assistant|>"


def test_map_batches_builds_once_and_keeps_rows(spark):
    frame = spark.range(1000).repartition(2)

    def make():
        state = {"calls": 0}

        def run(batch):
            state["calls"] += 1
            return batch[["id"]].rename(columns={"id": "double"}) * 2

        return run

    got = map_batches(frame, make, "double bigint").collect()
    assert sorted((r["id"], r["double"]) for r in got) == [(i, 2 * i) for i in range(1000)]


def test_map_batches_refuses_lost_rows(spark):
    with pytest.raises(Exception, match="rows for"):
        map_batches(spark.range(10).coalesce(1), lambda: (lambda b: b.head(1)), "x bigint").collect()


def test_score_with_status(spark):
    frame = spark.createDataFrame([("a",), ("bad",), (None,)], "t string")

    def make():
        def call(t):
            if t == "bad":
                raise KeyError(t)
            return t.upper()

        return call

    got = {r["t"]: (r["result"], r["ok"], r["error"]) for r in score_with_status(frame, "t", make).collect()}
    assert got == {"a": ("A", True, None), "bad": (None, False, "KeyError"), None: (None, False, "AttributeError")}


def test_of_two_writers_at_once_one_wins(spark, tmp_path):
    gate = threading.Barrier(4)

    def write(k):
        gate.wait()
        return sorted(r["k"] for r in fl.write_if_absent(spark.range(200).selectExpr(f"{k} AS k", "id"), path).collect())

    for turn in range(3):
        path = str(tmp_path / f"raced{turn}")
        with ThreadPoolExecutor(4) as pool:
            got = list(pool.map(write, range(4)))
        assert all(g == got[0] for g in got) and len(got[0]) == 200 and len(set(got[0])) == 1
        assert [p.name for p in tmp_path.iterdir() if "staged" in p.name] == []


def test_a_copy_that_came_meanwhile_is_left_alone(spark, tmp_path):
    staged, taken = tmp_path / "mine", tmp_path / "taken"
    spark.range(3).write.parquet(str(staged))
    spark.range(5).write.parquet(str(taken))
    assert not fl._put_if_absent(spark, str(staged), str(taken))
    assert spark.read.parquet(str(taken)).count() == 5 and staged.exists()
    assert fl._put_if_absent(spark, str(staged), str(tmp_path / "free")) and not staged.exists()
