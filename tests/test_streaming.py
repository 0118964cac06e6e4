from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.operators.batches import map_batches
from lexloom.operators.classify import add_prompt
from lexloom.sources import tables as tb
from lexloom.streaming.stateless import stream_folder, verdicts, write_available


def test_stream_equals_batch_and_restarts(spark, sf_dir, tmp_path):
    replies = tb.replies(spark, sf_dir)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    half = F.col("doc_id") % 2 == 0
    replies.filter(half).write.parquet(folder)
    schema = "doc_id bigint, status int, body string"
    write_available(verdicts(stream_folder(spark, folder, schema)), out, state)
    assert spark.read.parquet(out).count() == replies.filter(half).count()
    replies.filter(~half).write.mode("append").parquet(folder)
    write_available(verdicts(stream_folder(spark, folder, schema)), out, state)
    batch = verdicts(replies)
    streamed = spark.read.parquet(out).select(batch.columns)
    assert sorted(map(repr, streamed.collect())) == sorted(map(repr, batch.collect()))


def test_prompts_and_batch_models_on_a_stream(spark, sf_dir, tmp_path):
    source = f"{sf_dir}/documents.parquet"
    tb.read_table(spark, sf_dir, "documents").write.parquet(str(tmp_path / "docs"))
    stream = stream_folder(spark, str(tmp_path / "docs"), tb.SCHEMAS["documents"])

    def make():
        return lambda batch: batch[["prompt"]].map(len).rename(columns={"prompt": "size"})

    def plan(df):
        return map_batches(add_prompt(df).select("doc_id", "prompt"), make, "size bigint")

    write_available(plan(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    batch = plan(spark.read.schema(tb.SCHEMAS["documents"]).parquet(source))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
