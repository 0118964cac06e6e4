"""Reading a growing folder and labelling its rows as they arrive.

Only stateless steps are used (prompt, reply, reasoning, verdict), so there is no state, no
watermark and no shuffle; every micro-batch is a map over its new rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions.replies import extract_reply, parse_verdict, split_reasoning


def stream_folder(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New Parquet files of a folder as a stream; the schema is stated, never inferred."""
    return spark.readStream.schema(schema).parquet(folder)


def verdicts(replies: DataFrame, mode: str = "char", key: str = "doc_id") -> DataFrame:
    """``(key, state, reasoning_status, verdict, ok)`` of model replies, batch or stream."""
    extracted = replies.select(key, extract_reply("status", "body").alias("r"))
    split = extracted.select(
        key, F.col("r.state").alias("state"), split_reasoning(F.col("r.reply")).alias("a")
    )
    return split.select(
        key,
        "state",
        F.col("a.status").alias("reasoning_status"),
        parse_verdict(F.col("a.answer_last_char"), mode).alias("v"),
    ).select(key, "state", "reasoning_status", "v.*")


def write_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there now, append it to a Parquet folder, and stop.

    ``checkpoint`` lies in a folder all executors reach; with it a restarted run takes up new
    files only.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
