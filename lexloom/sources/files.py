"""Files: sequence lines, tab-separated catalogs, vector tables, write-once copies."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.text import ws_tokens
from lexloom.operators.frames import checked_join, unnest

CATALOG_SCHEMA = "id string, title string, artist string"
VECTOR_SCHEMA = "key string, vec array<float>"


def sequences_from_text(df: DataFrame, source: str, text: str, skip: int = 2) -> DataFrame:
    """One sequence per line of each text; the first ``skip`` lines of every text are headers.

    Result: ``(source, line_no, items)`` with 0-based line numbers counted over all lines.
    Lines stay where their text is read, so nothing is shuffled.
    """
    lines = unnest(df, F.split(text, "\n", -1), source, name="line", pos="line_no")
    return lines.filter(F.col("line_no") >= skip).select(
        source, "line_no", ws_tokens("line").alias("items")
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files: ``(source, block_start, line, value)`` with 0-based numbers over the whole file.

    Files are read split by split. A first pass counts the lines of each split; the counts of a file's earlier splits,
    one row each, are what a split's own numbers start from. Empty lines count, an empty file has none.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    lines = lines.withColumn("_block", F.concat_ws(":", "block_start", "source"))
    # ids are consecutive inside a split
    blocks = lines.groupBy("source", "block_start", "_block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy("source").orderBy("block_start")
    shifts = blocks.select("_block", (F.sum("n").over(up_to) - F.col("n") - F.col("first")).alias("_shift"))
    joined = checked_join(lines, shifts, "_block", by="id")
    return joined.select("source", "block_start", (F.col("id") + F.col("_shift")).alias("line"), "value")


def read_sequences(spark: SparkSession, path: str, skip: int = 2) -> DataFrame:
    """Sequence files, one sequence per line, without the first ``skip`` (header) lines of each file.

    Result: ``(source, block_start, line, items)``; ``line`` is the line's number in its file, headers counted.
    """
    kept = numbered_lines(spark, path).filter(F.col("line") >= skip)
    return kept.select("source", "block_start", "line", ws_tokens("value").alias("items"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``id, title, artist`` without header; missing fields are null."""
    return (
        spark.read.schema(CATALOG_SCHEMA)
        .option("sep", "\t")
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .csv(path)
        .filter(F.col("id").isNotNull())
    )


def read_vectors(spark: SparkSession, path: str, text_form: bool = False) -> DataFrame:
    """A ``(key, vec)`` table from Parquet, or from lines of ``key v1 v2 …``."""
    if not text_form:
        return spark.read.schema(VECTOR_SCHEMA).parquet(path)
    parts = F.split("value", " ")
    return spark.read.text(path).select(
        parts[0].alias("key"),
        F.slice(parts, F.lit(2), F.size(parts) - 1).cast("array<float>").alias("vec"),
    )


def inline_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(rows, schema)


def write_if_absent(
    df: DataFrame, path: str, partition_by: list[str] | None = None
) -> DataFrame:
    """Write Parquet unless ``path`` holds a finished copy, then read that copy back.

    The copy is written beside ``path`` and renamed to it in one step that fails if ``path`` is there by then. Of two
    writers at once one wins; the other drops its own copy and reads the winner's. Nobody sees half a copy, and a
    writer that dies leaves only a staged folder. The step is atomic on local disks and on HDFS; a store without
    atomic renames of folders gives no such promise.

    A path without the success marker belongs to somebody else; it is neither used nor overwritten.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    if not _exists(spark, path):
        staged = f"{path}.staged-{uuid.uuid4().hex}"
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
        if not _put_if_absent(spark, staged, path):
            _file_system(spark, staged).delete(spark._jvm.org.apache.hadoop.fs.Path(staged), True)
    if not _exists(spark, path + "/_SUCCESS"):
        raise FileExistsError(f"{path} exists without a success marker")
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _put_if_absent(spark: SparkSession, staged: str, path: str) -> bool:
    """Rename a written folder; False if ``path`` exists, which is left as it is."""
    jvm = spark._jvm
    system = _file_system(spark, path)
    source, target = (system.makeQualified(jvm.org.apache.hadoop.fs.Path(p)) for p in (staged, path))
    if system.getUri().getScheme() == "file":
        # the system's own rename, which refuses a folder that holds something
        return jvm.java.io.File(source.toUri().getPath()).renameTo(jvm.java.io.File(target.toUri().getPath()))
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration()).rename(source, target, options)
    except Py4JJavaError as failure:
        if "FileAlreadyExistsException" in str(failure.java_exception):
            return False
        raise
    return True


def _exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def take_split(df: DataFrame, name: str, column: str = "split") -> DataFrame:
    """One split; prunes partitions when the table is partitioned by it."""
    return df.filter(F.col(column) == name)


def project_key(df: DataFrame, column: str | Column, key: str = "doc_id") -> DataFrame:
    """One column together with its key."""
    return df.select(key, column)
