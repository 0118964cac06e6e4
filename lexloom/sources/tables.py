"""The given Parquet tables and the views that the queries are written on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions.vectors import softmax
from lexloom.operators.sequences import ordered_positions
from lexloom.session import ship_package, spread

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_name(key: str = "doc_id") -> Column:
    """Train, validation and test by the last digit of the key (8 : 1 : 1)."""
    digit = F.col(key) % 10
    return F.when(digit < 8, "train").when(digit == 8, "validation").otherwise("test")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled texts ``(doc_id, text, label, split)``; label 0 is negative, 1 is positive.

    The join key is unique on both sides and carries no broadcast hint: Spark broadcasts the
    labels while they are under its size threshold and sort-merges them beyond it.
    """
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return (
        docs(spark, sf_dir)
        .join(labels, "doc_id")
        .withColumn("split", split_name())
    )


def docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents; in test and bench sessions over all cores."""
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", *columns), "doc_id")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("key"), F.col("embedding").alias("vec"), "label"
    )


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog ``(id, title, artist)``."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist"),
    )


def playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as item sequences in long form ``(seq_id, pos, item, n_items)``."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("seq_id"),
        F.col("l_shipdate").alias("day"),
        F.col("l_linenumber").alias("line"),
        "l_partkey",
    )
    return ordered_positions(lines, "seq_id", "day", ["line", "l_partkey"]).select(
        "seq_id", "pos", F.col("l_partkey").cast("string").alias("item"), "n_items"
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "conversations")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three class scores per vector (negative, neutral, positive) and a 0/1 truth."""
    return vectors(spark, sf_dir).select(
        "key",
        softmax(F.slice("vec", 1, 3)).alias("scores"),
        (F.col("label") % 2).alias("truth"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model HTTP replies ``(doc_id, status, body)`` derived from the labels, good and bad ones."""
    kind = F.col("doc_id") % 8
    v = F.col("quality").cast("string")

    def body(*parts: Column | str) -> Column:
        cells = [F.lit(p) if isinstance(p, str) else p for p in parts]
        return F.concat(F.lit('{"response": "'), *cells, F.lit('"}'))

    return read_table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(kind == 7, 500).otherwise(200).alias("status"),
        F.when(kind < 2, body(v))
        .when(kind == 2, body(v, r"\n"))
        .when(kind == 3, body(r"<think>weighing\nboth sides</think>\n", v))
        .when(kind == 4, body("<think>still weighing"))
        .when(kind == 5, body("The review is positive"))
        .when(kind == 6, '{"done": true}')
        .otherwise("server error")
        .alias("body"),
    )
