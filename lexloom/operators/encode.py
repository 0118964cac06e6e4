"""Frozen text encoders: feature hashing and TF-IDF. Lexical, not neural."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexloom.functions.text import ws_tokens
from lexloom.operators.frames import checked_join, unnest


def bucket_of(token: Column, dims: int = 64) -> Column:
    """The bucket of a token: the first 32 bits of its md5, modulo ``dims``."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % dims


def buckets_of(tokens: Column, dims: int = 64) -> Column:
    return F.transform(tokens, lambda t: bucket_of(t, dims).cast("string"))


def hash_encode(docs: DataFrame, dims: int = 64, text: str = "text", out: str = "vec") -> DataFrame:
    """Add a unit vector of hashed token counts; a text without tokens gets a zero vector.

    Counting and scaling happen inside each row, so nothing is shuffled.
    """
    counter = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(dims)], inputCol="_buckets", outputCol="_counts"
    )
    scaler = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit")
    none = F.array().cast("array<string>")
    tokens = F.coalesce(buckets_of(ws_tokens(F.lower(text)), dims), none)
    counted = counter.transform(docs.withColumn("_buckets", tokens))
    return (
        scaler.transform(counted)
        .withColumn(out, vector_to_array("_unit"))
        .drop("_buckets", "_counts", "_unit")
    )


def encode_literals(spark: SparkSession, texts: list[str], dims: int = 64) -> list[list[float]]:
    """Vectors of a few literal texts, by the same encoder as the documents."""
    rows = spark.range(1).select(F.posexplode(F.lit(texts)).alias("i", "text"))
    return [row["vec"] for row in sorted(hash_encode(rows, dims).collect(), key=lambda r: r["i"])]


def term_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, term, tf)`` over the lower-cased tokens."""
    return (
        unnest(docs, ws_tokens(F.lower(text)), key, name="term")
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def fit_idf(train_terms: DataFrame, n_docs: Column, key: str = "doc_id") -> DataFrame:
    """``(term, idf)`` from the training texts: ``ln((N + 1) / (df + 1)) + 1``."""
    return train_terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term",
        (F.log((n_docs.cast("double") + 1) / (F.col("df") + 1).cast("double")) + 1).alias("idf"),
    )


def weigh_terms(terms: DataFrame, idf: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, term, w)``: counts times frozen weights; terms unseen in training are left out.

    A term that most texts hold is divided over several tasks.
    """
    joined = checked_join(terms, idf, "term", by=key)
    return joined.select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))


def weigh_few_terms(terms: DataFrame, idf: DataFrame, key: str = "label") -> DataFrame:
    """The same for the terms of a few short texts: they go to the weights, which may be many."""
    packed = terms.groupBy("term").agg(F.collect_list(F.struct(key, "tf")).alias("of"))
    met = checked_join(idf, packed, "term", by="idf").select("term", "idf", F.inline("of"))
    return met.select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))


def tfidf_cosine(
    docs: DataFrame, docs_w: DataFrame, labels_w: DataFrame, key: str = "doc_id", label: str = "label"
) -> DataFrame:
    """``(key, label, sim)`` for every document of ``docs`` and every label; 0 where they share no term.

    Terms unseen in training count for neither side nor its length. ``labels_w`` is short: its terms are
    packed into one row per term and sent to the document terms. Norm and dot products come out of
    the same pass over the document terms.
    """
    norm = W.partitionBy(label)
    scaled = labels_w.withColumn("wl", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(norm)))
    by_term = scaled.groupBy("term").agg(F.collect_list(F.struct(label, "wl")).alias("labels"))
    nobody = F.lit(None).cast(labels_w.schema[label].dataType)
    own = F.array(F.struct(nobody.alias(label), (F.col("w") * F.col("w")).alias("x")))
    shared = F.transform(
        "labels", lambda m: F.struct(m[label].alias(label), (F.col("w") * m["wl"]).alias("x"))
    )
    parts = checked_join(docs_w, by_term, "term", by=key, how="left").select(
        key, F.inline(F.when(F.col("labels").isNull(), own).otherwise(F.concat(own, shared)))
    )
    names = [r[0] for r in labels_w.select(label).distinct().collect()]
    every = docs.select(key, F.explode(F.lit(names)).alias(label), F.lit(0.0).alias("x"))
    sums = parts.unionByName(every).groupBy(key, label).agg(F.sum("x").alias("x"))
    # at most one row per label, and one for the norm
    square = F.max(F.when(F.col(label).isNull(), F.col("x"))).over(W.partitionBy(key))
    sim = F.when(F.col("square") > 0, F.col("x") / F.sqrt("square")).otherwise(0.0)
    return (
        sums.withColumn("square", square)
        .filter(F.col(label).isNotNull())
        .select(key, label, sim.alias("sim"))
    )
