"""Vector queries: shape, pooling, similarity, nearest neighbours, encoders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import vectors as vc
from lexloom.functions.text import ws_tokens
from lexloom.operators import encode as en
from lexloom.operators import metrics as mt
from lexloom.operators import vectors as vo
from lexloom.operators.frames import argmax_rows, checked_join, rank_hits, unnest
from lexloom.operators.quantised import encode_vectors, fit_quantiser, search_quantised
from lexloom.plans.registry import HASHED, REVIEWS, Registry, bucket, words
from lexloom.session import cut_lineage
from lexloom.sources import tables as tb
from lexloom.sources.files import inline_table

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles

VECS = "vecs AS (SELECT vec_id AS key, embedding::DOUBLE[] AS vec, label FROM embeddings)"
DIMS = "dims AS (SELECT key, label, unnest(vec) AS x, generate_subscripts(vec, 1) AS d FROM vecs)"
CENTROIDS = """means AS (SELECT label, d, avg(x) AS x FROM dims GROUP BY label, d),
centroids AS (SELECT label, list(x ORDER BY d) AS c FROM means GROUP BY label)"""
FIRSTS = "firsts AS (SELECT min(key) AS query FROM vecs GROUP BY label)"


def _long(df: DataFrame, keys: list[str], vec: str = "vec") -> DataFrame:
    """One row per dimension, rounded for comparison."""
    rows = unnest(df, vc.as_doubles(vec), *keys, name="x", pos="dim")
    return rows.select(*keys, "dim", (F.round("x", 6) + 0.0).alias("x"))


@_R.add("SELECT count(*) AS n_rows, min(len(embedding))::INTEGER AS min_dim, max(len(embedding))::INTEGER AS max_dim FROM embeddings")
def vector_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.vec_dim(tb.vectors(spark, sf_dir))


@_R.add(
    f"""WITH {VECS}, {DIMS} SELECT key, (d - 1)::INTEGER AS dim, round(x, 6) + 0.0 AS x FROM dims WHERE d <= 12"""
)
def vector_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = tb.vectors(spark, sf_dir).withColumn("vec", vc.vec_slice("vec", 12))
    return _long(head, ["key"])


@_R.add(
    f"""WITH {VECS} SELECT key, round(vec[-1], 6) + 0.0 AS last_x, round(vec[-2], 6) + 0.0 AS second_last_x,
           round(vec[1], 6) + 0.0 AS first_x FROM vecs"""
)
def vector_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = tb.vectors(spark, sf_dir).withColumn("vec", vc.as_doubles("vec"))
    return wide.select(
        "key",
        *[
            (F.round(vc.vec_at("vec", i), 6) + 0.0).alias(name)
            for i, name in ((-1, "last_x"), (-2, "second_last_x"), (0, "first_x"))
        ],
    )


@_R.add(f"WITH {VECS}, {DIMS} SELECT label, (d - 1)::INTEGER AS dim, round(avg(x), 6) + 0.0 AS x FROM dims GROUP BY label, d")
def class_mean_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(vo.mean_vec(tb.vectors(spark, sf_dir), "label"), ["label"])


@_R.add(
    f"""WITH {VECS}, {DIMS}, {CENTROIDS}
    SELECT key, label, round(list_cosine_similarity(vec, c), 6) + 0.0 AS sim FROM vecs JOIN centroids USING (label)"""
)
def pair_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the mean of its own class."""
    vecs = tb.vectors(spark, sf_dir)
    means = vo.mean_vec(vecs, "label").withColumnRenamed("vec", "center")
    pairs = vo.pair_cosine(checked_join(vecs, means, "label", by="key"), "vec", "center")
    return pairs.select("key", "label", (F.round("sim", 6) + 0.0).alias("sim"))


@_R.add(
    f"""WITH {VECS}, {DIMS}, {CENTROIDS}
    SELECT key, c.label AS label, round(list_cosine_similarity(vec, c.c), 6) + 0.0 AS sim FROM vecs CROSS JOIN centroids c"""
)
def cosine_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector against the mean of every class."""
    vecs = tb.vectors(spark, sf_dir)
    sims = vo.cross_score(vecs.select("key", "vec"), vo.mean_vec(vecs, "label"))
    return sims.select("key", "label", (F.round("sim", 6) + 0.0).alias("sim"))


@_R.add(
    f"""WITH {VECS}, {DIMS}, {CENTROIDS}, sims AS (
      SELECT key, c.label AS label, round(list_cosine_similarity(vec, c.c), 6) + 0.0 AS sim FROM vecs CROSS JOIN centroids c)
    SELECT key, label, sim FROM sims QUALIFY row_number() OVER (PARTITION BY key ORDER BY sim DESC, label) = 1"""
)
def nearest_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class mean nearest to each vector."""
    return argmax_rows(cosine_matrix(spark, sf_dir), ["key"], "label", "sim")


@_R.add(
    f"""WITH {VECS}, {DIMS}, {CENTROIDS}, sims AS (
      SELECT key, c.label AS pred, round(list_cosine_similarity(vec, c.c), 6) + 0.0 AS sim FROM vecs CROSS JOIN centroids c),
    best AS (SELECT key, pred FROM sims QUALIFY row_number() OVER (PARTITION BY key ORDER BY sim DESC, pred) = 1)
    SELECT 'nearest mean' AS model, label, pred, count(*) AS n FROM best JOIN vecs USING (key) GROUP BY label, pred"""
)
def class_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True classes against those of the nearest class mean, for all ten classes."""
    found = nearest_class(spark, sf_dir).select("key", F.col("label").alias("pred"))
    joined = tb.vectors(spark, sf_dir).select("key", "label").join(found, "key")
    return mt.confusion_counts(joined.withColumn("model", F.lit("nearest mean")))


@_R.add(
    f"""WITH {VECS}, {DIMS} SELECT key, (d - 1)::INTEGER AS best_dim FROM dims
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY x DESC, d) = 1"""
)
def argmax_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.vectors(spark, sf_dir).select("key", vc.argmax("vec").alias("best_dim"))


@_R.add(
    f"""WITH {VECS}, {DIMS}
    SELECT key, (row_number() OVER w)::INTEGER AS rank, (d - 1)::INTEGER AS dim, round(x, 6) + 0.0 AS x FROM dims
    WINDOW w AS (PARTITION BY key ORDER BY x DESC, d) QUALIFY row_number() OVER w <= 5"""
)
def topk_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = unnest(tb.vectors(spark, sf_dir), vc.topk("vec", 5), "key", name="s", pos="at")
    return best.select(
        "key",
        (F.col("at") + 1).alias("rank"),
        F.col("s.index").alias("dim"),
        (F.round("s.value", 6) + 0.0).alias("x"),
    )


@_R.add(
    f"""WITH {VECS}, {DIMS}
    SELECT key, (d - 1)::INTEGER AS dim, round(exp(x - top) / sum(exp(x - top)) OVER (PARTITION BY key), 6) + 0.0 AS x
    FROM (SELECT *, max(x) OVER (PARTITION BY key) AS top FROM dims)"""
)
def softmax_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(tb.vectors(spark, sf_dir).select("key", vc.softmax("vec").alias("vec")), ["key"])


_SIMILAR = """hits AS (
  SELECT q.query, v.key, round(list_cosine_similarity(v.vec, q.qvec), 6) + 0.0 AS sim
  FROM queries q CROSS JOIN vecs v {where})
SELECT query, key, sim, (row_number() OVER w)::INTEGER AS rank FROM hits
WINDOW w AS (PARTITION BY query ORDER BY sim DESC, key) QUALIFY row_number() OVER w <= {k}"""


@_R.add(
    f"WITH {VECS}, {DIMS}, {CENTROIDS}, queries AS (SELECT label AS query, c AS qvec FROM centroids), "
    + _SIMILAR.format(where="", k=10)
)
def similar_to_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors nearest to each class mean."""
    vecs = tb.vectors(spark, sf_dir)
    queries = vo.mean_vec(vecs, "label").withColumnRenamed("label", "query")
    return vo.most_similar_to_vector(vecs.select("key", "vec"), queries, k=10)


_TO_KEY = (
    f"WITH {VECS}, {FIRSTS}, queries AS (SELECT query, vec AS qvec FROM firsts JOIN vecs ON key = query), "
    + _SIMILAR.format(where="WHERE v.key <> q.query", k=5)
)


def _firsts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest key of each class: keys to recommend for."""
    return tb.vectors(spark, sf_dir).groupBy("label").agg(F.min("key").alias("key")).select("key")


@_R.add(_TO_KEY)
def similar_to_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = tb.vectors(spark, sf_dir).select("key", "vec")
    return vo.most_similar_to_key(vecs, _firsts(spark, sf_dir), k=5)


def _cell_search(spark: SparkSession, sf_dir: str, n_cells: int, nprobe: int) -> DataFrame:
    vecs = tb.vectors(spark, sf_dir).select("key", "vec")
    model = vo.fit_cells(vecs, n_cells)
    queries = vecs.join(_firsts(spark, sf_dir), "key", "left_semi").withColumnRenamed("key", "query")
    found = vo.approx_most_similar(vo.assign_cells(vecs, model), model, queries, k=6, nprobe=nprobe)
    # the query itself is a vector of the table: leave it out and close the ranks
    others = found.filter(F.col("key") != F.col("query")).drop("rank")
    return rank_hits(others, "query", "sim", "key", k=5)


@_R.add()
def similar_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the cells are searched."""
    return _cell_search(spark, sf_dir, n_cells=8, nprobe=4)


@_R.add(_TO_KEY)
def similar_all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells are searched, so the cell search must give the exact neighbours."""
    return _cell_search(spark, sf_dir, n_cells=8, nprobe=8)


@_R.add(
    f"WITH {VECS}, queries AS (SELECT key AS query, vec AS qvec FROM vecs WHERE key % 100 = 0), best AS (WITH "
    + _SIMILAR.format(where="", k=10)
    + """) SELECT query, string_agg(key::VARCHAR, ',' ORDER BY rank) AS keys, true AS recalled FROM best GROUP BY query"""
)
def similar_quantised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantised search for every hundredth vector against all: the exact ten, and whether it finds 0.9 of them or more on average."""
    vecs = cut_lineage(tb.vectors(spark, sf_dir).select("key", "vec"))
    queries = vecs.where("key % 100 = 0").withColumnRenamed("key", "query")
    quantiser = fit_quantiser(vecs, n_cells=16, parts=16, codes=64)
    index = cut_lineage(encode_vectors(vecs, quantiser))
    found = search_quantised(index, quantiser, vecs, queries, k=10, nprobe=13, rerank=100).withColumn("found", F.lit(1))
    exact = vo.most_similar_to_vector(vecs, queries, k=10)
    both = exact.join(found.select("query", "key", "found"), ["query", "key"], "left")
    rows = cut_lineage(
        both.groupBy("query").agg(
            F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("rank", "key"))), lambda x: x["key"].cast("string"))).alias("keys"),
            F.avg(F.coalesce("found", F.lit(0))).alias("recall"),
        )
    )
    return rows.select("query", "keys", (rows.agg(F.avg("recall")).scalar() >= 0.9).alias("recalled"))


@_R.add(
    f"""WITH texts AS (SELECT doc_id AS key, text FROM documents), {HASHED}
    SELECT key AS doc_id, b::INTEGER AS dim, round(x, 6) + 0.0 AS x FROM hashed"""
)
def hash_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = en.hash_encode(tb.docs(spark, sf_dir))
    return _long(encoded, ["doc_id"]).filter(F.col("x") != 0)


# Label texts, a few common words of each language.
LANGUAGE_LABELS = {
    "de": "der die und nicht mit",
    "en": "the and that of with",
    "es": "el que los por con",
    "fr": "le que les dans pour",
}


@_R.add(
    f"""WITH {REVIEWS},
    label_texts(label, text) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in LANGUAGE_LABELS.items())}),
    terms AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({words('lower(text)')}) AS term FROM documents) GROUP BY ALL),
    label_terms AS (SELECT label, term, count(*) AS tf FROM (SELECT label, unnest({words('lower(text)')}) AS term FROM label_texts) GROUP BY ALL),
    idf AS (SELECT term, ln(((SELECT count(*) FROM reviews WHERE split = 'train') + 1)::DOUBLE / (count(*) + 1)::DOUBLE) + 1 AS idf
            FROM terms JOIN reviews USING (doc_id) WHERE split = 'train' GROUP BY term),
    dw AS (SELECT doc_id, term, tf * idf AS w FROM terms JOIN idf USING (term)),
    lw AS (SELECT label, term, tf * idf AS w FROM label_terms JOIN idf USING (term)),
    sims AS (SELECT doc_id, label, sum(d.w * l.w) AS dot FROM dw d JOIN lw l USING (term) GROUP BY ALL),
    dn AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM dw GROUP BY doc_id),
    ln AS (SELECT label, sqrt(sum(w * w)) AS n FROM lw GROUP BY label)
    SELECT doc_id, label, round(coalesce(dot / (dn.n * ln.n), 0), 6) AS sim
    FROM documents CROSS JOIN label_texts LEFT JOIN sims USING (doc_id, label) LEFT JOIN dn USING (doc_id) LEFT JOIN ln USING (label)"""
)
def tfidf_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against label texts of four languages; weights come from the train split."""
    train = tb.reviews(spark, sf_dir).filter(F.col("split") == "train").select("doc_id")
    terms = en.term_counts(tb.docs(spark, sf_dir))
    # the frozen encoder: fitted once, written once, used for both sides
    idf = cut_lineage(
        en.fit_idf(terms.join(train, "doc_id", "left_semi"), train.select(F.count(F.lit(1))).scalar())
    )
    texts = inline_table(spark, list(LANGUAGE_LABELS.items()), "label string, text string")
    label_w = cut_lineage(en.weigh_few_terms(en.term_counts(texts, key="label"), idf))
    docs = tb.read_table(spark, sf_dir, "documents").select("doc_id")
    sims = en.tfidf_cosine(docs, en.weigh_terms(terms, idf), label_w)
    return sims.withColumn("sim", F.round("sim", 6))


CONTEXTS = f"""tok AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos
        FROM (SELECT doc_id, {words('lower(text)')} AS t FROM documents)),
near AS (SELECT a.doc_id, a.pos, a.token, {bucket('b.token')} AS b,
                1.0::DOUBLE / count(*) OVER (PARTITION BY a.doc_id, a.pos) AS x
         FROM (SELECT *, unnest(range(-2, 3)) AS step FROM tok) a
         JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + a.step)"""


def _contexts(spark: SparkSession, sf_dir: str, only: list[str] | None = None) -> DataFrame:
    docs = tb.docs(spark, sf_dir).select(
        "doc_id", ws_tokens(F.lower("text")).alias("tokens")
    )
    buckets = F.transform("tokens", lambda t: en.bucket_of(t).cast("int"))
    return vo.context_vectors(docs.withColumn("buckets", buckets), "buckets", radius=2, only=only)


@_R.add(
    f"""WITH {CONTEXTS}
    SELECT doc_id, b::INTEGER AS bucket, count(DISTINCT pos) AS n_places, round(sum(x), 6) AS mass
    FROM near GROUP BY doc_id, b"""
)
def context_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many places of each text have a bucket in their context, and with what mass."""
    return _contexts(spark, sf_dir).groupBy("doc_id", "bucket").agg(
        F.count(F.lit(1)).alias("n_places"), F.round(F.sum("x"), 6).alias("mass")
    )


# A token and the two it may stand for.
TARGET, FIRST, SECOND = "it", "the", "that"


@_R.add(
    f"""WITH {CONTEXTS},
    m AS (SELECT doc_id, token, b, sum(x) AS x FROM near WHERE token IN ('{TARGET}', '{FIRST}', '{SECOND}') GROUP BY ALL),
    wide AS (SELECT doc_id, b, coalesce(sum(x) FILTER (token = '{TARGET}'), 0) AS t,
                    coalesce(sum(x) FILTER (token = '{FIRST}'), 0) AS f,
                    coalesce(sum(x) FILTER (token = '{SECOND}'), 0) AS s FROM m GROUP BY doc_id, b),
    sims AS (SELECT doc_id, round(sum(t * f) / sqrt(sum(t * t) * sum(f * f)), 6) AS sim_a,
                    round(sum(t * s) / sqrt(sum(t * t) * sum(s * s)), 6) AS sim_b
             FROM wide GROUP BY doc_id HAVING sum(t) > 0 AND sum(f) > 0 AND sum(s) > 0)
    SELECT doc_id, sim_a, sim_b, CASE WHEN sim_a > sim_b THEN '{FIRST}' ELSE '{SECOND}' END AS closer FROM sims"""
)
def closer_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = vo.mean_context(_contexts(spark, sf_dir, [TARGET, FIRST, SECOND]))
    return vo.closer_of(means, TARGET, FIRST, SECOND)
