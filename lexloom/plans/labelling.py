"""Labelling and scoring: classifiers, label matching, reports, model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators import classify as cl
from lexloom.operators import metrics as mt
from lexloom.operators.encode import hash_encode
from lexloom.plans.corpus import LABEL_NAMES
from lexloom.plans.registry import HASHED, REVIEWS, SCORES, Registry
from lexloom.session import cut_lineage
from lexloom.sources import tables as tb

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles

# Words of the stand-in prompt model.
NEGATIVE_WORDS = ["nicht", "pas", "mal"]


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_encode(tb.reviews(spark, sf_dir))


_LABEL_ROWS = ", ".join(
    f"('{name}', {i}, '{text}')" for name, texts in cl.LABEL_SETS.items() for i, text in enumerate(texts)
)
ZERO_SHOT = f"""{REVIEWS},
label_texts(label_set, label_id, text) AS (VALUES {_LABEL_ROWS}),
texts AS (
  SELECT 'd' || doc_id AS key, text FROM reviews
  UNION ALL SELECT 'l' || label_set || label_id, text FROM label_texts),
{HASHED},
sims AS (
  SELECT doc_id, label_set, label_id, round(coalesce(sum(d.x * l.x), 0.0), 6) AS sim
  FROM reviews CROSS JOIN label_texts
  LEFT JOIN hashed d ON d.key = 'd' || doc_id
  LEFT JOIN hashed l ON l.key = 'l' || label_set || label_id AND l.b = d.b
  GROUP BY doc_id, label_set, label_id),
zero_shot AS (
  SELECT label_set, doc_id, label_id AS pred, sim FROM sims
  QUALIFY row_number() OVER (PARTITION BY label_set, doc_id ORDER BY sim DESC, label_id) = 1)"""

PROMPTED = """prompted AS (
  SELECT doc_id, label, CASE WHEN contains(lower(text), 'nicht') OR contains(lower(text), 'pas')
                               OR contains(lower(text), 'mal') THEN 0 ELSE 1 END AS pred
  FROM reviews)"""

PREDICTIONS = f"""{ZERO_SHOT}, {PROMPTED},
predictions AS (
  SELECT 'zero-shot ' || label_set AS model, doc_id, label, pred FROM zero_shot JOIN reviews USING (doc_id)
  UNION ALL SELECT 'prompt' AS model, doc_id, label, pred FROM prompted)"""

REPORT = """counts AS (
  SELECT model, c, count(*) FILTER (label = c AND pred = c)::DOUBLE AS tp,
         count(*) FILTER (pred = c)::DOUBLE AS said, count(*) FILTER (label = c)::DOUBLE AS sup
  FROM predictions CROSS JOIN (VALUES (0), (1)) v(c) GROUP BY model, c),
classes AS (
  SELECT model, c, sup, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS precision,
         CASE WHEN sup > 0 THEN tp / sup ELSE 0 END AS recall,
         CASE WHEN said + sup > 0 THEN 2 * tp / (said + sup) ELSE 0 END AS f1
  FROM counts),
report AS (
  SELECT model, CASE c WHEN 0 THEN 'Negative Review' ELSE 'Positive Review' END AS row,
         precision, recall, f1, sup::BIGINT AS support FROM classes
  UNION ALL
  SELECT model, 'accuracy', NULL, NULL, avg((label = pred)::INT), count(*) FROM predictions GROUP BY model
  UNION ALL
  SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1), sum(sup)::BIGINT FROM classes GROUP BY model
  UNION ALL
  SELECT model, 'weighted avg', sum(precision * sup) / sum(sup), sum(recall * sup) / sum(sup),
         sum(f1 * sup) / sum(sup), sum(sup)::BIGINT FROM classes GROUP BY model)"""


def _zero_shot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.zero_shot(_encoded(spark, sf_dir), cl.LABEL_SETS)


def _prompted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.classify_with_prompt(tb.reviews(spark, sf_dir), cl.word_rule(NEGATIVE_WORDS))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model, doc_id, label, pred)`` of three methods over all reviews, all worked out beside the text."""
    prompted = cl.classify_with_prompt(_encoded(spark, sf_dir), cl.word_rule(NEGATIVE_WORDS)).withColumnRenamed("pred", "said")
    matched = cl.zero_shot(prompted, cl.LABEL_SETS, keep=("label", "said"))
    # the prompt's answer stands on every label set's row and is taken from the first one
    first = F.col("label_set") == next(iter(cl.LABEL_SETS))
    both = F.array(
        F.struct(F.concat(F.lit("zero-shot "), "label_set").alias("model"), F.col("pred").alias("pred")),
        F.struct(F.when(first, "prompt").alias("model"), F.col("said").alias("pred")),
    )
    return matched.select("doc_id", "label", F.explode(both).alias("p")).where("p.model is not null").select(
        "p.model", "doc_id", "label", "p.pred"
    )


@_R.add(
    f"""WITH {SCORES}
    SELECT key, truth, CASE WHEN s[3] > s[1] THEN 1 ELSE 0 END AS pred FROM scored"""
)
def score_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.classify_scores(tb.scores(spark, sf_dir)).select("key", "truth", "pred")


@_R.add(f"WITH {ZERO_SHOT} SELECT label_set, doc_id, pred, sim FROM zero_shot")
def zero_shot_two_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zero_shot(spark, sf_dir)


@_R.add(f"WITH {REVIEWS}, {PROMPTED} SELECT doc_id, label, pred FROM prompted")
def prompt_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prompted(spark, sf_dir).select("doc_id", "label", "pred")


@_R.add(
    f"""WITH {SCORES}, predictions AS (SELECT truth, CASE WHEN s[3] > s[1] THEN 1 ELSE 0 END AS pred FROM scored)
    SELECT 'scores' AS model, count(*) FILTER (truth = 1 AND pred = 1) AS tp,
           count(*) FILTER (truth = 0 AND pred = 1) AS fp, count(*) FILTER (truth = 0 AND pred = 0) AS tn,
           count(*) FILTER (truth = 1 AND pred = 0) AS fn
    FROM predictions"""
)
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cl.classify_scores(tb.scores(spark, sf_dir)).withColumn("model", F.lit("scores"))
    return mt.confusion(scored, truth="truth")


@_R.add(
    f"""WITH {PREDICTIONS}, {REPORT}
    SELECT model, row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
    FROM report"""
)
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = mt.classification_report(_predictions(spark, sf_dir), LABEL_NAMES)
    return full.select(
        "model", "row", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@_R.add(
    f"""WITH {PREDICTIONS}, {REPORT},
    per_model AS (SELECT model, max(round(f1, 6)) FILTER (row = 'accuracy') AS accuracy,
                         max(round(f1, 6)) FILTER (row = 'macro avg') AS macro_f1 FROM report GROUP BY model)
    SELECT model, accuracy, macro_f1, (rank() OVER (ORDER BY accuracy DESC))::INTEGER AS rank FROM per_model"""
)
def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.compare_models(_predictions(spark, sf_dir), LABEL_NAMES)


@_R.add(f"WITH {PREDICTIONS} SELECT model, doc_id, label, pred FROM predictions")
def aligned_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(spark, sf_dir)


@_R.add(
    """SELECT count(*) FILTER (d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS matched,
           count(*) FILTER (l.doc_id IS NULL) AS only_predicted,
           count(*) FILTER (d.doc_id IS NULL) AS only_labelled
    FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id"""
)
def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document counts as predicted; only some carry a label."""
    return mt.unmatched(tb.docs(spark, sf_dir), tb.read_table(spark, sf_dir, "labels"))


def _logistic(spark: SparkSession, sf_dir: str):
    """The encoded reviews and the model fitted on their train split."""
    encoded = cut_lineage(_encoded(spark, sf_dir).select("doc_id", "vec", "label", "split"))
    return encoded, cl.fit_logistic(encoded.filter(F.col("split") == "train"))


@_R.add()
def logistic_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the train split, applied to every review."""
    encoded, model = _logistic(spark, sf_dir)
    return cl.predict_logistic(model, encoded)


@_R.add("SELECT range::INTEGER AS dim, 0.0::DOUBLE AS gradient FROM range(65)")
def logistic_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted model stands at the minimum of its loss over the train split."""
    encoded, model = _logistic(spark, sf_dir)
    found = cl.logistic_gradient(model, encoded.filter(F.col("split") == "train"))
    return found.select("dim", (F.round("gradient", 3) + 0.0).alias("gradient"))


@_R.add(f"WITH {REVIEWS} SELECT doc_id, true AS follows FROM reviews")
def logistic_follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prediction is the sign of the fitted linear score."""
    encoded, model = _logistic(spark, sf_dir)
    margin = encoded.select("doc_id", cl.logistic_margin(model).alias("margin"))
    both = cl.predict_logistic(model, encoded).join(margin, "doc_id")
    return both.select("doc_id", (F.col("pred") == (F.col("margin") > 0).cast("int")).alias("follows"))


@_R.add()
def held_out_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four methods on the test split: two label wordings, the prompt, and encodings with logistic regression."""
    encoded, model = _logistic(spark, sf_dir)
    test = encoded.filter(F.col("split") == "test")
    fitted = cl.predict_logistic(model, test).join(test.select("doc_id", "label"), "doc_id")
    others = _predictions(spark, sf_dir).join(test.select("doc_id"), "doc_id", "left_semi")
    rows = others.unionByName(fitted.select(F.lit("encoding + logistic").alias("model"), "doc_id", "label", "pred"))
    return mt.compare_models(rows, LABEL_NAMES)
