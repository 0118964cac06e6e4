"""Labelling texts: by scores, by nearest label text, by logistic regression, by prompt."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.replies import parse_verdict
from lexloom.functions.text import with_prefix
from lexloom.functions.vectors import as_doubles, dot, literal_vector
from lexloom.operators.encode import encode_literals
from lexloom.operators.frames import unnest

# The prompt put before a text, and the label texts of the two wordings.
SENTIMENT_PROMPT = "Is the following sentence positive or negative? "
LABEL_SETS = {
    "plain": ["A negative review", "A positive review"],
    "sharp": ["A very negative movie review", "A very positive movie review"],
}


def classify_scores(df: DataFrame, scores: str = "scores", out: str = "pred") -> DataFrame:
    """0/1 from the scores (negative, neutral, positive); neutral is ignored, a tie is 0."""
    negative, positive = F.col(scores)[0], F.col(scores)[2]
    return df.withColumn(out, F.when(positive > negative, 1).otherwise(0))


def zero_shot(
    encoded: DataFrame,
    label_sets: dict[str, list[str]],
    key: str = "doc_id",
    vec: str = "vec",
    dims: int = 64,
    digits: int = 6,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The nearest label text of each set: ``(label_set, key, *keep, pred, sim)``.

    ``encoded`` comes from ``hash_encode`` with the same ``dims``. The few label vectors are
    literals of the plan, so all sets are scored in the row that holds the document: one pass,
    no join, no shuffle. Similarities are rounded before ranking; the first label wins ties.
    """
    texts = [text for names in label_sets.values() for text in names]
    vectors = iter(encode_literals(encoded.sparkSession, texts, dims))
    sets = []
    for name, names in label_sets.items():
        sims = F.array(*[F.round(dot(vec, literal_vector(next(vectors))), digits) for _ in names])
        sets.append(F.struct(F.lit(name).alias("label_set"), sims.alias("sims")))
    scored = unnest(encoded, F.array(*sets), key, *keep, name="s")
    return scored.select(
        F.col("s.label_set").alias("label_set"),
        key,
        *keep,
        (F.array_position("s.sims", F.array_max("s.sims")) - 1).cast("int").alias("pred"),
        F.array_max("s.sims").alias("sim"),
    )


def fit_logistic(train: DataFrame, c: float = 1.0, max_iter: int = 100) -> LogisticRegressionModel:
    """L2-regularised logistic regression on ``(vec, label)``.

    Spark averages the loss over the rows, so a strength of ``c`` is ``1 / (c * n)`` here.
    """
    points = train.select(array_to_vector("vec").alias("features"), F.col("label").cast("double").alias("label"))
    trainer = LogisticRegression(
        regParam=1.0 / (c * points.count()), elasticNetParam=0.0, standardization=False, maxIter=max_iter
    )
    return trainer.fit(points)


def logistic_gradient(model: LogisticRegressionModel, train: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(dim, gradient)`` of the regularised mean loss where the model stands; the last dimension is the constant.

    At the minimum every entry is zero. Products are averaged inside each task before the shuffle.
    """
    weights = [*model.coefficients.toArray().tolist(), float(model.intercept)]
    wide = F.concat(as_doubles("vec"), F.array(F.lit(1.0)))
    miss = 1 / (1 + F.exp(-dot(wide, literal_vector(weights)))) - F.col("label")
    parts = train.select(F.posexplode(F.transform(wide, lambda x: x * miss)).alias("dim", "x"))
    ridge = F.when(F.col("dim") < len(weights) - 1, model.getRegParam() * F.element_at(literal_vector(weights), F.col("dim") + 1)).otherwise(0.0)
    return parts.groupBy("dim").agg(F.avg("x").alias("x")).select("dim", (F.col("x") + ridge).alias("gradient"))


def logistic_margin(model: LogisticRegressionModel, vec: Column | str = "vec") -> Column:
    """The linear score that the model's predictions follow from."""
    return dot(vec, literal_vector(model.coefficients.toArray().tolist())) + float(model.intercept)


def predict_logistic(model: LogisticRegressionModel, test: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, pred, prob)``; ``prob`` is that of label 1."""
    return model.transform(test.withColumn("features", array_to_vector("vec"))).select(
        key,
        F.col("prediction").cast("int").alias("pred"),
        vector_to_array("probability")[1].alias("prob"),
    )


def add_prompt(df: DataFrame, prefix: str = SENTIMENT_PROMPT, text: str = "text", out: str = "prompt") -> DataFrame:
    return df.withColumn(out, with_prefix(prefix, text))


def classify_with_prompt(
    df: DataFrame,
    model_fn: Callable[[DataFrame, str], DataFrame],
    prefix: str = SENTIMENT_PROMPT,
    text: str = "text",
) -> DataFrame:
    """Prompt column, model, reply, 0/1 verdict by the ``word`` rule.

    ``model_fn`` takes the frame and the name of the prompt column and adds ``reply``; it is a
    column expression or a batch model through ``map_batches``.
    """
    replied = model_fn(add_prompt(df, prefix, text), "prompt")
    return replied.withColumn("pred", parse_verdict("reply", "word")["verdict"])


def word_rule(negative_words: list[str]) -> Callable[[DataFrame, str], DataFrame]:
    """A stand-in model: ``negative`` when the prompt's last line block holds one of the words."""

    def run(df: DataFrame, prompt: str) -> DataFrame:
        found: Column = F.lit(False)
        for word in negative_words:
            found = found | F.contains(F.lower(prompt), F.lit(word))
        return df.withColumn("reply", F.when(found, "negative").otherwise("positive"))

    return run
