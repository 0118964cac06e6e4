"""Counting and scoring predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def count_rows(df: DataFrame, by: str = "split") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def class_counts(df: DataFrame, by: str = "split", label: str = "label") -> DataFrame:
    """Positive, negative and unrecognised labels; a null label is unrecognised."""
    known = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    return df.groupBy(by).agg(
        F.count_if(F.col(label) == 1).alias("positive"),
        F.count_if(F.col(label) == 0).alias("negative"),
        F.count_if(~known).alias("unrecognised"),
    )


def align_predictions(preds: DataFrame, truth: DataFrame, key: str = "doc_id") -> DataFrame:
    """Predictions beside their true labels, by key; rows without a partner are left out."""
    return preds.join(truth, key)


def unmatched(preds: DataFrame, truth: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row: keys on both sides, keys only predicted, keys only labelled."""
    both = preds.select(key, F.lit(1).alias("_p")).join(truth.select(key, F.lit(1).alias("_t")), key, "full")
    has_p, has_t = F.col("_p").isNotNull(), F.col("_t").isNotNull()
    return both.agg(
        F.count_if(has_p & has_t).alias("matched"),
        F.count_if(has_p & ~has_t).alias("only_predicted"),
        F.count_if(has_t & ~has_p).alias("only_labelled"),
    )


def confusion(preds: DataFrame, by: str = "model", truth: str = "label", pred: str = "pred") -> DataFrame:
    """True and false positives and negatives per model, for labels 0 and 1."""
    y, p = F.col(truth), F.col(pred)
    return preds.groupBy(by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def confusion_counts(preds: DataFrame, by: str = "model", truth: str = "label", pred: str = "pred") -> DataFrame:
    """``(by, truth, pred, n)`` for any number of classes; pairs that don't occur have no row."""
    return preds.groupBy(by, truth, pred).agg(F.count(F.lit(1)).alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top.cast("double") / bottom).otherwise(0.0)


def classification_report(
    preds: DataFrame,
    names: dict[int, str],
    by: str = "model",
    truth: str = "label",
    pred: str = "pred",
) -> DataFrame:
    """``(by, row, precision, recall, f1, support)``: a row per class and three summary rows.

    One aggregation over the predictions; everything after it works on a handful of counts. A
    ratio with nothing below the line is 0. A class that is never predicted or never true
    keeps its row. ``accuracy`` stands in the ``f1`` column, as in the printed form.
    """
    y, p = F.col(truth), F.col(pred)
    counted = preds.groupBy(by).agg(
        F.count_if(y == p).alias("hits"),
        F.count(F.lit(1)).alias("total"),
        *[F.count_if((y == c) & (p == c)).alias(f"tp{c}") for c in names],
        *[F.count_if(p == c).alias(f"said{c}") for c in names],
        *[F.count_if(y == c).alias(f"true{c}") for c in names],
    )
    per_class = F.array(
        *[
            F.struct(
                F.lit(name).alias("row"),
                _ratio(F.col(f"tp{c}"), F.col(f"said{c}")).alias("precision"),
                _ratio(F.col(f"tp{c}"), F.col(f"true{c}")).alias("recall"),
                _ratio(2 * F.col(f"tp{c}"), F.col(f"said{c}") + F.col(f"true{c}")).alias("f1"),
                F.col(f"true{c}").alias("support"),
            )
            for c, name in names.items()
        ]
    )
    withc = counted.select(by, "hits", "total", per_class.alias("c"))

    def plain(field: str) -> Column:
        total = F.aggregate("c", F.lit(0.0), lambda s, x: s + x[field])
        return total / F.size("c")

    def weighted(field: str) -> Column:
        total = F.aggregate("c", F.lit(0.0), lambda s, x: s + x[field] * x["support"])
        weight = F.aggregate("c", F.lit(0).cast("bigint"), lambda s, x: s + x["support"])
        return _ratio(total, weight)

    none = F.lit(None).cast("double")
    summary = F.array(
        F.struct(
            F.lit("accuracy").alias("row"),
            none.alias("precision"),
            none.alias("recall"),
            _ratio(F.col("hits"), F.col("total")).alias("f1"),
            F.col("total").alias("support"),
        ),
        *[
            F.struct(
                F.lit(title).alias("row"),
                average("precision").alias("precision"),
                average("recall").alias("recall"),
                average("f1").alias("f1"),
                F.col("total").alias("support"),
            )
            for title, average in (("macro avg", plain), ("weighted avg", weighted))
        ],
    )
    return withc.select(by, F.explode(F.concat("c", summary)).alias("r")).select(by, "r.*")


def compare_models(
    preds: DataFrame, names: dict[int, str], by: str = "model", truth: str = "label", pred: str = "pred", digits: int = 6
) -> DataFrame:
    """``(by, accuracy, macro_f1, rank)``: models by rounded accuracy, ties sharing a rank."""
    report = classification_report(preds, names, by, truth, pred)
    rows = report.groupBy(by).agg(
        F.max(F.when(F.col("row") == "accuracy", F.round("f1", digits))).alias("accuracy"),
        F.max(F.when(F.col("row") == "macro avg", F.round("f1", digits))).alias("macro_f1"),
    )
    return rows.withColumn("rank", F.rank().over(W.orderBy(F.desc("accuracy"))))
