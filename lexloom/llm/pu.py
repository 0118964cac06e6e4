"""Quality by positive-unlabelled learning: a linear model that minimises the non-negative unbiased risk.

Trusted positives are the labelled rows of quality 1 in the training folds; all texts are the unlabelled sample. The
class prior is estimated from the training labels, smoothed. Every text becomes a short vector of shape statistics
and hashed byte n-gram frequencies in one pass; the training passes read only these vectors, tasks add up
gradients, and each step is a sum of bounded size. Scores depend on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import pieces, prefix_hash, span_hash, utf8, word_spans
from lexloom.session import cut_lineage

PUNCTUATION = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
#: Byte classes: each ASCII punctuation mark, small and capital letters, digits, blank, line feed, other bytes.
CLASS = np.full(256, len(PUNCTUATION) + 5, np.int64)
CLASS[PUNCTUATION] = np.arange(len(PUNCTUATION))
CLASS[ord("a") : ord("z") + 1] = len(PUNCTUATION)
CLASS[ord("A") : ord("Z") + 1] = len(PUNCTUATION) + 1
CLASS[ord("0") : ord("9") + 1] = len(PUNCTUATION) + 2
CLASS[0x20] = len(PUNCTUATION) + 3
CLASS[0x0A] = len(PUNCTUATION) + 4
N_CLASSES = len(PUNCTUATION) + 6
N_BINS = 32
N_FEATURES = N_CLASSES + N_BINS + 4


@dataclass(frozen=True)
class Fit:
    """Newton steps, weight of the squared norm (by the root of the trusted rows), and size of a correcting step."""

    steps: int = 12
    ridge: float = 3.0
    correction: float = 0.1


def shape_features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row per text: roots of byte class and hashed bigram shares, words and their length, repetition, variety."""
    n = len(at) - 1
    size = np.maximum(np.diff(at), 1)[:, None]
    row = np.repeat(np.arange(n), np.diff(at))
    classes = np.bincount(row * N_CLASSES + CLASS[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    kinds = CLASS[data]
    pair = np.zeros(len(data), np.int64)
    pair[1:] = (kinds[:-1] * 31 + kinds[1:] * 7) % N_BINS
    first = at[:-1][np.diff(at) > 0]
    pair[first] = 0
    bins = np.bincount(row * N_BINS + pair, minlength=n * N_BINS).reshape(n, N_BINS)
    starts, ends, owner = word_spans(data, at)
    words = span_hash(prefix_hash(data), starts, ends)
    n_words = np.bincount(owner, minlength=n)
    some = np.maximum(n_words, 1)
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((words, owner))
    fresh = np.ones(len(words), dtype=bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    own = [
        np.log1p(n_words) / 10,
        np.bincount(owner, ends - starts, minlength=n) / some / 20,
        np.bincount(owner, again, minlength=n) / some,
        # distinct words against what the length lets expect
        np.bincount(owner[order], fresh, minlength=n) / some**0.8,
    ]
    return np.concatenate([np.sqrt(classes / size), np.sqrt(bins / size), np.stack(own, axis=1)], axis=1)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        x = shape_features(*utf8(piece.column("text"))).astype(np.float32)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_FEATURES).cast(pa.list_(pa.float32()))
        yield pa.record_batch([piece.column("doc_id"), flat], names=["doc_id", "x"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)


def _sum_rows(frame: DataFrame, count) -> np.ndarray:
    """The sum over tasks of what ``count`` makes of a task's batches: one array of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = count(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    sums = frame.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").toArrow()
    return sums.column("v").to_numpy()


def _moments(batch: pa.RecordBatch) -> np.ndarray:
    x = _matrix(batch)
    return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])


@dataclass
class Linear:
    """Weights on standardised features, the last one for the constant."""

    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def design(self, batch: pa.RecordBatch) -> np.ndarray:
        z = np.clip((_matrix(batch) - self.middle) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def _risk_parts(model: Linear):
    """Sums for one step: counts, losses, gradients and curvature over unlabelled rows and trusted positives."""

    def count(batch: pa.RecordBatch) -> np.ndarray:
        z = model.design(batch)
        f = z @ model.weights
        p = 1 / (1 + np.exp(-f))
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
        lost = np.logaddexp(0, f)  # loss of calling a row positive where it is negative
        curve = (z * (p * (1 - p))[:, None]).T @ z
        t = z[trusted]
        return np.concatenate(
            [[len(z), trusted.sum(), lost.sum(), lost[trusted].sum(), np.logaddexp(0, -f[trusted]).sum()], p @ z, t.sum(axis=0), p[trusted] @ t, curve.ravel()]
        )

    return count


def fit_risk(rows: DataFrame, prior: float, fit: Fit) -> Linear:
    """Minimises ``prior * positive risk + max(0, unlabelled negative risk - prior * positives' negative risk)``.

    ``rows`` has ``(x, trusted)``. With the logistic loss the unbiased risk is convex and takes Newton steps; where
    the estimated negative risk is below zero, a step up its gradient corrects the model instead.
    """
    sums = _sum_rows(rows, _moments)
    if not len(sums):
        return Linear(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1))
    middle = sums[1 : 1 + N_FEATURES] / sums[0]
    spread = np.sqrt(np.maximum(sums[1 + N_FEATURES :] / sums[0] - middle**2, 0))
    model = Linear(middle, np.where(spread > 1e-6, spread, 1.0), np.zeros(N_FEATURES + 1))
    d = N_FEATURES + 1
    model.weights[-1] = np.log(prior / (1 - prior))
    for _ in range(fit.steps):
        s = _sum_rows(rows, _risk_parts(model))
        n, n_trusted = s[0], s[1]
        if not n_trusted:
            break
        up, tp, tq = (s[5 + k * d : 5 + (k + 1) * d] for k in range(3))
        negative = s[2] / n - prior * s[3] / n_trusted
        if negative < 0:
            slope = up / n - prior * tq / n_trusted
            model.weights += fit.correction * slope / max(np.linalg.norm(slope), 1e-12)
            continue
        curve = s[5 + 3 * d :].reshape(d, d) / n
        ridge = fit.ridge / np.sqrt(n_trusted) * np.append(np.ones(d - 1), 0)
        step = np.linalg.solve(curve + np.diag(ridge + 1e-9), up / n - prior * tp / n_trusted + ridge * model.weights)
        model.weights -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return model


def _scorer(model: Linear):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = 1 / (1 + np.exp(-(model.design(batch) @ model.weights)))
                yield pa.record_batch([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def pu_scores(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """Each row of ``docs`` (``doc_id, text``) with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    ``labels`` has the training rows ``(doc_id, quality)``. Ids that are only ever labelled 1 are trusted positives;
    labelled zeros serve the prior alone. A null text is an empty one; its score follows from the zero features.
    Labels without a document, null labels and rows without ``doc_id`` (as labels) are left out. Repeated rows count
    as often as they stand there. Without trusted rows every score is the prior's. An empty table gives no rows.
    """
    rows = cut_lineage(docs.select("doc_id", "text").mapInArrow(_featurise, "doc_id bigint, x array<float>"))
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("low"))
    n, good = marked.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("low") == 1).cast("long")), F.lit(0))).first()
    prior = (good + 1) / (n + 2)
    trusted = marked.where("low = 1").select("doc_id", F.lit(True).alias("trusted"))
    train = cut_lineage(rows.join(trusted, "doc_id", "left").select("x", F.coalesce("trusted", F.lit(False)).alias("trusted")))
    scored = rows.mapInArrow(_scorer(fit_risk(train, prior, fit)), "doc_id bigint, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
