"""A hidden Markov language model over words: Baum-Welch counts from Spark, exact likelihood by the scaled forward recursion.

Words map to symbols: each of the most frequent words is a symbol of its own, all others share a fixed number of
hashed classes. The chain emits symbols; within a class a word has the share of its smoothed count. So the
model's size is bounded by its parameters while the counts behind it grow with the corpus: they stay in a Spark
table, and each text's sum of log counts over rarer words comes from a join on the word, summed per text.

Every training text takes part in every round of Baum-Welch; a task adds up its expected counts and hands on one
row, the sums are one small table of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import LOWER, as_binary, pieces, prefix_hash, run_lengths, span_hash, utf8, word_spans
from lexloom.llm.sizes import least_of_heaviest
from lexloom.session import cut_lineage

END = -1  # key of the end token; words have other keys


@dataclass(frozen=True)
class Chain:
    """States, symbols of single words, hashed classes, rounds of Baum-Welch, seed and smoothing of its counts.

    Texts longer than ``segment`` tokens train as consecutive segments, so that many of them advance together;
    they are scored whole.
    """

    states: int = 6
    frequent: int = 1 << 14
    classes: int = 1 << 10  # a power of two
    known: int = 1 << 20  # words whose counts every task has at hand
    rounds: int = 3
    seed: int = 5
    prior: float = 1.0
    held_words: int = 1 << 20
    segment: int = 256


def token_keys(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the lower-cased words of all texts, each text followed by one end, and the offsets of texts."""
    low = LOWER[data]
    starts, ends, row = word_spans(low, at)
    words = span_hash(prefix_hash(low), starts, ends).view(np.int64)
    words = np.where(words == END, END - 1, words)
    n_words = np.bincount(row, minlength=len(at) - 1)
    offsets = np.concatenate([[0], np.cumsum(n_words + 1)])
    out = np.full(offsets[-1], END, np.int64)
    out[np.arange(len(words)) + row] = words
    return out, offsets


def _count_words(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

        def merged():
            k, c = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(k, kind="stable")
            first, _ = run_lengths(k[order])
            return (k[order][first], np.add.reduceat(c[order], first)) if len(first) else (k, c)

        for piece in pieces(batches, "text"):
            found, _ = token_keys(*utf8(piece.column("text")))
            found = np.sort(found)
            first, length = run_lengths(found)
            keys.append(found[first])
            counts.append(length)
            waiting += len(first)
            if waiting > held:
                k, c = merged()
                if len(k) > held // 2:
                    yield pa.record_batch([pa.array(k), pa.array(c)], names=["word", "c"])
                    k, c = k[:0], c[:0]
                keys, counts, waiting = [k], [c], len(k)
        k, c = merged()
        if len(k):
            yield pa.record_batch([pa.array(k), pa.array(c)], names=["word", "c"])

    return run


def word_counts(docs: DataFrame, spec: Chain) -> DataFrame:
    """``(word, c)`` over all texts of ``docs``, ends included, by 64-bit key."""
    return docs.select("text").mapInArrow(_count_words(spec.held_words), "word bigint, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The bounded part of the counts: words at hand (ascending) with counts and symbols, and what each class adds up to."""

    words: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    denominator: np.ndarray
    unigram: np.ndarray

    def look_up(self, keys: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the keys (0 if not at hand) and their symbols."""
        if not len(self.words):
            return np.zeros(len(keys), np.int64), (keys & (classes - 1)).astype(np.int32)
        place = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        here = self.words[place] == keys
        symbol = np.where(here, self.symbols[place], -1)
        first = len(self.unigram) - classes
        return np.where(here, self.counts[place], 0), np.where(symbol < 0, first + (keys & (classes - 1)), symbol).astype(np.int32)


def vocabulary(counts: DataFrame, spec: Chain) -> tuple[Vocabulary, DataFrame]:
    """The bounded vocabulary, and the counts of all other words."""
    least = least_of_heaviest(counts, "c", spec.known)
    near = counts.where(F.col("c") >= least).toArrow()
    words, c = near.column("word").to_numpy(), near.column("c").to_numpy()
    order = np.argsort(words)
    words, c = words[order], c[order]
    symbols = np.full(len(words), -1, np.int64)
    top = np.lexsort((words, -c))[: spec.frequent]
    symbols[top] = np.arange(len(top))
    far = counts.where(F.col("c") < least)
    share = np.zeros(spec.classes)
    tokens = np.zeros(spec.classes)
    for row in far.groupBy(F.col("word").bitwiseAND(spec.classes - 1).alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        share[row["k"]] += row["n"] + row["v"]
        tokens[row["k"]] += row["n"]
    others = symbols < 0
    np.add.at(share, words[others] & (spec.classes - 1), c[others] + 1)
    np.add.at(tokens, words[others] & (spec.classes - 1), c[others])
    unigram = np.concatenate([c[top].astype(float), tokens]) + 1
    # every class has one more place, for a word that was never seen
    return Vocabulary(words, c, symbols, share + 1, unigram / unigram.sum()), far


def _tokenizer(shared, spec: Chain):
    """Symbols and the sums over words at hand, for every text; keys of the other words for the join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        first = len(vocab.unigram) - spec.classes
        for piece in pieces(batches, "text"):
            keys, at = token_keys(*utf8(piece.column("text")))
            count, symbol = vocab.look_up(keys, spec.classes)
            log_count = np.log10(count + 1.0)
            in_class = symbol >= first
            share = np.where(in_class, log_count - np.log10(vocab.denominator[np.maximum(symbol - first, 0)]), 0.0)
            far = np.flatnonzero(count == 0)
            owner = np.searchsorted(at, far, "right") - 1
            cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=piece.num_rows))])
            yield pa.record_batch(
                [piece.column("doc_id"), piece.column("held_out"), as_binary(symbol.view(np.uint8), 4 * at),
                 pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(keys[far])), pa.array(np.diff(at)),
                 pa.array(np.add.reduceat((count > 0).astype(np.int64), at[:-1])), pa.array(np.add.reduceat(log_count, at[:-1])),
                 pa.array(np.add.reduceat(share, at[:-1]))],
                names=["doc_id", "held_out", "symbols", "far", "n_tokens", "n_near", "near_logs", "near_share"],
            )

    return run


TOKENS = (
    "doc_id bigint, held_out boolean, symbols binary, far array<bigint>, n_tokens bigint, n_near bigint, "
    "near_logs double, near_share double"
)


@dataclass
class Model:
    """Start, transition (from row to column) and emission (symbol by state) probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def first_model(unigram: np.ndarray, spec: Chain) -> Model:
    """States that tend to stay, with the unigram distribution disturbed in a way of their own."""
    rng = np.random.Generator(np.random.PCG64(spec.seed))
    k = spec.states
    emit = unigram[:, None] * rng.lognormal(0, 1, (len(unigram), k))
    move = np.full((k, k), 0.1 / max(k - 1, 1))
    np.fill_diagonal(move, 0.9 if k > 1 else 1.0)
    return Model(np.full(k, 1 / k), move, emit / emit.sum(axis=0))


def sequence_blocks(symbols: np.ndarray, at: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of similar length as ``(rows, lengths descending, symbols of shape (longest, rows))``, padded with 0."""
    length = np.diff(at)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    lo = 0
    while lo < len(order):
        longest = int(length[order[lo]])
        hi = min(len(order), lo + max(1, most // longest))
        # rows shorter than half the longest wait for the next block
        hi = lo + max(1, int(np.searchsorted(-length[order[lo:hi]], -(longest // 2), "right")))
        rows = order[lo:hi]
        t = np.arange(longest)[:, None]
        inside = t < length[rows]
        yield rows, length[rows], np.where(inside, symbols[np.where(inside, at[rows] + t, 0)], 0)
        lo = hi


def forward(model: Model, table: np.ndarray, length: np.ndarray, keep: bool):
    """log10 likelihood of every column by the scaled recursion; with ``keep`` the scaled alphas and scales as well."""
    steps, n = table.shape
    live = np.searchsorted(-length, -np.arange(1, steps + 1), "right")
    alphas = np.zeros((steps, n, len(model.start)), model.emit.dtype) if keep else None
    scales = np.ones((steps, n), model.emit.dtype)
    alpha = np.broadcast_to(model.start, (n, len(model.start)))
    emitted = model.emit[table] if keep else None
    for t in range(steps):
        m = live[t]
        now = (alpha[:m] @ model.move if t else alpha[:m]) * (emitted[t, :m] if keep else model.emit[table[t, :m]])
        scale = now.sum(axis=1)
        alpha = now / scale[:, None]
        scales[t, :m] = scale
        if keep:
            alphas[t, :m] = alpha
    return np.log10(scales).sum(axis=0, dtype=np.float64), alphas, scales, live, emitted


def expected_counts(
    model: Model, table: np.ndarray, length: np.ndarray, leads: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, transition and emission counts that the model expects of the columns; starts of ``leads`` only, if given."""
    _, alphas, scales, live, emitted = forward(model, table, length, True)
    steps, n = table.shape
    k = len(model.start)
    move = np.zeros((k, k))
    gammas = alphas  # overwritten from the end
    beta = np.ones((n, k), model.emit.dtype)
    for t in range(steps - 1, 0, -1):
        m = live[t]
        weight = emitted[t, :m] * beta[:m] / scales[t, :m, None]
        move += alphas[t - 1, :m].T @ weight
        gammas[t, :m] *= beta[:m]
        beta[:m] = weight @ model.move.T
    gammas[0] *= beta
    move *= model.move
    inside = np.arange(steps)[:, None] < length
    which, shares = table[inside], gammas.reshape(-1, k)[inside.ravel()]
    emit = np.stack([np.bincount(which, shares[:, s], minlength=len(model.emit)) for s in range(k)], axis=1)
    return (gammas[0] if leads is None else gammas[0][leads]).sum(axis=0), move, emit


def _symbols_of(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw, at = utf8(piece.column("symbols"))
    return np.frombuffer(raw.tobytes(), np.int32), at // 4


#: Expected counts travel as whole numbers of this fraction, so that sums do not depend on their order.
UNIT = 1 << 20


#: Bytes of symbols that are sorted by length together, and tokens of a block that advances together.
SORTED_BYTES = 8 << 20
BLOCK_TOKENS = 1 << 17


def segments_of(at: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets that also cut every text after each ``most`` tokens, and whether a segment is its text's first."""
    length = np.diff(at)
    n = -(-length // most)
    first = np.cumsum(n) - n
    place = np.arange(n.sum()) - np.repeat(first, n)
    starts = np.repeat(at[:-1], n) + place * most
    return np.append(starts, at[-1]), place == 0


def _expectation(shared, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # short segments need no more than single precision
        model, total = Model(*(x.astype(np.float32) for x in vars(shared.value).values())), None
        for piece in pieces(batches, "symbols", limit=SORTED_BYTES):
            symbols, at = _symbols_of(piece)
            at, leads = segments_of(at, segment)
            for rows, length, table in sequence_blocks(symbols, at, BLOCK_TOKENS):
                counts = np.concatenate([x.ravel() for x in expected_counts(model, table, length, leads[rows])])
                total = counts if total is None else total + counts
        if total is not None:
            whole = np.rint(total * UNIT).astype(np.int64)
            some = np.flatnonzero(whole)
            yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(whole[some])], names=["i", "x"])

    return run


def baum_welch(train: DataFrame, unigram: np.ndarray, spec: Chain) -> Model:
    """The model after ``rounds`` of Baum-Welch over all of ``train`` (``symbols``); without rows, the first model."""
    model = first_model(unigram, spec)
    k = spec.states
    for _ in range(spec.rounds):
        shared = train.sparkSession.sparkContext.broadcast(model)
        sums = train.select("symbols").mapInArrow(_expectation(shared, spec.segment), "i int, x bigint").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
        flat = np.zeros(k + k * k + len(unigram) * k)
        flat[sums.column("i").to_numpy()] = sums.column("x").to_numpy() / UNIT
        shared.unpersist()
        start, move, emit = flat[:k] + 1 / k, flat[k : k + k * k].reshape(k, k) + 1 / k, flat[k + k * k :].reshape(-1, k)
        emit = emit + spec.prior * len(unigram) * unigram[:, None] / k
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def _likelihood(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in pieces(batches, "symbols", limit=SORTED_BYTES):
            out = np.zeros(piece.num_rows)
            for rows, length, table in sequence_blocks(*_symbols_of(piece), BLOCK_TOKENS):
                out[rows] = forward(model, table, length, False)[0]
            yield pa.record_batch([*piece.select(["row", "doc_id", "held_out", "n_tokens", "n_near", "near_logs", "near_share"]).columns, pa.array(out)], names=["row", "doc_id", "held_out", "n_tokens", "n_near", "near_logs", "near_share", "chain"])

    return run


def hmm_scores(docs: DataFrame, spec: Chain = Chain()) -> DataFrame:
    """Each row of ``docs`` (``doc_id, text, held_out``) with its token counts, base score and score.

    Learns from the rows that are not ``held_out`` (null counts as not). A null text is an empty one: its end is its
    one token. Rows without ``doc_id`` and repeated rows are scored like others and learned from as often as they
    stand there. Other columns are ignored; an empty table gives no rows. Without training rows the counts are zero
    and the first model scores.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    counts = cut_lineage(word_counts(rows.where("not held_out"), spec))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    vocab, far = vocabulary(counts, spec)
    shared = spark.sparkContext.broadcast(vocab)
    tokens = rows.mapInArrow(_tokenizer(shared, spec), TOKENS).withColumn("row", F.monotonically_increasing_id())
    tokens = cut_lineage(tokens)
    model = spark.sparkContext.broadcast(baum_welch(tokens.where("not held_out"), vocab.unigram, spec))
    kinds = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_near bigint, near_logs double, near_share double, chain double"
    chained = tokens.drop("far").mapInArrow(_likelihood(model), kinds)
    words = tokens.select("row", F.explode("far").alias("word"))
    met = words.join(far, "word").groupBy("row").agg(F.count(F.lit(1)).alias("n_far"), F.sum(F.log10(F.col("c") + 1.0)).alias("far_logs"))
    both = chained.join(met, "row", "left").na.fill(0, ["n_far", "far_logs"])
    base = F.col("near_logs") + F.col("far_logs") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_near") + F.col("n_far")).alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        base.alias("base_score"), (F.col("chain") + F.col("near_share") + F.col("far_logs")).alias("score"),
    )
