r"""Quality rules: text statistics and perplexity under a modified Kneser-Ney model of byte n-grams.

The n-grams are UTF-8 bytes, counted separately for each language over every text, so the number of distinct
n-grams levels off while the corpus grows. Tasks count with numpy and hand on one row per n-gram; discounts,
context totals, continuation counts and interpolated probabilities are Spark joins and aggregations. The
finished model is one sorted key array with its log probabilities for each order, and one for each
order's backoff weights. A model whose arrays would pass ``max_grams`` entries is divided by the hashes of its keys,
and the texts are scored with one share after the other: what the shares add up to is the same log probability.

No text is judged by a model that has counted it: texts are in two folds by their hash, copies in the same one, and
each fold is scored with the counts of the other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import IS_SPACE, combine, line_spans, mix, per_row, pieces, prefix_hash, run_lengths, span_hash, utf8, word_spans
from lexloom.llm.sizes import join_checked
from lexloom.session import cut_lineage

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
#: Distinct n-grams that a task holds before it hands them on.
HELD_GRAMS = 1 << 21


@dataclass(frozen=True)
class Rules:
    """Order of the model, the bound of its arrays, and how wide the perplexity bands are.

    A document passes while its log perplexity per word lies within ``width`` robust standard deviations of its
    language's median; below ``settle`` words the band is wider, as the mean of few words varies more.
    """

    order: int = 5
    max_grams: int = 1 << 21
    width: float = 6.0
    least_spread: float = 0.02
    settle: int = 100
    min_words: int = 50


#: The bit of a language code that tells the folds apart.
FOLD = 1 << 23


def lang_code(lang: str | None) -> int:
    return zlib.crc32(b"\xff" if lang is None else lang.encode()) & (FOLD - 1)


def _padded_grams(piece: pa.RecordBatch, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte its language code and its n-gram, packed with the byte itself lowest; texts start with zeros."""
    data, at = utf8(piece.column("text"))
    n = len(at) - 1
    pad = order - 1
    length = np.diff(at)
    wide = np.zeros(len(data) + pad * n, np.uint64)
    place = np.arange(len(data)) + pad * np.repeat(np.arange(1, n + 1), length)
    wide[place] = data
    gram = np.zeros(len(data), np.uint64)
    for k in range(order):
        gram |= wide[place - k] << np.uint64(8 * k)
    codes = np.array([lang_code(x) for x in piece.column("lang").to_pylist()], np.uint64)
    codes += piece.column("fold").to_numpy().astype(np.uint64) * np.uint64(FOLD)
    return np.repeat(codes << np.uint64(40), length), gram, at


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first, _ = run_lengths(k)
    return (k[first], np.add.reduceat(c, first)) if len(first) else (k, c)


def _counter(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        waiting = 0
        for piece in pieces(batches, "text"):
            lang, gram, _ = _padded_grams(piece, order)
            found = np.sort(lang | gram)
            first, length = run_lengths(found)
            keys.append(found[first])
            counts.append(length)
            waiting += len(first)
            if waiting > HELD_GRAMS:
                k, c = _merged(keys, counts)
                keys, counts, waiting = [k], [c], 0
                if len(k) > HELD_GRAMS:
                    yield pa.record_batch([pa.array(k.view(np.int64)), pa.array(c)], names=["key", "c"])
                    keys, counts = [k[:0]], [c[:0]]
        k, c = _merged(keys, counts)
        for lo in range(0, len(k), 1 << 17):
            yield pa.record_batch([pa.array(k[lo : lo + (1 << 17)].view(np.int64)), pa.array(c[lo : lo + (1 << 17)])], names=["key", "c"])

    return run


def _discount(c: Column) -> Column:
    return F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))


def _with_discounts(counts: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts of every language, from its counts of counts.

    Where a count of counts is missing, the usual formula has no value and one half, one and one and a half stand in.
    """
    n = [F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    seen = counts.groupBy("lang").agg(*n)
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0)
    raw = {f"d{k}": (k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")), k / 2, float(k)) for k in (1, 2, 3)}
    cols = [F.when(usable & (e > 0) & (e <= top), e).otherwise(F.lit(usual)).alias(k) for k, (e, usual, top) in raw.items()]
    return counts.join(seen.select("lang", *cols), "lang")


def kneser_ney(docs: DataFrame, rules: Rules) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: the n-grams with their interpolated probability, and the contexts with their backoff weight.

    ``docs`` has ``(text, lang, fold)``; a language's folds are two languages here. The frames are ``(lang, gram, c, p,
    step)`` and ``(lang, context, total, gamma)``; ``step`` is what the n-gram adds to the log10 of its backoff.
    """
    top = docs.select("text", "lang", "fold").mapInArrow(_counter(rules.order), "key bigint, c bigint")
    top = top.groupBy("key").agg(F.sum("c").alias("c"))
    top = top.select(F.shiftright("key", 40).alias("lang"), F.col("key").bitwiseAND((1 << 40) - 1).alias("gram"), "c")
    by_order = {rules.order: cut_lineage(top)}
    for n in range(rules.order - 1, 0, -1):
        # a lower order counts the different bytes that come before
        suffix = F.col("gram").bitwiseAND((1 << (8 * n)) - 1).alias("gram")
        by_order[n] = cut_lineage(by_order[n + 1].select("lang", suffix).groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c")))
    out, lower = [], None
    for n in range(1, rules.order + 1):
        counts = _with_discounts(by_order[n]).withColumn("context", F.shiftright("gram", 8))
        share = F.sum(F.least(_discount(F.col("c")), F.col("c").cast("double"))) / F.sum("c")
        contexts = counts.groupBy("lang", "context").agg(F.sum("c").alias("total"), share.alias("gamma"))
        own = (F.col("c") - F.least(_discount(F.col("c")), F.col("c").cast("double"))) / F.col("total")
        grams = counts.join(contexts, ["lang", "context"])
        if lower is None:
            grams = grams.withColumn("below", F.lit(1.0 / 256))
        else:
            below = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below"))
            grams = grams.withColumn("suffix", F.col("gram").bitwiseAND((1 << (8 * (n - 1))) - 1)).join(below, ["lang", "suffix"])
        p = own + F.col("gamma") * F.col("below")
        step = F.log10(p) - F.log10("gamma") - F.log10("below")
        lower = cut_lineage(grams.select("lang", "gram", "c", p.alias("p"), step.alias("step")))
        out.append((lower, contexts.select("lang", "context", "total", "gamma")))
    return out


@dataclass
class HashArray:
    """Hashes of packed keys, ascending, with their values; ``starts`` has the first place of each leading part."""

    hashes: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    shift: int

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> HashArray:
        hashes = mix(keys.astype(np.uint64))
        order = np.argsort(hashes)
        hashes = hashes[order]
        bits = max(4, int(len(hashes)).bit_length())
        starts = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)
        return cls(np.append(hashes, np.uint64(0)), np.append(values[order], np.float32(0)), np.append(starts, np.int32(len(hashes))), 64 - bits)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys and which of them are there."""
        wanted = mix(keys)
        part = (wanted >> np.uint64(self.shift)).astype(np.int64)
        place, stop = self.starts[part], self.starts[part + 1]
        open_ = np.flatnonzero((place < stop) & (self.hashes[place] < wanted))
        while len(open_):
            place[open_] += 1
            at = place[open_]
            open_ = open_[(at < stop[open_]) & (self.hashes[at] < wanted[open_])]
        return self.values[place], (place < stop) & (self.hashes[place] == wanted)


def model_shares(model: list[tuple[DataFrame, DataFrame]], most: int) -> int:
    """Into how many shares the model is divided so that about ``most`` entries of an order are in one."""
    largest = max((frame.count() for order in model for frame in order), default=0)
    return max(1, -(-largest // most))


def sorted_arrays(model: list[tuple[DataFrame, DataFrame]], value: str = "p", share: int = 0, shares: int = 1) -> list[tuple[HashArray, HashArray]]:
    """The model as log10 p (or steps) by n-gram and log10 gamma by context, for each order; or one share of it."""
    out = []
    for grams, contexts in model:
        parts = []
        for frame, key, number in ((grams, "gram", F.log10("p") if value == "p" else F.col("step")), (contexts, "context", F.log10("gamma"))):
            packed = F.shiftleft(F.col("lang"), 40).bitwiseOR(F.col(key)).alias("k")
            mine = F.pmod(F.xxhash64("lang", key), F.lit(shares)) == share if shares > 1 else F.lit(True)
            table = frame.where(mine).select(packed, number.cast("float").alias("v")).toArrow()
            parts.append(HashArray.of(table.column("k").to_numpy(), table.column("v").to_numpy()))
        out.append(tuple(parts))
    return out


def share_of_logs(arrays: list[tuple[HashArray, HashArray]], lang: np.ndarray, gram: np.ndarray, first: bool) -> np.ndarray:
    """What one share of the model adds to the log10 p of every byte; the first share adds the lowest order's base.

    An n-gram's log10 p is the base and, for each order up to its longest known one, the context's weight and the
    n-gram's step; beyond, the weights alone. So every entry adds by itself, wherever it is held.
    """
    out = np.full(len(gram), np.log10(1 / 256) if first else 0.0)
    for n, (grams, contexts) in enumerate(arrays, 1):
        now = gram & np.uint64((1 << (8 * n)) - 1)
        for array, key in ((grams, now), (contexts, now >> np.uint64(8))):
            value, hit = array.look_up(lang | key)
            out[hit] += value[hit]
    return out


def log_probabilities(arrays: list[tuple[HashArray, HashArray]], lang: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """log10 p of every byte given the ones before it, by the longest n-gram that the model holds."""
    out = np.zeros(len(gram))
    left = np.arange(len(gram))
    for n in range(len(arrays), 0, -1):
        grams, contexts = arrays[n - 1]
        mask = np.uint64((1 << (8 * n)) - 1)
        now = gram[left] & mask
        code = lang[left]
        value, hit = grams.look_up(code | now)
        out[left[hit]] += value[hit]
        left, now, code = left[~hit], now[~hit], code[~hit]
        weight, known = contexts.look_up(code | (now >> np.uint64(8)))
        out[left] += np.where(known, weight, 0)
        if not len(left):
            return out
    out[left] += np.log10(1 / 256)
    return out


def text_statistics(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    r"""Words, their code points, symbols, repeated lines and words in repeated three-word windows, for every text."""
    n = len(at) - 1
    starts, ends, row = word_spans(data, at)
    n_words = np.bincount(row, minlength=n)
    sums = prefix_hash(data)
    words = span_hash(sums, starts, ends)
    repeat = np.zeros(len(words) + 1, np.int64)
    if len(words) >= 3:
        inside = np.flatnonzero(row[2:] == row[:-2])
        window = combine(words[inside], words[inside + 1], words[inside + 2], row[inside].astype(np.uint64))
        order = np.argsort(window)
        first, length = run_lengths(window[order])
        again = inside[order[np.repeat(length > 1, length)]]
        np.add.at(repeat, again, 1)
        np.add.at(repeat, again + 3, -1)
    first_word = np.concatenate([[0], np.cumsum(n_words)])
    ls, le, lrow = line_spans(data, at)
    spoken = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~IS_SPACE[data], out=spoken[1:])
    real = spoken[le] > spoken[ls]
    line = combine(span_hash(sums, ls[real], le[real]), lrow[real].astype(np.uint64))
    order = np.lexsort((line, lrow[real]))
    lh, lr = line[order], lrow[real][order]
    same = (lh[1:] == lh[:-1]) & (lr[1:] == lr[:-1])
    return {
        "n_words": n_words,
        "word_chars": per_row(~IS_SPACE[data] & ((data & 0xC0) != 0x80), at),
        "n_symbols": per_row(IS_SYMBOL[data], at),
        "n_dup_lines": np.bincount(lr[1:][same], minlength=n),
        "n_repeat_words": per_row(np.cumsum(repeat)[: len(words)] > 0, first_word),
    }


def _totals(p: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(at) - 1)
    full = np.diff(at) > 0
    if full.any():
        total[full] = np.add.reduceat(p, at[:-1][full])
    return total


def _scorer(arrays, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = arrays.value
        for piece in pieces(batches, "text"):
            data, at = utf8(piece.column("text"))
            stats = text_statistics(data, at)
            lang, gram, _ = _padded_grams(piece, order)
            mean = _totals(log_probabilities(model, lang, gram), at) / np.maximum(stats["n_words"], 1)
            yield pa.record_batch(
                [piece.column("doc_id"), piece.column("lang"), *(pa.array(v.astype(np.int64)) for v in stats.values()),
                 pa.array(-mean)],
                names=["doc_id", "lang", *stats, "log_perplexity"],
            )

    return run


def _share_scorer(arrays, order: int, first: bool):
    """Log probabilities by one share; the first one brings the statistics too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = arrays.value
        for piece in pieces(batches, "text"):
            data, at = utf8(piece.column("text"))
            lang, gram, _ = _padded_grams(piece, order)
            total = pa.array(_totals(share_of_logs(model, lang, gram, first), at))
            if first:
                stats = text_statistics(data, at)
                columns = [piece.column("doc_id"), piece.column("lang"), *(pa.array(v.astype(np.int64)) for v in stats.values())]
            else:
                columns = [pa.nulls(piece.num_rows, kind) for kind in (pa.int64(), pa.string(), *[pa.int64()] * 5)]
            names = ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_perplexity"]
            yield pa.record_batch([piece.column("row"), *columns, total], names=["row", *names])

    return run


SCORED = (
    "doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, log_perplexity double"
)


def perplexities(docs: DataFrame, rules: Rules, folds: int = 1) -> DataFrame:
    """The statistics of every row and ``log_perplexity``: -log10 p of the whole text by the number of its words.

    With one fold the model counts every text; with two, a text is scored by the counts of the fold that it is not in.
    """
    fold = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(folds)).cast("int")
    known = docs.select("doc_id", "text", "lang", fold.alias("fold"))
    model = kneser_ney(known, rules)
    asked = known.withColumn("fold", F.pmod(F.col("fold") + 1, F.lit(folds)))
    spark = docs.sparkSession
    shares = model_shares(model, rules.max_grams)
    if shares == 1:
        return asked.mapInArrow(_scorer(spark.sparkContext.broadcast(sorted_arrays(model)), rules.order), SCORED)
    # rows are told apart by a number that is written with them, as every share scores them
    numbered = cut_lineage(asked.withColumn("row", F.monotonically_increasing_id()))
    parts = None
    for share in range(shares):
        arrays = spark.sparkContext.broadcast(sorted_arrays(model, "step", share, shares))
        part = cut_lineage(numbered.mapInArrow(_share_scorer(arrays, rules.order, not share), f"row bigint, {SCORED}"))
        arrays.unpersist()
        parts = part if parts is None else parts.union(part)
    stats = [F.max(c).alias(c) for c in (x.split()[0] for x in SCORED.split(", ")) if c != "log_perplexity"]
    summed = parts.groupBy("row").agg(*stats, F.sum("log_perplexity").alias("total"))
    mean = -F.col("total") / F.greatest("n_words", F.lit(1))
    return summed.withColumn("log_perplexity", mean).select(*(x.split()[0] for x in SCORED.split(", ")))


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Each row of ``docs`` with its statistics, its language's band, ``base_failed`` and ``kept``.

    ``docs`` has ``doc_id, text, lang``; other columns are ignored. A null text counts as an empty one: no
    words, so ``base_failed``. A null language is a language of its own. Repeated rows count as often as they
    stand there. An empty table gives no rows. Medians and spreads are taken over all texts that pass the base.
    """
    base_failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = cut_lineage(perplexities(docs, rules, folds=2).withColumn("base_failed", base_failed))
    scored = scored.withColumn("lang_key", F.coalesce("lang", F.lit("\x00")))
    usual = scored.where(~F.col("base_failed")).select("lang_key", "log_perplexity")
    middle = cut_lineage(usual.groupBy("lang_key").agg(F.percentile_approx("log_perplexity", 0.5, 10_000).alias("middle")))
    away = join_checked(usual, middle, ["lang_key"]).withColumn("away", F.abs(F.col("log_perplexity") - F.col("middle")))
    spread = away.groupBy("lang_key").agg((1.4826 * F.percentile_approx("away", 0.5, 10_000)).alias("spread"))
    bands = cut_lineage(middle.join(spread, "lang_key").withColumn("spread", F.greatest("spread", F.lit(rules.least_spread))))
    joined = join_checked(scored, bands, ["lang_key"], "left")
    reach = rules.width * F.col("spread") * F.sqrt(1 + rules.settle / F.greatest(F.col("n_words"), F.lit(1)))
    low, high = F.col("middle") - reach, F.col("middle") + reach
    inside = F.coalesce(F.col("log_perplexity").between(low, high), F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), "log_perplexity", low.alias("lower_band"), high.alias("upper_band"),
    )
