"""Byte-pair style subwords (Sennrich et al. 2016): learning merges, applying them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import ws_tokens
from lexloom.operators.frames import unnest
from lexloom.operators.tokens import row_slices, token_counts
from lexloom.session import cut_lineage

# A word is a string of symbols, each with one space on both sides; words hold no space
# themselves. So " a  b " is the pair (a, b) and plain text replacement merges it.
_EVERY_CHAR = r"(?s)(.)"
# Words whose pieces a worker remembers (some tens of MB).
_CACHED_WORDS = 50_000


def word_table(docs: DataFrame, text: str = "text", tokens: Column | None = None) -> DataFrame:
    """``(token, n, symbols)``: distinct words, their counts, their characters as symbols."""
    counts = token_counts(docs, ws_tokens(text) if tokens is None else tokens)
    return counts.withColumn("symbols", F.regexp_replace("token", _EVERY_CHAR, " $1 "))


def pair_counts(words: DataFrame) -> DataFrame:
    """``(left, right, n)``: how often two symbols stand next to each other, over all words."""
    apart = words.select("n", F.split(F.trim("symbols"), "  ").alias("s"))
    # the last symbol is paired with null
    pairs = F.arrays_zip(F.col("s").alias("left"), F.slice("s", F.lit(2), F.size("s")).alias("right"))
    return (
        unnest(apart, pairs, "n", name="p")
        .filter(F.col("p.right").isNotNull())
        .groupBy("p.left", "p.right")
        .agg(F.sum("n").alias("n"))
    )


def merge_symbols(symbols: Column, left: str, right: str) -> Column:
    """Join every ``left right`` in a symbol string, from left to right."""
    return F.replace(symbols, F.lit(f" {left}  {right} "), F.lit(f" {left}{right} "))


def independent_merges(top: list[tuple[str, str, int]], whole: bool) -> list[tuple[str, str, int]]:
    """The leading pairs of ``top`` that may be merged together, as one after the other they would be the same.

    ``top`` is sorted by ``(n desc, left, right)``; ``whole`` tells that it holds all pairs. A merge of
    ``(c, d)`` changes the counts of pairs with c or d, and the new symbol meets its neighbours at most
    as often as d stood before or c behind them. So a pair may join while it shares no symbol with those
    taken, and no pair with the same count could grow into one ahead of it. A symbol merged with itself
    can meet its like again, so nothing joins it.
    """
    taken = top[:1]
    for i, (left, right, n) in enumerate(top[1:], start=1):
        symbols = {s for pair in taken for s in pair[:2]}
        level = [p for p in top[i:] if p[2] == n]
        if {left, right} & symbols or taken[-1][0] == taken[-1][1] or (not whole and n == top[-1][2]):
            break
        if any(p[0] in {t[1] for t in taken} or p[1] in {t[0] for t in taken} for p in level):
            break
        taken = [*taken, (left, right, n)]
    return taken


def learn_subwords(
    docs: DataFrame, n_merges: int, checkpoint_every: int = 4, text: str = "text", looked_at: int = 64
) -> list[tuple[str, str, int]]:
    """``(left, right, n)`` merges in the order learned, ties by ``(n desc, left, right)``.

    The loop runs over the table of distinct words, never over the texts. Pairs are counted
    whole once; after a round only the words that hold a merged pair are taken apart again,
    and the difference corrects the counts. A round takes as many pairs as :func:`independent_merges`
    allows; the driver receives ``looked_at`` pairs. Both tables are cut from their history every
    ``checkpoint_every`` rounds, and what was cached is released.
    """
    words = cut_lineage(word_table(docs, text))
    counts = cut_lineage(pair_counts(words))
    merges: list[tuple[str, str, int]] = []
    held: list[DataFrame] = []
    rounds = 0
    try:
        while len(merges) < n_merges:
            rows = counts.orderBy(F.desc("n"), "left", "right").limit(looked_at + 1).collect()
            top = [(r["left"], r["right"], r["n"]) for r in rows]
            together = independent_merges(top, len(top) <= looked_at)[: n_merges - len(merges)]
            merges += together
            if not together or len(merges) == n_merges:
                break
            merged = F.col("symbols")
            for left, right, _ in together:
                merged = merge_symbols(merged, left, right)
            touched = words.withColumn("merged", merged).filter(F.col("merged") != F.col("symbols"))
            change = F.array(
                F.struct(F.col("symbols"), (-F.col("n")).alias("n")),
                F.struct(F.col("merged").alias("symbols"), F.col("n")),
            )
            difference = pair_counts(touched.select(F.inline(change)))
            corrected = counts.unionByName(difference).groupBy("left", "right").agg(F.sum("n").alias("n"))
            words = words.withColumn("symbols", merged)
            rounds += 1
            if rounds % checkpoint_every == 0:
                words, counts = cut_lineage(words), cut_lineage(corrected.filter(F.col("n") > 0))
                while held:
                    held.pop().unpersist()
            else:
                counts = corrected.filter(F.col("n") > 0).persist()
                held.append(counts)
    finally:
        while held:
            held.pop().unpersist()
    return merges


def split_word(word: str, rank: dict[tuple[str, str], int]) -> list[str]:
    """The pieces of one word: the earliest-learned merge present is done first."""
    pieces = list(word)
    while len(pieces) > 1:
        best = min(zip(pieces, pieces[1:]), key=lambda p: rank.get(p, len(rank)))
        if best not in rank:
            break
        merged, i = [], 0
        while i < len(pieces):
            if tuple(pieces[i : i + 2]) == best:
                merged.append(pieces[i] + pieces[i + 1])
                i += 2
            else:
                merged.append(pieces[i])
                i += 1
        pieces = merged
    return pieces


def split_words(tokens: Column, split: Callable[[str], list[str]]) -> Column:
    """The pieces that ``split`` makes of every token of a token array, in order; null for a null array.

    Texts stay where they are: a batch goes through in slices of bounded size, the distinct words of a slice are split
    once and each Python worker remembers some, so no word needs a shuffle.
    """

    @F.arrow_udf("array<string>")
    def pieces_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            for at, n_rows in row_slices(batch):
                yield _slice_pieces(batch.slice(at, n_rows), split, known)

    return pieces_of(tokens)


def _slice_pieces(rows: pa.ListArray, split: Callable[[str], list[str]], known: dict[str, list[str]]) -> pa.ListArray:
    words = rows.flatten().dictionary_encode()
    parts = []
    for word in words.dictionary.to_pylist():
        pieces = known.get(word)
        if pieces is None:
            pieces = split(word)
            if len(known) < _CACHED_WORDS:
                known[word] = pieces
        parts.append(pieces)
    codes = words.indices.to_numpy()
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    flat = pa.array([piece for p in parts for piece in p], pa.string())
    # the pieces of each word stand together in `flat`
    first, n = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
    ends = np.append(0, np.cumsum(n))
    at = np.repeat(first - ends[:-1], n) + np.arange(ends[-1])
    cuts = ends[np.append(0, np.cumsum(np.asarray(rows.value_lengths().fill_null(0))))]
    # a null offset makes a null row
    gone = np.append(np.asarray(rows.is_null()), False)
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32), mask=gone), flat.take(pa.array(at)))


def subword_pieces(tokens: Column, merges: list[tuple[str, str, int]]) -> Column:
    """The pieces of every token of a token array by the learned merges, in order."""
    rank = {(left, right): i for i, (left, right, _) in enumerate(merges)}
    return split_words(tokens, lambda word: split_word(word, rank))


def apply_subwords(
    docs: DataFrame, merges: list[tuple[str, str, int]], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, pieces)`` for every text."""
    return docs.select(key, subword_pieces(ws_tokens(text), merges).alias("pieces"))
