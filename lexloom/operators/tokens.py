"""Token tables: vocabularies, encoding and decoding, padding, positions, reports."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexloom.functions.text import LEADING_SPACE_MARK, char_tokens, letter_tokens, ws_tokens
from lexloom.operators.frames import checked_join, salted_join, unnest
from lexloom.session import cut_lineage

# Special tokens; their IDs are 0 to 3 in this order.
SPECIALS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"]
PAD_ID, UNK_ID, CLS_ID, SEP_ID = range(4)

# A vocabulary counted to have this many rows (some tens of MB) goes to every task; a larger one is joined by shuffle.
SENT_VOCAB = 200_000
# List elements that a worker handles at a time (a longer row goes alone), so that its memory does not grow with a batch.
SLICE_ELEMENTS = 1 << 18


def token_counts(docs: DataFrame, tokens: Column) -> DataFrame:
    """``(token, n)`` over all texts; counted inside each task before the shuffle."""
    return unnest(docs, tokens).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def build_vocab(
    docs: DataFrame, size: int, min_count: int = 1, text: str = "text", tokens: Column | None = None
) -> DataFrame:
    """``(id, token, n)``: the special tokens, then the ``size`` most frequent tokens.

    IDs follow ``(n desc, token)``. They are numbered after the limit, on at most ``size`` rows.
    """
    counts = token_counts(docs, ws_tokens(text) if tokens is None else tokens)
    best = (
        counts.filter((F.col("n") >= min_count) & ~F.col("token").isin(SPECIALS))
        .orderBy(F.desc("n"), "token")
        .limit(size)
    )
    number = F.row_number().over(W.orderBy(F.desc("n"), "token")) + F.lit(len(SPECIALS) - 1)
    words = best.select(number.cast("int").alias("id"), "token", "n")
    specials = docs.sparkSession.createDataFrame(
        [(i, t, 0) for i, t in enumerate(SPECIALS)], "id int, token string, n bigint"
    )
    return specials.unionByName(words)


def _vocab_lists(vocab: DataFrame, most: int) -> tuple[DataFrame, list[str] | None]:
    """The vocabulary as a written table, and its tokens by ID if it has at most ``most`` rows."""
    written = cut_lineage(vocab.select("id", "token"))
    rows = written.limit(most + 1).toArrow()
    if rows.num_rows > most:
        return written, None
    tokens: list[str] = [SPECIALS[UNK_ID]] * (1 + max(rows.column("id").to_pylist(), default=UNK_ID))
    for i, token in zip(rows.column("id").to_pylist(), rows.column("token").to_pylist(), strict=True):
        tokens[i] = token
    return written, tokens


def row_slices(lists: pa.ListArray, most: int = SLICE_ELEMENTS) -> Iterator[tuple[int, int]]:
    """``(first row, rows)`` of consecutive slices that cover ``lists``, of up to ``most`` elements or one row each."""
    ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)), dtype=np.int64)
    at, before = 0, 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, to - at
        at, before = to, int(ends[to - 1])


def _in_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, n in row_slices(batch.column(column)):
            yield batch.slice(at, n)


def _encoder(shared, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value)
        for batch in _in_slices(batches, len(columns)):
            tokens = batch.column(len(columns))
            lengths = np.asarray(tokens.value_lengths().fill_null(0))
            ids = pc.fill_null(pc.index_in(tokens.flatten(), value_set=known), UNK_ID).to_numpy()
            ends = np.cumsum(lengths + 2)
            flat = np.full(int(ends[-1]) if len(ends) else 0, SEP_ID, np.int32)
            starts = ends - lengths - 2
            flat[starts] = CLS_ID
            flat[np.arange(len(ids)) + 2 * np.repeat(np.arange(len(lengths)), lengths) + 1] = ids
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat))
            yield pa.record_batch([*batch.columns[: len(columns)], lists], names=[*columns, "ids"])

    return run


def encode(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text", most: int = SENT_VOCAB) -> DataFrame:
    """``(key, ids)``: token IDs with the class token in front and the separator behind.

    A vocabulary counted to have at most ``most`` rows goes to every task, which looks tokens up where
    the text is read. Beyond that, tokens are joined and the tokens of one text are collected again; such a
    group is never larger than one input row.
    """
    table, tokens = _vocab_lists(vocab, most)
    words = docs.select(key, ws_tokens(text).alias("tokens"))
    if tokens is not None:
        shared = docs.sparkSession.sparkContext.broadcast(tokens)
        return words.mapInArrow(_encoder(shared, [key]), f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>")
    # a text without tokens stays as one row without a position: it gets the two special tokens
    apart = words.select(key, F.posexplode_outer("tokens").alias("pos", "token"))
    ids = salted_join(apart, table, "token", by="pos", how="left")
    entry = F.struct("pos", F.coalesce("id", F.lit(UNK_ID)).alias("id"))
    body = F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), entry)))
    ids_of = F.concat(
        F.array(F.lit(CLS_ID)), F.transform(body, lambda s: s["id"]), F.array(F.lit(SEP_ID))
    )
    return ids.groupBy(key).agg(ids_of.alias("ids"))


def lookup_tokens(rows: DataFrame, vocab: DataFrame, by: str = "pos", most: int = SENT_VOCAB) -> DataFrame:
    """Add the ``token`` of each ``id``; an ID outside the vocabulary shows as unknown."""
    named = checked_join(rows, vocab.select("id", "token"), "id", by, "left", most)
    return named.withColumn("token", F.coalesce("token", F.lit(SPECIALS[UNK_ID])))


def _decoder(shared, columns: list[str], hidden: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value)
        for batch in _in_slices(batches, len(columns)):
            lists = batch.column(len(columns))
            lengths = np.asarray(lists.value_lengths().fill_null(0))
            ids = np.asarray(pc.fill_null(lists.flatten(), UNK_ID))
            shown = ~np.isin(ids, hidden)
            row = np.repeat(np.arange(len(lengths)), lengths)[shown]
            inside = (ids >= 0) & (ids < len(known))
            tokens = known.take(pa.array(np.where(inside, ids, UNK_ID)[shown]))
            cuts = np.append(0, np.cumsum(np.bincount(row, minlength=len(lengths)))).astype(np.int32)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), tokens), " ")
            yield pa.record_batch([*batch.columns[: len(columns)], texts], names=[*columns, "text"])

    return run


def decode(
    encoded: DataFrame, vocab: DataFrame, key: str = "doc_id", skip_special: bool = True, most: int = SENT_VOCAB
) -> DataFrame:
    """``(key, text)``: IDs back to tokens joined by spaces.

    With ``skip_special`` padding, class and separator tokens are left out; unknown stays. As in
    :func:`encode`, a vocabulary of at most ``most`` rows needs no shuffle.
    """
    hidden = [PAD_ID, CLS_ID, SEP_ID] if skip_special else []
    table, tokens = _vocab_lists(vocab, most)
    if tokens is not None:
        shared = encoded.sparkSession.sparkContext.broadcast(tokens)
        kinds = f"`{key}` {encoded.schema[key].dataType.simpleString()}, text string"
        return encoded.select(key, F.col("ids").cast("array<int>")).mapInArrow(_decoder(shared, [key], hidden), kinds)
    rows = unnest(encoded, "ids", key, name="id", pos="pos")
    rows = rows.withColumn("_shown", ~F.col("id").isin(hidden) if hidden else F.lit(True))
    named = salted_join(rows, table, "id", by="pos", how="left").withColumn("token", F.coalesce("token", F.lit(SPECIALS[UNK_ID])))
    ordered = F.sort_array(
        F.collect_list(F.when(F.col("_shown"), F.struct("pos", "token")))
    )
    return named.groupBy(key).agg(
        F.array_join(F.transform(ordered, lambda s: s["token"]), " ").alias("text")
    )


def pad_batch(encoded: DataFrame, batch: str, key: str = "doc_id", pad_id: int = PAD_ID) -> DataFrame:
    """Pad the IDs on the right to the longest row of their batch; add the attention mask.

    Only the batch's length is aggregated and joined back, so a large batch is not gathered. ``encoded`` is
    read twice: pass a written table.
    """
    longest = encoded.groupBy(batch).agg(F.max(F.size("ids")).alias("_longest"))
    filled = F.concat("ids", F.array_repeat(F.lit(pad_id), F.col("_longest") - F.size("ids")))
    padded = checked_join(encoded, longest, batch, by=key).withColumn("ids", filled).drop("_longest")
    return padded.withColumn("mask", attention_mask("ids", pad_id))


def attention_mask(ids: Column | str, pad_id: int = PAD_ID) -> Column:
    """1 for tokens, 0 for padding."""
    return F.transform(ids, lambda i: F.when(i == pad_id, 0).otherwise(1))


def token_breakdown(docs: DataFrame, tokens: Column, key: str = "doc_id") -> DataFrame:
    """One row per token with its 0-based position."""
    return unnest(docs, tokens, key, pos="pos")


def find_token(docs: DataFrame, tokens: Column, words: list[str], key: str = "doc_id") -> DataFrame:
    """All positions at which a token is one of ``words``, plain or with the space marker.

    Rows: ``(key, pos, word)``; exact case, 0-based.
    """
    forms = [w for word in words for w in (word, LEADING_SPACE_MARK + word)]
    found = F.filter(
        F.transform(tokens, lambda t, i: F.struct(i.alias("pos"), t.alias("token"))),
        lambda s: s["token"].isin(forms),
    )
    bare = F.regexp_replace("s.token", "^" + LEADING_SPACE_MARK, "")
    word = F.when(F.col("s.token").isin(words), F.col("s.token")).otherwise(bare)
    return unnest(docs, found, key, name="s").select(
        key, F.col("s.pos").alias("pos"), word.alias("word")
    )


# The tokenizer variants of the report.
VARIANTS = ["whitespace", "lower letters", "character"]


def tokenizer_report(
    docs: DataFrame,
    min_count: int = 2,
    text: str = "text",
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Compare tokenizers on one corpus.

    Per variant: tokens, distinct tokens, vocabulary (tokens seen ``min_count`` times), tokens
    per text and the share of tokens outside the vocabulary. All variants are counted in one
    pass over the texts, inside each task before the shuffle. ``extra`` adds token columns.
    """
    columns = dict(zip(VARIANTS, (ws_tokens(text), letter_tokens(text), char_tokens(text)), strict=True))
    columns.update(extra or {})
    tagged = F.array(
        *[F.struct(F.lit(name).alias("variant"), tokens.alias("tokens")) for name, tokens in columns.items()]
    )
    counts = (
        unnest(unnest(docs, tagged, name="v").select("v.*"), "tokens", "variant")
        .groupBy("variant", "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n_docs = docs.select(F.count(F.lit(1)).cast("double")).scalar()
    known = F.col("n") >= min_count
    totals = counts.groupBy("variant").agg(
        F.sum("n").alias("tokens"),
        F.count(F.lit(1)).alias("distinct_tokens"),
        F.count_if(known).alias("vocab_size"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).cast("double").alias("unknown"),
    )
    return totals.select(
        "variant",
        "tokens",
        "distinct_tokens",
        "vocab_size",
        (F.col("tokens").cast("double") / n_docs).alias("tokens_per_doc"),
        (F.col("unknown") / F.col("tokens").cast("double")).alias("unknown_rate"),
    )
