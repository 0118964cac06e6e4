"""Cutting byte spans out of texts: spans of a document are gathered by its id, texts are shuffled once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import as_binary, per_row, pieces, utf8


def digests_of(data: np.ndarray, at: np.ndarray) -> list[bytes]:
    """A 128-bit digest of every text."""
    return [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def tags_of(digests: list[bytes]) -> np.ndarray:
    """The first half of each digest as a number; tells texts of one ``doc_id`` apart."""
    return np.frombuffer(b"".join(digests), np.int64)[::2]


def _cut(length: int):
    """Applies the spans that carry the text's tag; an end below zero stands for a later copy of a whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            data, at = utf8(piece.column("text"))
            size = np.diff(at)
            lists = piece.column("spans")
            row = np.repeat(np.arange(piece.num_rows), lists.value_lengths().fill_null(0).to_numpy())
            tag, start, end = (lists.flatten().field(name).to_numpy() for name in ("tag", "start", "end"))
            own = tags_of(digests_of(data, at))[row] == tag
            row, start, end = row[own], start[own].astype(np.int64), end[own].astype(np.int64)
            whole = end < 0
            start = np.where(whole, 0, start)
            end = np.where(whole, np.where(size[row] >= length, size[row], 0), end)
            # one count of open spans over all texts: every span ends in its own text
            change = np.bincount(start + at[row], minlength=len(data) + 1) - np.bincount(end + at[row], minlength=len(data) + 1)
            gone = np.cumsum(change)[: len(data)] > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            lead = at[:-1][size > 0]
            opens[lead] = gone[lead]
            left = data[~gone]
            removed = per_row(gone, at)
            cuts = np.concatenate([[0], np.cumsum(size - removed)])
            sha = [hashlib.sha256(left[a:b]).hexdigest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(size), pa.array(removed), pa.array(per_row(opens, at)), pa.array(sha), as_binary(left, cuts)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"],
            )

    return run


CUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_bytes binary"


def cut_out(docs: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """Each row of ``docs`` (``doc_id, text``) without the spans ``(doc_id, tag, start, end)``.

    An end below zero removes a whole text of at least ``length`` bytes. What is gathered for a document is
    bounded by its own bytes.
    """
    grouped = spans.groupBy("doc_id").agg(F.collect_set(F.struct("tag", "start", "end")).alias("spans"))
    return docs.join(grouped, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_cut(length), CUT)
