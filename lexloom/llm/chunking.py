"""Content-defined chunks by a gear rolling hash, deduplicated by digest.

A cut falls where the leading bits of the gear hash are zero; the hash sees the last 32 bytes only, so an insertion
moves the cuts next to it and no others. Chunks with a digest that stands earlier (by document, then position)
are cut out. Digests are reduced to their first place per task before they are shuffled; only digests that
occur twice are joined back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import pieces, utf8
from lexloom.llm.spans import cut_out, digests_of, tags_of
from lexloom.session import cut_lineage

GEAR = np.random.Generator(np.random.PCG64(32)).integers(0, 1 << 32, 256, dtype=np.uint32)


@dataclass(frozen=True)
class Chunks:
    """Least and largest chunk in bytes, and how many leading bits of the hash are zero at a cut.

    A chunk is about ``least + 2 ** bits`` bytes. Only a text's last chunk may be shorter than ``least``; it is
    never taken for a repeat.
    """

    least: int = 32
    most: int = 256
    bits: int = 5


def gear_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rolling hash ``h = 2 h + gear[byte]`` modulo 2**32 after every byte, begun anew in every text."""
    h = GEAR[data]
    since = np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))
    width = 1
    while width < 32:
        earlier = np.zeros_like(h)
        earlier[width:] = h[:-width] << np.uint32(width)
        earlier[since < width] = 0
        h = h + earlier
        width *= 2
    return h


def chunk_spans(data: np.ndarray, at: np.ndarray, spec: Chunks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every chunk, in order; all texts advance by one chunk at a time."""
    cuts = np.flatnonzero(gear_hashes(data, at) >> np.uint32(32 - spec.bits) == 0) + 1
    cuts = np.append(cuts, len(data) + spec.most)
    row = np.flatnonzero(np.diff(at) > 0)
    start, stop = at[row], at[row + 1]
    starts, ends, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(row):
        end = cuts[np.searchsorted(cuts, start + spec.least)]
        end = np.minimum(np.minimum(end, start + spec.most), stop)
        starts.append(start)
        ends.append(end)
        rows.append(row)
        on = end < stop
        row, start, stop = row[on], end[on], stop[on]
    starts, ends, rows = np.concatenate(starts), np.concatenate(ends), np.concatenate(rows)
    order = np.argsort(starts)
    return starts[order], ends[order], rows[order]


def _chunker(spec: Chunks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            data, at = utf8(piece.column("text"))
            start, end, row = chunk_spans(data, at, spec)
            big = end - start >= spec.least
            start, end, row = start[big], end[big], row[big]
            raw = memoryview(np.ascontiguousarray(data))
            digest = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            tags = tags_of(digests_of(data, at))
            yield pa.record_batch(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), piece.column("doc_id").take(pa.array(row)), pa.array(tags[row]),
                 pa.array((start - at[row]).astype(np.int32)), pa.array((end - at[row]).astype(np.int32))],
                names=["d1", "d2", "doc_id", "tag", "start", "end"],
            )

    return run




def repeated_chunks(docs: DataFrame, spec: Chunks = Chunks()) -> DataFrame:
    """``(doc_id, tag, start, end, first_doc)`` of every chunk that stands earlier, in this document or a smaller one."""
    known = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    chunks = known.mapInArrow(_chunker(spec), "d1 bigint, d2 bigint, doc_id bigint, tag bigint, start int, end int")
    place = F.struct("doc_id", "tag", "start")
    firsts = chunks.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("d1", "d2", "first")
    # a written table, so that a digest which a large share of all rows has can be split where the sides meet
    return (
        chunks.join(cut_lineage(firsts), ["d1", "d2"])
        .where(place > F.col("first"))
        .select("doc_id", "tag", "start", "end", F.col("first.doc_id").alias("first_doc"))
    )


def remove_chunks(docs: DataFrame, spec: Chunks = Chunks()) -> DataFrame:
    """Each row with ``n_bytes, n_removed, n_spans, kept_sha256`` and ``kept_bytes``: its text without repeated chunks.

    The first place of a chunk stays: the smallest ``doc_id``, then the smallest position. A null or empty text has
    no chunks. Rows with equal ``doc_id`` and text are one document and are cut alike; a row without ``doc_id`` is
    left whole and removes nothing. Other columns are ignored; an empty table gives no rows.
    """
    return cut_out(docs.select("doc_id", "text"), repeated_chunks(docs, spec).drop("first_doc"), spec.least)
