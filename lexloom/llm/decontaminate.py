"""Benchmark passages in documents: q-gram lemma over diagonal bands, verified by banded alignment.

Texts are compared as lower-cased letters and digits with single blanks in between, so case, punctuation and
line breaks don't hide a passage. A passage of ``m`` bytes with at most ``k`` edits shares at least
``m + 1 - q (k + 1)`` q-grams with its pattern, and these lie on diagonals at most ``k`` apart.

At scale: documents are scanned once for each block of the benchmark and never shuffled; a block is bounded in
bytes, so is its index, and there is one block for any usual benchmark. Work per byte is a look-up in a small bit
table; q-gram hits are only spelled out where enough of them stand close together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import mix, pieces, run_lengths, utf8
from lexloom.session import cut_lineage

KEPT = np.zeros(256, dtype=bool)
KEPT[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
TABLE_BITS = 20


@dataclass(frozen=True)
class Lemma:
    """q, bytes of a pattern for each edit allowed, least and largest pattern in bytes, a passage's, and a block's.

    An item is a pattern as a whole or, beyond ``longest``, in blocks; so are its stretches of ``passage`` bytes, a new
    one every half of that and one that ends with the item. Any of them counts: an excerpt of one and a half times
    ``passage`` holds one wherever it is taken from. Items with fewer than ``shortest`` bytes after normalising are no evidence and never match.
    """

    q: int = 12
    bytes_per_edit: int = 16
    shortest: int = 24
    longest: int = 256
    passage: int = 96
    block_bytes: int = 4 << 20

    def edits(self, m: int) -> int:
        return min(m // self.bytes_per_edit, (m - self.q) // self.q)

    def cuts(self, m: int) -> list[tuple[int, int]]:
        """Start and size of the patterns of an item of ``m`` bytes."""
        found = set()
        for size, stride in ((self.longest, self.longest), (min(self.passage, self.longest), max(1, min(self.passage, self.longest) // 2))):
            found |= {(min(lo, max(0, m - size)), min(size, m)) for lo in range(0, m, stride)}
        return sorted(found)

    def least_hits(self, m: int) -> int:
        return m + 1 - self.q * (self.edits(m) + 1)


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts as they are compared; every text ends with a blank if it has any word."""
    data, at = utf8(pc.utf8_lower(column))
    kept = KEPT[data]
    last = np.zeros(len(data), dtype=bool)
    last[at[1:][at[1:] > at[:-1]] - 1] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = kept[:-1] & ~last[:-1]
    use = kept | before
    out = np.where(kept, data, 32).astype(np.uint8)[use]
    total = np.concatenate([[0], np.cumsum(use)])
    return out, total[at]


@dataclass
class Patterns:
    """The patterns of a block and the index of their q-grams."""

    items: np.ndarray
    texts: list[np.ndarray]
    grams: np.ndarray  # ascending keys
    owner: np.ndarray
    place: np.ndarray
    table: np.ndarray
    sizes: np.ndarray  # of the patterns: bytes, edits allowed, fewest shared q-grams
    edits: np.ndarray
    least: np.ndarray


def _gram_keys(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit key of the q bytes from every position, 8 <= q <= 16."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    raw = np.ascontiguousarray(data)
    wide = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    return mix(wide[:n] * np.uint64(0x9E3779B97F4A7C15) ^ wide[q - 8 : q - 8 + n])


def index_patterns(rows: list[tuple[int, str]], spec: Lemma) -> Patterns:
    items, texts = [], []
    data, at = normalised(pa.array([t or "" for _, t in rows], pa.string()))
    for (item, _), a, b in zip(rows, at[:-1].tolist(), at[1:].tolist(), strict=True):
        whole = data[a:b]
        whole = whole[: len(whole) - (len(whole) > 0 and whole[-1] == 32)]
        if len(whole) < spec.shortest:
            continue
        for lo, size in spec.cuts(len(whole)):
            items.append(item)
            texts.append(whole[lo : lo + size].copy())
    keys = [_gram_keys(t, spec.q) for t in texts]
    flat = np.concatenate([np.zeros(0, np.uint64), *keys])
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(k)) for k in keys)])
    order = np.argsort(flat, kind="stable")
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    table[(flat >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    sizes = [len(t) for t in texts]
    shape = [np.array(x, np.int64) for x in (sizes, list(map(spec.edits, sizes)), list(map(spec.least_hits, sizes)))]
    return Patterns(np.array(items, np.int64), texts, flat[order], owner[order], place[order].astype(np.int64), table, *shape)


def _dense_hits(data: np.ndarray, p: Patterns, spec: Lemma) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(position, pattern, position in it)`` of the shared q-grams, where the fewest that any pattern needs stand close together."""
    keys = _gram_keys(data, spec.q)
    near = np.flatnonzero(p.table[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
    fewest = int(p.least.min())
    reach = int((p.sizes + p.edits).max())
    if len(near) < fewest:
        return (np.zeros(0, np.int64),) * 3
    # hit number i is worth a look if it is among `fewest` neighbouring hits that stand within reach
    close = near[fewest - 1 :] - near[: len(near) - fewest + 1] < reach
    marks = np.zeros(len(near) + 1, np.int64)
    np.add.at(marks, np.flatnonzero(close), 1)
    np.add.at(marks, np.flatnonzero(close) + fewest, -1)
    near = near[np.cumsum(marks)[:-1] > 0]
    lo = np.searchsorted(p.grams, keys[near], "left")
    n = np.searchsorted(p.grams, keys[near], "right") - lo
    which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(near, n), p.owner[which], p.place[which]


def _banded(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, start: np.ndarray, patterns: np.ndarray, width: int) -> np.ndarray:
    """Least edits between row ``i`` of ``patterns`` and a stretch of ``data[lo[i]:hi[i]]`` on the ``width`` diagonals from ``start[i]``."""
    m = patterns.shape[1]
    slots = np.arange(width, dtype=np.int32)[:, None]
    place = start + np.arange(m + width)[:, None]
    # bytes beyond the text count as unequal
    near = np.where((place >= lo) & (place < hi), data[np.clip(place, 0, len(data) - 1)], 0)
    cost = np.zeros((width, len(start)), np.int32)
    for i in range(m):
        now = cost + (near[i : i + width] != patterns[:, i])
        np.minimum(now[:-1], cost[1:] + 1, out=now[:-1])
        now -= slots
        np.minimum.accumulate(now, axis=0, out=now)
        now += slots
        cost = now
    return cost.min(axis=0)


def banded_distance(data: np.ndarray, start: np.ndarray, pattern: np.ndarray, width: int) -> np.ndarray:
    """Least edits between ``pattern`` and a stretch of ``data`` on the ``width`` diagonals from each ``start``."""
    n = len(start)
    if not len(data):
        return np.full(n, len(pattern), np.int32)
    return _banded(data, np.zeros(n, np.int64), np.full(n, len(data)), start, np.broadcast_to(pattern, (n, len(pattern))), width)


def _candidates(place: np.ndarray, owner: np.ndarray, inner: np.ndarray, row: np.ndarray, p: Patterns) -> tuple[np.ndarray, ...]:
    """``(row, pattern, band, hits)`` of the bands of 2 k + 1 diagonals with the hits that a passage needs; bands overlap by half."""
    key = row * len(p.texts) + owner
    order = np.argsort(key, kind="stable")
    first, count = run_lengths(key[order])
    order = order[np.repeat(count >= p.least[owner[order[first]]], count)]
    key, band = key[order], (place[order] - inner[order]) // (p.edits[owner[order]] + 1)
    # any k + 1 neighbouring diagonals lie in one of the overlapping bands
    key, band = np.concatenate([key, key]), np.concatenate([band, band - 1])
    order = np.lexsort((band, key))
    key, band = key[order], band[order]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (band[1:] != band[:-1])
    first = np.flatnonzero(fresh)
    hits = np.diff(np.append(first, len(key)))
    key, band = key[first], band[first]
    enough = hits >= p.least[key % len(p.texts)]
    return key[enough] // len(p.texts), key[enough] % len(p.texts), band[enough], hits[enough]


def _verified(data: np.ndarray, at: np.ndarray, p: Patterns, row: np.ndarray, owner: np.ndarray, band: np.ndarray, step: int = 1024) -> np.ndarray:
    """Which candidates hold their pattern within its edits; those of one size of pattern are aligned together."""
    out = np.zeros(len(row), dtype=bool)
    for m in np.unique(p.sizes[owner]).tolist():
        own = np.flatnonzero(p.sizes[owner] == m)
        for lo in range(0, len(own), step):
            part = own[lo : lo + step]
            k = int(p.edits[owner[part[0]]])
            start = band[part] * (k + 1) - k
            texts = np.stack([p.texts[i] for i in owner[part].tolist()])
            out[part] = _banded(data, at[row[part]], at[row[part] + 1], start, texts, 4 * k + 2) <= k
    return out


def matches(data: np.ndarray, at: np.ndarray, p: Patterns, spec: Lemma) -> tuple[np.ndarray, np.ndarray]:
    """``(row, item)`` of every passage found, each once."""
    none = np.zeros(0, np.int64)
    if not p.texts:
        return none, none
    place, owner, inner = _dense_hits(data, p, spec)
    row = np.searchsorted(at, place, "right") - 1
    inside = place + spec.q <= at[row + 1]
    row, owner, band, hits = _candidates(place[inside], owner[inside], inner[inside], row[inside], p)
    # the fullest band of a row and item first, the others only where that one fails
    item = p.items[owner]
    order = np.lexsort((p.sizes[owner] - hits, item, row))
    row, owner, band, item = row[order], owner[order], band[order], item[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    group, first = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
    found = _verified(data, at, p, row[first], owner[first], band[first])
    rest = np.flatnonzero(~fresh & ~found[group])
    found[group[rest[_verified(data, at, p, row[rest], owner[rest], band[rest])]]] = True
    return row[first][found], item[first][found]


def _finder(shared, spec: Lemma, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            row, item = matches(*normalised(piece.column("text")), shared.value, spec)
            found: list[set[int]] = [set(x or ()) for x in piece.column("item_ids").to_pylist()]
            for r, i in zip(row.tolist(), item.tolist(), strict=True):
                found[r].add(i)
            lists = pa.array([sorted(x) for x in found], pa.list_(pa.int64()))
            yield pa.record_batch([*piece.select(columns).columns, lists], names=[*columns, "item_ids"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, spec: Lemma = Lemma()) -> DataFrame:
    """Each row of ``docs`` with ``item_ids``: the benchmark items that it has a passage of, ascending.

    ``docs`` has a ``text``, ``benchmark`` has ``item_id, text``; all columns of ``docs`` are returned (an ``item_ids``
    among them is replaced). A null or empty text matches nothing, nor do null or very short items; items with a
    null id are left out. Repeated rows and items are matched like others. Empty tables give no rows or no matches.
    """
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-size // spec.block_bytes))
    columns = [c for c in docs.columns if c != "item_ids"]
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*columns).dtypes)
    found = docs.select(*columns, F.array().cast("array<bigint>").alias("item_ids"))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        patterns = docs.sparkSession.sparkContext.broadcast(index_patterns([tuple(r) for r in block], spec))
        found = found.mapInArrow(_finder(patterns, spec, columns), f"{kinds}, item_ids array<bigint>")
        if k + 1 < blocks:
            found = cut_lineage(found)
    return found
