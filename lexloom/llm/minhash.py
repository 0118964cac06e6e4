"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard, connected components.

Two permutations of a fixed universe give the whole signature: the first scatters the shingles, the second,
shifted by one place for each further coordinate, ranks them. A shingle's ranks for all coordinates are then
one contiguous slice of the second permutation.

At scale: equal shingle sets are one class before any banding, so copies cost one row each. Buckets and
representatives are aggregated per task first; a member meets its bucket's representative in a plain join.
Members of a bucket that already share a component are never paired again, which is what keeps a large
group of near copies near linear; the pairs that stay open after the representative rounds are all compared,
but for those whose own shingles (that no other candidate has) or parities rule the similarity out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import LOWER, as_lists, combine, mix, per_row, pieces, prefix_hash, run_lengths, span_hash, utf8, word_spans
from lexloom.llm.links import linked_components, shared_buckets
from lexloom.session import cut_lineage

@dataclass(frozen=True)
class Sketch:
    """Shape of the signature. 40 bands of 5 rows miss a pair of similarity 0.8 once in ten million."""

    shingle: int = 5
    bands: int = 40
    rows: int = 5
    universe: int = 1 << 21
    seed: int = 11
    num: int = 80  # linked if 100 * intersection >= num * union


@lru_cache(maxsize=2)
def _circulant(universe: int, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and a view whose row ``x`` holds the ranks of ``x`` in all coordinates."""
    rng = np.random.Generator(np.random.PCG64(seed))
    scatter = rng.permutation(universe).astype(np.uint32)
    rank = rng.permutation(universe).astype(np.uint32)
    rank = np.concatenate([rank, rank[:size]])
    return scatter, np.lib.stride_tricks.sliding_window_view(rank, size)


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, with offsets.

    A-Z count as a-z. A text of fewer words has its whole sequence as its one shingle; none without words.
    """
    n = len(at) - 1
    low = LOWER[data]
    starts, ends, row = word_spans(low, at)
    words = span_hash(prefix_hash(low), starts, ends)
    n_words = np.bincount(row, minlength=n)
    first = np.concatenate([[0], np.cumsum(n_words)])
    size = np.where(n_words == 0, 0, np.maximum(n_words - width + 1, 1))
    owner = np.repeat(np.arange(n), size)
    place = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    h = np.zeros(len(owner), np.uint64)
    for k in range(width):
        inside = k < n_words[owner]
        word = np.zeros(len(owner), np.uint64)
        word[inside] = words[place[inside] + k]
        h = combine(h + np.uint64(1), word)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[fresh], owner[fresh]
    return h, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


def signatures(h: np.ndarray, at: np.ndarray, spec: Sketch) -> np.ndarray:
    """Circulant MinHash coordinates, one row for each set that is not empty."""
    size = spec.bands * spec.rows
    scatter, ranks = _circulant(spec.universe, size, spec.seed)
    full = np.flatnonzero(np.diff(at))
    out = np.full((len(full), size), np.iinfo(np.uint32).max, np.uint32)
    place = scatter[(mix(h) % np.uint64(spec.universe)).astype(np.int64)]
    step = 4096
    bounds = at[full]
    for lo in range(0, len(h), step):
        hi = min(lo + step, len(h))
        a = np.searchsorted(bounds, lo, "right") - 1
        b = np.searchsorted(bounds, hi, "left")
        cuts = np.maximum(bounds[a:b], lo) - lo
        out[a:b] = np.minimum(out[a:b], np.minimum.reduceat(ranks[place[lo:hi]], cuts, axis=0))
    return out


def band_keys(sig: np.ndarray, spec: Sketch) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    grouped = sig.reshape(len(sig), spec.bands, spec.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(spec.bands, dtype=np.uint64), (len(sig), spec.bands)) + np.uint64(1)
    for r in range(spec.rows):
        key = combine(key, grouped[:, :, r])
    return key.view(np.int64)


#: Words of the parities that every set has, and of the finer ones for sets that stay open.
PARITY = [f"parity{k}" for k in range(4)]
FINE = [f"fine{k}" for k in range(32)]


def parities(h: np.ndarray, at: np.ndarray, words: int = len(PARITY)) -> list[np.ndarray]:
    """Which classes of shingles, 64 for each of ``words`` words, each set has an odd number of.

    Sets differ in these bits at most as often as in shingles, which bounds their similarity from above.
    """
    bit = (mix(h) >> np.uint64(65 - (64 * words).bit_length())).astype(np.int64)
    out = np.zeros((len(at) - 1, words), np.uint64)
    np.bitwise_xor.at(out, (np.repeat(np.arange(len(at) - 1), np.diff(at)), bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    return list(np.ascontiguousarray(out.view(np.int64).T))


def _apart(words: list[str], num: int) -> str:
    """SQL: the parities differ in no more shingles than the similarity allows."""
    bits = " + ".join(f"bit_count({p} ^ other_{p})" for p in words)
    return f"{100 + num} * ({bits}) <= {100 - num} * (n_shingles + other_n_shingles)"


def _sketcher(spec: Sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            h, at = shingle_sets(*utf8(piece.column("text")), spec.shingle)
            size = np.diff(at)
            full = np.flatnonzero(size)
            keys = band_keys(signatures(h, at, spec), spec)
            raw = h.view(np.uint8)
            digest = np.zeros(len(size), object)
            digest[:] = None
            for i in full:
                digest[i] = hashlib.blake2b(raw[8 * at[i] : 8 * at[i + 1]], digest_size=16).digest()
            ends = np.zeros(len(size) + 1, np.int32)
            np.cumsum(np.where(size > 0, spec.bands, 0), out=ends[1:])
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(size, pa.int64()), pa.array(list(digest), pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel(), pa.int64())), *map(pa.array, parities(h, at))],
                names=["doc_id", "n_shingles", "digest", "keys", *PARITY],
            )

    return run


def _set_writer(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            h, at = shingle_sets(*utf8(piece.column("text")), width)
            fine = map(pa.array, parities(h, at, len(FINE)))
            yield pa.record_batch([piece.column("doc_id"), as_lists(h.view(np.int64), at, pa.int64()), *fine], names=["node", "set", *FINE])

    return run


def _overlap(num: int, step: int = 512):
    """Keeps the pairs whose sets, compared in full, reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                piece = batch.slice(lo, step)
                n, sides, rows = piece.num_rows, [], []
                for side in ("set_a", "set_b"):
                    sides.append(piece.column(side).flatten().to_numpy())
                    rows.append(np.repeat(np.arange(n), piece.column(side).value_lengths().to_numpy()))
                size = np.bincount(rows[0], minlength=n) + np.bincount(rows[1], minlength=n)
                h, row = np.concatenate(sides), np.concatenate(rows)
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
                both = np.bincount(row[1:][same], minlength=n)
                yield piece.select(["a", "b"]).filter(pa.array(100 * both >= num * (size - both)))

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, num: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(_overlap(num), "a bigint, b bigint").distinct()


def _own_shingles(sets: DataFrame) -> DataFrame:
    """``(node, own)``: how many of its shingles no other candidate has; left out for ids that carry different texts."""
    shingles = sets.select("node", F.explode("set").alias("h"))
    alone = shingles.groupBy("h").agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
    of_set = F.xxhash64("set")
    single = sets.groupBy("node").agg(F.min(of_set).alias("low"), F.max(of_set).alias("high")).where("low = high").select("node")
    return alone.groupBy("node").agg(F.count(F.lit(1)).alias("own")).join(single, "node")


def class_components(classes: DataFrame, docs: DataFrame, spec: Sketch) -> DataFrame:
    """``(node, component)`` of the linked classes; ``classes`` has ``(node, n_shingles, keys)`` and the parities."""
    first = cut_lineage(shared_buckets(classes.select("node", "n_shingles", F.explode("keys").alias("bucket"))))
    wanted = first.select(F.col("node").alias("doc_id")).distinct()
    sets = cut_lineage(docs.select("doc_id", "text").join(wanted, "doc_id").mapInArrow(_set_writer(spec.shingle), "node bigint, set array<bigint>, " + ", ".join(f"{p} bigint" for p in FINE)))
    own = cut_lineage(_own_shingles(sets))
    members = first.join(own, "node", "left").na.fill(0, ["own"]).where(f"100 * (n_shingles - own) >= {spec.num} * n_shingles")
    members = members.join(classes.select("node", *PARITY).join(wanted.withColumnRenamed("doc_id", "node"), "node"), "node")
    # what two sets can share at most, as neither shares its own shingles, must reach the similarity
    most = "least(n_shingles - own, other_n_shingles - other_own)"
    reach = f"{100 + spec.num} * {most} >= {spec.num} * (n_shingles + other_n_shingles)"
    # and they may not differ in more shingles than it allows
    near = f"{reach} and {_apart(PARITY, spec.num)}"
    closer = sets.select("node", *FINE), ["n_shingles", "own", *FINE], f"{reach} and {_apart(FINE, spec.num)}"
    labels = linked_components(cut_lineage(members), ["n_shingles", "own", *PARITY], near, lambda pairs: _confirm(pairs, sets, spec.num), closer=closer)
    return classes.select("node", F.col("node").alias("component")).limit(0) if labels is None else labels


def near_duplicates(docs: DataFrame, spec: Sketch = Sketch()) -> DataFrame:
    """Each row of ``docs`` with ``n_shingles``, ``component_id`` and ``kept``; other columns are ignored.

    A null or empty text has no shingle and is linked with nothing. Rows that share a ``doc_id`` are one
    document of the graph: a link of any of them counts for all, and each row is returned. A row without
    ``doc_id`` takes the component of equal sets that have one, else its component is null and it is kept.
    An empty table gives no rows. Sets are compared as 64-bit shingle hashes in full.
    """
    docs = docs.select("doc_id", "text")
    sketch = cut_lineage(docs.mapInArrow(_sketcher(spec), "doc_id bigint, n_shingles bigint, digest binary, keys array<bigint>, " + ", ".join(f"{p} bigint" for p in PARITY)))
    groups = (
        sketch.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys"), F.first("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("n"), *(F.first(p).alias(p) for p in PARITY))
    )
    groups = cut_lineage(groups)
    labels = class_components(groups.where("node is not null").select("node", "n_shingles", "keys", *PARITY), docs, spec)
    # only sets that occur twice or are linked need the way back
    named = groups.select("digest", "node", "n").join(labels, "node", "left").where("n > 1 or component is not null")
    named = named.select("digest", F.coalesce("component", "node").alias("component"))
    # plain exchanges: a set with very many copies makes a large part, which Spark's skew handling splits
    joined = sketch.select("doc_id", "n_shingles", "digest").join(named.hint("merge"), "digest", "left")
    component = F.coalesce("component", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
