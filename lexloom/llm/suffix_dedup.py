"""Repeated byte strings across documents, found by sorting suffixes, and cut out.

Every string of ``length`` bytes holds a winnowing anchor: the smallest hash of its q-grams. Equal strings have equal
anchors, so a string can only repeat if its anchor does. One pass marks the anchors that occur in different texts;
a second pass hands on the surroundings of the marked ones, each distinct surrounding once per task. All
surroundings of an anchor go to one shard, whose suffixes are sorted externally; neighbours with a common prefix
of ``length`` are equal strings, and their smallest document is sent back to where they stand.

At scale: both passes read the corpus without shuffling texts; the marks are a bit table of bounded size (when it
fills up, more surroundings are sorted, the result stays the same); a passage that a third of all documents share
is one row per task and shard; shards are sorted on the task's own disk, in memory bounded by a parameter.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import INVERSE, combine, mix, pieces, powers, prefix_hash, run_lengths, span_hash, utf8
from lexloom.llm.spans import cut_out, digests_of, tags_of
from lexloom.llm.suffix_sort import CAP, sorted_suffixes
from lexloom.session import cut_lineage

SALTS = 16


@dataclass(frozen=True)
class Repeats:
    """Length of a repeated string in bytes; q-gram of the anchors; bounds of a task's memory and of the bit table."""

    length: int = 50
    gram: int = 20
    held: int = 1 << 21
    table_bits: int = 1 << 30
    part_bits: int = 1 << 22
    known_copies: int = 1 << 21
    part_bytes: int = 16 << 20
    shard_bytes: int = 2 << 20
    queue_items: int = 1 << 20

    @property
    def window(self) -> int:
        return self.length - self.gram + 1


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every run of ``width`` neighbours, by doubling."""
    k = 1
    while 2 * k <= width:
        x = pick(x[:-k], x[k:])
        k *= 2
    return pick(x[: len(x) - (width - k)], x[width - k :]) if k < width else x


def anchors(data: np.ndarray, at: np.ndarray, spec: Repeats):
    """Positions and hashes of all anchors, and for every window start the hash of its anchor (0: no window)."""
    n, q, w = len(data), spec.gram, spec.window
    if n < spec.length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    sums = prefix_hash(data)
    grams = mix((sums[q:] - sums[:-q]) * powers(n + 1, INVERSE)[: n - q + 1]) | np.uint64(1)
    least = _sliding(grams, w, np.minimum)
    inside = np.zeros(len(least) + 1, np.int32)
    lo, hi = at[:-1], at[1:] - spec.length + 1
    real = hi > lo
    np.add.at(inside, lo[real], 1)
    np.add.at(inside, hi[real], -1)
    least[np.cumsum(inside)[:-1] == 0] = 0
    around = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    place = np.flatnonzero(_sliding(around, w, np.maximum)[: len(grams)] == grams)
    return place, grams[place], least


def _row_key(ids: np.ndarray, tags: np.ndarray) -> np.ndarray:
    return combine(ids.view(np.uint64), tags.view(np.uint64)).view(np.int64)


class _FirstCopies:
    """Skips a text that is known as a later copy, or that the task has seen with the same or a smaller id."""

    def __init__(self, later) -> None:
        self.later = later.value
        self.least: dict[int, int] = {}

    def fresh(self, tags: np.ndarray, ids: np.ndarray) -> np.ndarray:
        keys = _row_key(ids, tags)
        place = np.minimum(np.searchsorted(self.later, keys), max(len(self.later) - 1, 0))
        out = self.later[place] != keys if len(self.later) else np.ones(len(keys), dtype=bool)
        for k in np.flatnonzero(out).tolist():
            tag, i = int(tags[k]), int(ids[k])
            out[k] = i < self.least.get(tag, i + 1)
            if out[k]:
                self.least[tag] = i
        return out


def _rows(batches: Iterator[pa.RecordBatch], later):
    """Pieces with the first copies of the task: ids, tags, bytes and offsets."""
    copies = _FirstCopies(later)
    for piece in pieces(batches, "text"):
        tags = tags_of(digests_of(*utf8(piece.column("text"))))
        ids = piece.column("doc_id").to_numpy()
        fresh = copies.fresh(tags, ids)
        yield ids[fresh], tags[fresh], *utf8(piece.column("text").filter(pa.array(fresh)))


def _anchor_blocks(spec: Repeats, parts: int, later):
    """Per part the anchors of a task, once each, with a flag on those that two of its texts have."""

    def flush(hashes: list[np.ndarray], owners: list[np.ndarray]):
        h, o = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(h, kind="stable")
        h, o = h[order], o[order]
        first, length = run_lengths(h)
        if not len(first):
            return
        several = np.minimum.reduceat(o, first) != np.maximum.reduceat(o, first)
        h = h[first]
        part = (h >> np.uint64(32)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        low, part, several = h[order].astype(np.uint32), part[order], several[order]
        cut, length = run_lengths(part)
        yield pa.record_batch(
            [pa.array(part[cut].astype(np.int32)), pa.array([low[a : a + n].tobytes() for a, n in zip(cut, length, strict=True)], pa.binary()),
             pa.array([low[a : a + n][several[a : a + n]].tobytes() for a, n in zip(cut, length, strict=True)], pa.binary())],
            names=["part", "seen", "several"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, owners, held, base = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0, 0
        for ids, _, data, at in _rows(batches, later):
            place, h, _ = anchors(data, at, spec)
            hashes.append(h)
            owners.append(base + np.searchsorted(at, place, "right"))
            held, base = held + len(h), base + len(ids)
            if held > spec.held:
                yield from flush(hashes, owners)
                hashes, owners, held = hashes[:1], owners[:1], 0
        yield from flush(hashes, owners)

    return run


def _mark(bits: int):
    """The bit table of each part: a bit for every anchor that two tasks or two texts of a task have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[np.ndarray]] = {}
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, low, several in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                seen.setdefault(part, []).append(np.frombuffer(low, np.uint32))
                table = tables.setdefault(part, np.zeros(bits, dtype=bool))
                table[np.frombuffer(several, np.uint32) % bits] = True
        for part, parts in seen.items():
            h = np.sort(np.concatenate(parts))
            tables[part][h[1:][h[1:] == h[:-1]] % bits] = True
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([np.packbits(tables[part]).tobytes()], pa.binary())], names=["part", "bits"])

    return run


def _surroundings(spec: Repeats, parts: int, bits: int, table, later, with_bytes: bool):
    """The windows around each marked anchor: as occurrences, or with their bytes, distinct ones once per task."""

    def found(batches):
        marks = table.value
        for ids, tags, data, at in _rows(batches, later):
            place, h, least = anchors(data, at, spec)
            part = (h >> np.uint64(32)) % np.uint64(parts)
            bit = part.astype(np.int64) * bits + (h.astype(np.uint32) % np.uint32(bits)).astype(np.int64)
            hit = (marks[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 > 0
            place, h = place[hit], h[hit]
            start, stop = np.full(len(place), -1), np.full(len(place), -1)
            for back in range(spec.window):
                s = place - back
                own = (s >= 0) & (s < len(least))
                own[own] = least[s[own]] == h[own]
                start[own] = s[own]
                stop[own & (stop < 0)] = s[own & (stop < 0)]
            stop = stop + spec.length
            row = np.searchsorted(at, start, "right") - 1
            sid = combine(span_hash(prefix_hash(data), start, stop), h)
            yield ids[row], tags[row], (start - at[row]), start, stop, h.view(np.int64), sid.view(np.int64), data

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tags, offset, _, _, _, sid, _ in found(batches):
            yield pa.record_batch([pa.array(sid), pa.array(ids.astype(np.int64)), pa.array(tags), pa.array(offset.astype(np.int32))], names=["sid", "doc_id", "tag", "at"])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for ids, _, _, start, stop, h, sid, data in found(batches):
            order = np.lexsort((ids, sid))
            first, length = run_lengths(sid[order])
            low, high = order[first], order[first + length - 1]
            raw = data.tobytes()
            for s, a, b, anchor, i, j in zip(*(x.tolist() for x in (sid[low], start[low], stop[low], h[low], ids[low], ids[high])), strict=True):
                known = held.get(s)
                if known is None:
                    held[s] = [anchor, raw[a:b], i, j]
                    size += b - a + 200
                else:
                    known[2], known[3] = min(known[2], i), max(known[3], j)
            if size > 16 * spec.held:
                yield _distinct_batch(held)
                held, size = {}, 0
        if held:
            yield _distinct_batch(held)

    return distinct if with_bytes else occurrences


def _distinct_batch(held: dict[int, list]) -> pa.RecordBatch:
    anchor, text, least, most = zip(*held.values(), strict=True)
    return pa.record_batch(
        [pa.array(anchor, pa.int64()), pa.array(list(held), pa.int64()), pa.array(text, pa.binary()), pa.array(least, pa.int64()), pa.array(most, pa.int64())],
        names=["anchor", "sid", "bytes", "least", "most"],
    )


RUNS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("first", pa.int64())]))


def _uniform(sids: np.ndarray, sizes: np.ndarray, least: np.ndarray, spec: Repeats) -> pa.RecordBatch:
    """Surroundings that are their anchor's only ones: all their windows stand first where they themselves do."""
    runs = pa.StructArray.from_arrays(
        [pa.array(np.zeros(len(sids), np.int32)), pa.array((sizes - spec.length).astype(np.int32)), pa.array(least)], names=["from", "to", "first"]
    )
    return pa.record_batch([pa.array(sids), pa.ListArray.from_arrays(pa.array(np.arange(len(sids) + 1, dtype=np.int32)), runs)], names=["sid", "runs"])


class _Shard:
    """The text that a shard has to sort: different surroundings of one anchor, each once, written as they come."""

    def __init__(self, folder: Path) -> None:
        self.folder, self.size = folder, 0
        self.sids: list[int] = []
        self.least: list[int] = []
        self.most: list[int] = []
        self.starts: list[int] = []

    def add(self, batch: pa.RecordBatch) -> None:
        """All rows of some anchors."""
        index: dict[int, int] = {}
        with (self.folder / "text").open("ab") as out:
            for sid, text, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("sid", "bytes", "least", "most")), strict=True):
                k = index.setdefault(sid, len(self.sids))
                if k == len(self.sids):
                    (np.frombuffer(text + b"\xff", np.uint8).astype(np.int16) + 1).tofile(out)
                    self.sids.append(sid)
                    self.starts.append(self.size)
                    self.size += len(text) + 1
                    self.least.append(lo)
                    self.most.append(hi)
                else:
                    self.least[k], self.most[k] = min(self.least[k], lo), max(self.most[k], hi)

    def runs(self, spec: Repeats):
        if self.sids:
            with (self.folder / "text").open("ab") as out:
                np.zeros(1, np.int16).tofile(out)
            yield from _runs(self.folder, self.size, np.array(self.starts), np.array(self.least), np.array(self.most), np.array(self.sids), spec)


def _sort_shard(spec: Repeats):
    """Gives for each surrounding the runs of windows with an earlier document; rows come ordered by anchor.

    An anchor with one surrounding needs no sorting: a window that it has can have no other anchor.
    """

    def settle(batch: pa.RecordBatch, shard: _Shard):
        anchor, sid = batch.column("anchor").to_numpy(), batch.column("sid").to_numpy()
        first, length = run_lengths(anchor)
        same = np.minimum.reduceat(sid, first) == np.maximum.reduceat(sid, first)
        least = np.minimum.reduceat(batch.column("least").to_numpy(), first)
        most = np.maximum.reduceat(batch.column("most").to_numpy(), first)
        useful = first[same & (least < most)]
        if len(useful):
            sizes = np.diff(utf8(batch.column("bytes"))[1])
            yield _uniform(sid[useful], sizes[useful], least[same & (least < most)], spec)
        mixed = np.repeat(~same, length)
        if mixed.any():
            shard.add(batch.filter(pa.array(mixed)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as scratch:
            shard, waiting = _Shard(Path(scratch)), None
            for batch in batches:
                if not batch.num_rows:
                    continue
                whole = batch if waiting is None else pa.concat_batches([waiting, batch])
                # the last anchor may go on in the next batch
                anchor = whole.column("anchor").to_numpy()
                cut = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if anchor[0] != anchor[-1] else 0
                if cut:
                    yield from settle(whole.slice(0, cut), shard)
                waiting = whole.slice(cut)
            if waiting is not None:
                yield from settle(waiting, shard)
            yield from shard.runs(spec)

    return run


def _runs(folder: Path, size: int, starts: np.ndarray, least: np.ndarray, most: np.ndarray, sids: np.ndarray, spec: Repeats):
    text = np.memmap(folder / "text", np.int16, "r", shape=(size + 1,))
    # the file holds ranks of documents, which are shorter than their ids
    documents, least = np.unique(least, return_inverse=True)
    first = np.asarray(np.memmap(folder / "first", np.int32, "w+", shape=(size,)))
    ends = np.append(starts[1:], size) - 1
    open_at, open_least = np.zeros(0, np.int64), None
    for positions, lcps in sorted_suffixes(text, 258, folder / "sort", spec.queue_items, cap=max(CAP, spec.length)):
        owner = np.searchsorted(starts, positions, "right") - 1
        whole = ends[owner] - positions >= spec.length
        doc = np.where(whole, least[owner], len(documents)).astype(np.int32)
        fresh = lcps < spec.length
        cut = np.flatnonzero(fresh)
        head = int(cut[0]) if len(cut) else len(positions)
        if head:
            # goes on with the run that the last block left open
            low = int(doc[:head].min())
            open_least = low if open_least is None else min(open_least, low)
            open_at = np.append(open_at, positions[:head])
        if len(cut):
            if open_least is not None:
                first[open_at] = open_least
            run_least = np.minimum.reduceat(doc, cut)
            length = np.diff(np.append(cut, len(positions)))
            first[positions[head:]] = np.repeat(run_least, length)
            open_at, open_least = positions[cut[-1] :], int(run_least[-1])
    if open_least is not None:
        first[open_at] = open_least
    for lo in range(0, len(starts), 1 << 14):
        a, b = starts[lo : lo + (1 << 14)], ends[lo : lo + (1 << 14)] - spec.length + 1
        n = np.maximum(b - a, 0)
        owner = np.repeat(np.arange(len(a)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        value = documents[first[np.repeat(a, n) + offset]]
        fresh = np.ones(len(value), dtype=bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        cut = np.flatnonzero(fresh)
        stop = np.append(cut[1:], len(value)) - 1
        useful = value[cut] < most[lo + owner[cut]] if len(cut) else np.zeros(0, dtype=bool)
        cut, stop = cut[useful], stop[useful]
        runs = pa.StructArray.from_arrays(
            [pa.array(offset[cut].astype(np.int32)), pa.array(offset[stop].astype(np.int32)), pa.array(value[cut])], names=["from", "to", "first"]
        )
        count = np.bincount(owner[cut], minlength=len(a))
        some = count > 0
        bounds = np.concatenate([[0], np.cumsum(count[some])]).astype(np.int32)
        yield pa.record_batch([pa.array(sids[lo : lo + len(a)][some]), pa.ListArray.from_arrays(pa.array(bounds), runs)], names=["sid", "runs"])


def _tagger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        digests = digests_of(*utf8(piece.column("text")))
        tags = tags_of(digests)
        yield pa.record_batch([piece.column("doc_id"), pa.array(digests, pa.binary()), pa.array(tags)], names=["doc_id", "digest", "tag"])


def later_copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, tag)`` of texts that a smaller ``doc_id`` has as well, whole."""
    rows = docs.select("doc_id", "text").mapInArrow(_tagger, "doc_id bigint, digest binary, tag bigint")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    salted = firsts.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod("doc_id", F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", salt).join(salted, ["digest", "salt"]).where("doc_id > first").select("doc_id", "tag")


def repeated_spans(docs: DataFrame, copies: DataFrame, spec: Repeats = Repeats()) -> DataFrame:
    """``(doc_id, tag, start, end)``: bytes covered by a string that a smaller ``doc_id`` has; exact copies aside.

    ``tag`` tells texts of one ``doc_id`` apart. Spans overlap. ``copies`` are the whole repeats, a written table; they
    are not looked at again if their number is within ``known_copies``, and are sorted like other texts if it isn't.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    keys = np.zeros(0, np.int64)
    if copies.limit(spec.known_copies + 1).count() <= spec.known_copies:
        table = copies.select("doc_id", "tag").toArrow()
        keys = np.sort(_row_key(table.column("doc_id").to_numpy(), table.column("tag").to_numpy()))
    later = spark.sparkContext.broadcast(keys)
    n_bytes = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    parts = max(1, -(-n_bytes // spec.part_bytes))
    bits = int(max(64, min(spec.part_bits, spec.table_bits // parts) // 8 * 8))
    blocks = docs.mapInArrow(_anchor_blocks(spec, parts, later), "part int, seen binary, several binary")
    tables = blocks.repartition(parts, "part").mapInArrow(_mark(bits), "part int, bits binary").toArrow()
    marks = np.zeros(parts * bits // 8, np.uint8)
    for part, table in zip(tables.column("part").to_pylist(), tables.column("bits").to_pylist(), strict=True):
        marks[part * bits // 8 : (part + 1) * bits // 8] = np.frombuffer(table, np.uint8)
    shared = spark.sparkContext.broadcast(marks)
    distinct = docs.mapInArrow(_surroundings(spec, parts, bits, shared, later, True), "anchor bigint, sid bigint, bytes binary, least bigint, most bigint")
    shards = max(1, -(-n_bytes // (4 * spec.shard_bytes)))
    dealt = distinct.repartition(shards, "anchor").sortWithinPartitions("anchor")
    runs = dealt.mapInArrow(_sort_shard(spec), "sid bigint, runs array<struct<from:int,to:int,first:bigint>>")
    runs = cut_lineage(runs)
    places = docs.mapInArrow(_surroundings(spec, parts, bits, shared, later, False), "sid bigint, doc_id bigint, tag bigint, at int")
    hits = places.join(runs, "sid").select("doc_id", "tag", "at", F.explode(F.filter("runs", lambda r: r["first"] < F.col("doc_id"))).alias("r"))
    return hits.select("doc_id", "tag", (F.col("at") + F.col("r.from")).alias("start"), (F.col("at") + F.col("r.to") + spec.length).alias("end"))


def remove_repeats(docs: DataFrame, spec: Repeats = Repeats()) -> DataFrame:
    """Each row with ``n_bytes, n_removed, n_spans, kept_sha256`` and ``kept_bytes``, its text without the repeats.

    A byte goes if a string of ``length`` bytes over it also starts in a text with a smaller ``doc_id``; all strings
    are judged on the input. A null or empty text has no bytes. Rows that share a ``doc_id`` don't remove from each
    other; a row without ``doc_id`` loses nothing and removes nothing. Other columns are ignored; an empty table
    gives no rows. What is left may end inside a character, so it is bytes.
    """
    docs = docs.select("doc_id", "text")
    known = docs.where("doc_id is not null and text is not null")
    copies = cut_lineage(later_copies(known))
    whole = copies.select("doc_id", "tag", F.lit(0).alias("start"), F.lit(-1).alias("end"))
    return cut_out(docs, repeated_spans(docs, copies, spec).union(whole), spec.length)
