"""Periodic runs of words: minimizers at several scales seed them, direct lag scans find the short periods.

A run of period ``q`` has the same minimum in windows that lie ``q`` apart. At the scale of ``w`` words, for periods
``w <= q < 2 w``, the minimum of every window of ``w`` places is taken over hashes of ``2 w`` words: so many words tell
all places within a period apart, so equal neighbouring minima of a run are exactly one period apart. Runs of four
periods and more are long enough for two such windows and their words, so each of them is seeded. Seeds are extended
on the words themselves; hashes never decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexloom.llm.arrays import IS_SPACE, as_binary, combine, mix, pieces, utf8, word_spans
from lexloom.session import ship_package

NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class RunRule:
    """A run has at least ``least_words`` words and ``exponent`` periods; periods below ``scan`` are scanned lag by lag."""

    least_words: int = 6
    exponent: int = 4
    scan: int = 8

    def __post_init__(self) -> None:
        if self.exponent < 4 or self.scan < 1 or self.scan & (self.scan - 1):
            raise ValueError("minimizers need runs of four periods, and scales that are powers of two")


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for every word, equal for equal bytes and for no others."""
    at = np.concatenate([[0], np.cumsum(ends - starts)])
    return as_binary(data[~IS_SPACE[data]], at).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _over_windows(values: np.ndarray, width: int, take: np.ufunc, ahead: bool) -> np.ndarray:
    """``take`` over the ``width`` places from (or up to) each place; ``width`` is a power of two."""
    out, step = values.copy(), 1
    while step < width:
        if ahead:
            out[:-step] = take(out[:-step], out[step:])
        else:
            out[step:] = take(out[step:], out[:-step])
        step *= 2
    return out


def lag_stretches(names: np.ndarray, row: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal stretch of at least ``least`` words that stand again ``lag`` words on."""
    if len(names) <= lag:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(names) - lag + 2, dtype=np.int8)
    same[1:-1] = (names[lag:] == names[:-lag]) & (row[lag:] == row[:-lag])
    edge = np.diff(same)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= least
    return start[long], end[long]


def scale_seeds(names: np.ndarray, at: np.ndarray, rule: RunRule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place and distance of equal neighbouring window minima, scale by scale; ``at`` are the texts' word offsets."""
    size = np.diff(at)
    place = np.arange(len(names))
    left = np.repeat(at[1:], size) - place
    row = np.repeat(np.arange(len(size)), size)
    hashes, width, scale = mix(names), 1, rule.scan
    while len(place):
        # hashes of 2 * scale words, by doubling; those that pass their text's end are never a minimum
        while width < 2 * scale:
            ahead = np.zeros_like(hashes)
            ahead[:-width] = hashes[width:]
            hashes, width = combine(hashes, ahead), 2 * width
        inside = left >= width
        keyed = np.where(inside, hashes, NEVER)
        least = _over_windows(keyed, scale, np.minimum, ahead=True)
        chosen = np.flatnonzero(inside & (keyed == _over_windows(least, scale, np.maximum, ahead=False)))
        order = chosen[np.argsort(keyed[chosen], kind="stable")]
        one, two = order[:-1], order[1:]
        apart = place[two] - place[one]
        near = (keyed[one] == keyed[two]) & (row[one] == row[two]) & (apart >= scale) & (apart < 2 * scale)
        yield place[one[near]], apart[near]
        scale *= 2
        # the next scale's periods need four times as many words
        long = size[row] >= rule.exponent * scale
        hashes, place, left, row = hashes[long], place[long], left[long], row[long]


def _extend(names: np.ndarray, place: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The maximal stretch around ``place`` whose words stand again ``lag`` on, inside ``[low, high - lag)``."""
    end, step = place, 64
    while end < high - lag:
        stop = min(end + step, high - lag)
        other = np.flatnonzero(names[end:stop] != names[end + lag : stop + lag])
        if len(other):
            end += int(other[0])
            break
        end, step = stop, 2 * step
    start, step = place, 64
    while start > low:
        stop = max(start - step, low)
        other = np.flatnonzero(names[stop:start] != names[stop + lag : start + lag])
        if len(other):
            start = stop + int(other[-1]) + 1
            break
        start, step = stop, 2 * step
    return start, end


def find_runs(names: np.ndarray, at: np.ndarray, rule: RunRule = RunRule()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run, by start and period; ``at`` are the texts' word offsets."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    starts, ends, periods = [], [], []

    def found(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        long = end - start >= np.maximum(rule.least_words, rule.exponent * period)
        starts.append(start[long])
        ends.append(end[long])
        periods.append(period[long])

    for lag in range(1, rule.scan):
        start, end = lag_stretches(names, row, lag, (rule.exponent - 1) * lag)
        found(start, end + lag, np.full(len(start), lag))
    for place, apart in scale_seeds(names, at, rule):
        order = np.lexsort((place, apart))
        last, done, spans = 0, 0, []
        for p, lag in zip(place[order].tolist(), apart[order].tolist(), strict=True):
            if lag == last and p < done:
                continue  # inside the stretch that was extended last
            start, done = _extend(names, p, lag, int(at[row[p]]), int(at[row[p] + 1]))
            last = lag
            spans.append((start, done + lag, lag))
        if spans:
            found(*np.array(spans, dtype=np.int64).T)
    start, end, period = (np.concatenate(x).astype(np.int64) for x in (starts, ends, periods))
    # a multiple of the smallest period has the very same stretch
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def joined_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> pa.Array:
    """The words of each text, joined by one blank; ``at`` are word offsets into ``start`` and ``end``."""
    size = end - start + 1
    to = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(to[-1]) - np.repeat(to[:-1] - start, size)
    index[to[1:] - 1] = 0
    out = data[index] if len(data) else np.zeros(0, np.uint8)
    out[to[1:] - 1] = 0x20
    # no blank after the last word of a text
    some = at[1:] > at[:-1]
    keep = np.ones(len(out), dtype=bool)
    keep[to[at[1:][some]] - 1] = False
    return as_binary(out[keep], to[at] - np.concatenate([[0], np.cumsum(some)]), pa.string())


RUNS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _finder(rule: RunRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            data, text_at = utf8(piece.column("text"))
            w_start, w_end, w_row = word_spans(data, text_at)
            at = np.searchsorted(w_row, np.arange(piece.num_rows + 1))
            start, length, period = find_runs(word_names(data, w_start, w_end), at, rule)
            row = w_row[start]
            # a word goes if it lies in a run behind that run's first period
            change = np.bincount(start + period, minlength=len(w_start) + 1) - np.bincount(start + length, minlength=len(w_start) + 1)
            kept = np.cumsum(change)[: len(w_start)] == 0
            kept_at = np.concatenate([[0], np.cumsum(kept)])[at]
            struct = pa.StructArray.from_arrays([pa.array(start - at[row]), pa.array(length), pa.array(period)], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(piece.num_rows + 1)).astype(np.int32)), struct)
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(np.diff(at).astype(np.int64)), lists, joined_words(data, w_start[kept], w_end[kept], kept_at)],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(docs: DataFrame, rule: RunRule = RunRule()) -> DataFrame:
    """Each row of ``docs`` (``doc_id, text``) with ``n_words``, its ``runs`` and its ``collapsed`` text.

    A run is a stretch of consecutive words with smallest period ``period`` that no neighbouring word extends, of at
    least four periods and six words (see :class:`RunRule`). ``runs`` are ordered by start and period; ``collapsed``
    are the words, joined by one blank, that lie in no run behind that run's first period.

    Texts are worked on whole and row by row, so nothing is shuffled. A null or empty text has no words, no runs and
    an empty collapsed text; a null ``doc_id`` and repeated rows pass through. Other columns are ignored; an empty
    table gives no rows.
    """
    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_finder(rule), RUNS)
