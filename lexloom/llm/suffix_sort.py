"""External induced sorting of all suffixes of a shard, with common-prefix lengths.

Suffix tuples ``(position, common prefix with the tuple before)`` pass through a monotone priority queue whose
buckets live on disk beyond a memory limit. The queue is read in order; each tuple taken out induces the one
before its position. A whole prefix of the queue is taken at once as long as nothing it induces could come
earlier, so the work is done on arrays. The names of the substrings between S* positions form a shorter
sequence that is sorted by the same procedure. Text, types, positions and prefix lengths are files of the
task's scratch folder; memory holds blocks of ``BLOCK`` elements and the queue's current bucket.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np

from lexloom.llm.arrays import BASE, INVERSE, mix, powers, run_lengths

BLOCK = 1 << 15
#: Common prefixes are counted up to this length, if no other is given.
CAP = 64
NONE = np.iinfo(np.int64).max


class DiskQueue:
    """A monotone priority queue: keys never fall below what has been taken; equal keys leave in order of arrival."""

    def __init__(self, n_keys: int, n_items: int, folder: Path, limit: int) -> None:
        self.folder, self.limit = folder, limit
        folder.mkdir()
        self.width = 1 if n_keys <= 2048 else max(1, -(-n_keys // int(np.clip(1.5 * n_items**0.5, 256, 1 << 14))))
        n = -(-n_keys // self.width)
        self.buckets: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(n)]
        self.files: list[int] = [0] * n
        self.now, self.waiting = -1, 0
        self.current: tuple[np.ndarray, ...] = (np.zeros(0, np.int64),) * 3

    def push(self, keys: np.ndarray, positions: np.ndarray, lcps: np.ndarray) -> None:
        """Items sorted by key and, among equal keys, by arrival; none below the key that is being taken out."""
        if not len(keys):
            return
        first, length = run_lengths(keys // self.width if self.width > 1 else keys)
        for f, n in zip(first.tolist(), length.tolist(), strict=True):
            part = (keys[f : f + n], positions[f : f + n], lcps[f : f + n])
            b = int(keys[f]) // self.width
            if b != self.now:
                self.buckets[b].append(part)
                self.waiting += n
            elif self.width == 1:
                self.current = tuple(np.concatenate([a, x]) for a, x in zip(self.current, part, strict=True))
            else:
                place = np.searchsorted(self.current[0], part[0], "right")
                self.current = tuple(np.insert(a, place, x) for a, x in zip(self.current, part, strict=True))
        if self.waiting > self.limit:
            self._spill()

    def _spill(self) -> None:
        for b, parts in enumerate(self.buckets):
            if parts:
                np.savez(self.folder / f"{b}-{self.files[b]}", *(np.concatenate(column) for column in zip(*parts, strict=True)))
                self.files[b] += 1
                parts.clear()
        self.waiting = 0

    def head(self, most: int) -> tuple[np.ndarray, ...]:
        """The next items in order, ``most`` or fewer; empty at the end."""
        while not len(self.current[0]) and self.now + 1 < len(self.buckets):
            self.now += 1
            parts = self.buckets[self.now]
            self.waiting -= sum(len(p[0]) for p in parts)
            written = []
            for k in range(self.files[self.now]):
                path = self.folder / f"{self.now}-{k}.npz"
                with np.load(path) as stored:
                    written.append(tuple(stored[name] for name in stored.files))
                path.unlink()
            if parts := [*written, *parts]:
                whole = [np.concatenate(column) for column in zip(*parts, strict=True)]
                if self.width > 1:
                    order = np.argsort(whole[0], kind="stable")
                    whole = [column[order] for column in whole]
                self.current = tuple(whole)
            self.buckets[self.now] = []
        return tuple(a[:most] for a in self.current)

    def take(self, n: int) -> None:
        self.current = tuple(a[n:] for a in self.current)


def suffix_types(text: np.ndarray, out: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last position counts as such."""
    n = len(text)
    out[n - 1] = True
    later = True
    for hi in range(n - 1, 0, -BLOCK):
        lo = max(0, hi - BLOCK)
        a, b = np.asarray(text[lo:hi]), np.asarray(text[lo + 1 : hi + 1])
        known = a != b
        place = np.where(known, np.arange(hi - lo), hi - lo)
        place = np.minimum.accumulate(place[::-1])[::-1]
        value = np.append(a < b, later)
        block = value[place]
        out[lo:hi] = block
        later = bool(block[0])
    return out


def star_positions(is_s: np.ndarray) -> np.ndarray:
    """The S positions that follow an L position."""
    found = []
    for lo in range(1, len(is_s), BLOCK):
        hi = min(lo + BLOCK, len(is_s))
        found.append(lo + np.flatnonzero(is_s[lo:hi] & ~np.asarray(is_s[lo - 1 : hi - 1])))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int = CAP) -> np.ndarray:
    """Equal leading symbols of the suffixes at ``a`` and ``b``, counted up to ``cap``."""
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    n = len(text)
    for k in range(cap):
        x, y = a[open_] + k, b[open_] + k
        inside = np.maximum(x, y) < n
        open_, x, y = open_[inside], x[inside], y[inside]
        open_ = open_[text[x] == text[y]]
        if not len(open_):
            break
        out[open_] = k + 1
    return out


def _span_keys(text: np.ndarray, is_s: np.ndarray, starts: np.ndarray, ends: np.ndarray, folder: Path) -> np.ndarray:
    """A 64-bit key for the symbols and types of each span; running sums are a file, made block by block."""
    n = len(text)
    sums = np.asarray(np.memmap(folder / "sums", np.uint64, "w+", shape=(n + 1,)))
    step, total = powers(BLOCK), np.uint64(0)
    for lo in range(0, n, BLOCK):
        hi = min(lo + BLOCK, n)
        codes = mix(2 * text[lo:hi].astype(np.int64) + is_s[lo:hi]) * step[: hi - lo] * np.uint64(pow(BASE, lo, 1 << 64))
        sums[lo + 1 : hi + 1] = np.cumsum(codes, dtype=np.uint64) + total
        total = sums[hi]
    back, keys = powers(BLOCK, INVERSE), np.empty(len(starts), np.uint64)
    for lo in range(0, len(starts), BLOCK):
        a, b = starts[lo : lo + BLOCK], ends[lo : lo + BLOCK]
        far = np.array([pow(INVERSE, int(x) * BLOCK, 1 << 64) for x in range(int(a[0]) // BLOCK, int(a[-1]) // BLOCK + 1)], np.uint64)
        shift = far[a // BLOCK - a[0] // BLOCK] * back[a % BLOCK]
        keys[lo : lo + BLOCK] = mix((sums[b] - sums[a]) * shift + (b - a).astype(np.uint64))
    (folder / "sums").unlink()
    return keys


def _names(text: np.ndarray, is_s: np.ndarray, stars: np.ndarray, folder: Path) -> tuple[np.ndarray, int]:
    """The rank of every substring from one S* position to the next, both included."""
    ends = np.append(stars[1:] + 1, len(text))
    _, first, inverse = np.unique(_span_keys(text, is_s, stars, ends, folder), return_index=True, return_inverse=True)
    spelled = []
    for a, b in zip(stars[first].tolist(), ends[first].tolist(), strict=True):
        spelled.append((2 * text[a:b].astype(np.int64) + is_s[a:b]).astype(">u4").tobytes())
    rank = np.empty(len(spelled), np.int32)
    rank[sorted(range(len(spelled)), key=spelled.__getitem__)] = np.arange(len(spelled), dtype=np.int32)
    return rank[inverse], len(spelled)


def order_in_memory(names: np.ndarray) -> np.ndarray:
    """All suffixes of a short sequence in order, by doubling; those with a rank of their own drop out."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    first, length = run_lengths(names[order])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, length)
    slots = np.flatnonzero(np.repeat(length > 1, length))
    k = 1
    while len(slots):
        open_ = order[slots]
        # a suffix that shares its first k names with another one ends later than they do
        keys = rank[open_] * n + rank[open_ + k]
        by = np.argsort(keys, kind="stable")
        open_, keys = open_[by], keys[by]
        order[slots] = open_
        first, length = run_lengths(keys)
        rank[open_] = np.repeat(slots[first], length)
        slots = slots[np.repeat(length > 1, length)]
        k *= 2
    return order


def _count_kind(cap: int) -> type:
    return np.int16 if cap < 1 << 15 else np.int32


class _Induced:
    """One pass over the queue: takes suffixes in order and hands on those of one type that they induce."""

    def __init__(self, text, is_s, n_symbols: int, down: bool, folder: Path, limit: int, lcp: bool, cap: int) -> None:
        self.text, self.is_s, self.down, self.lcp, self.cap, self.count = text, is_s, down, lcp, cap, _count_kind(cap)
        self.n_keys = 2 * n_symbols
        self.kind = np.uint16 if self.n_keys < 1 << 16 else np.int64
        self.queue = DiskQueue(self.n_keys, len(text), folder, limit)
        # the least common prefix since the last item of each key; -1 while there is none
        self.least = np.full(self.n_keys if lcp else 0, -1, self.count)
        self.last = -1

    def key(self, symbol: np.ndarray, is_s) -> np.ndarray:
        key = 2 * symbol.astype(np.int64) + is_s
        return (self.n_keys - 1 - key if self.down else key).astype(self.kind)

    def seed(self, positions: np.ndarray, lcps: np.ndarray) -> None:
        """Positions in the order of the pass."""
        keys = self.key(self.text[positions], self.is_s[positions])
        self.queue.push(keys, positions, lcps.astype(self.count))

    def run(self):
        most = BLOCK
        while True:
            keys, positions, lcps = self.queue.head(most)
            if not len(keys):
                return
            n = len(keys)
            before = positions - 1
            before[positions == 0] = 0
            source = np.flatnonzero((self.is_s[before] == self.down) & (positions > 0))
            target = self.key(self.text[before[source]], self.down)
            if self.queue.width > 1 and len(source):
                # an item may leave while nothing that those ahead of it induce belongs before it
                low = np.full(n, NONE)
                low[source] = target
                late = np.flatnonzero(keys[1:] > np.minimum.accumulate(low)[:-1])
                n = int(late[0]) + 1 if len(late) else n
                most = min(max(256, 2 * n), BLOCK)
                part = np.searchsorted(source, n)
                source, target = source[:part], target[:part]
            positions, lcps = positions[:n], lcps[:n]
            if self.lcp:
                lcps = self._seams(keys[:n], positions, lcps)
            self.queue.take(n)
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            common = self._common(source, target, lcps) if self.lcp else np.zeros(len(source), self.count)
            self.queue.push(target, before[source], common)
            yield positions, lcps

    def _seams(self, keys: np.ndarray, positions: np.ndarray, lcps: np.ndarray) -> np.ndarray:
        """Where one symbol's two types meet, the common prefix is measured on the text."""
        lcps = lcps.copy()
        plain = self.n_keys - 1 - keys.astype(np.int64) if self.down else keys.astype(np.int64)
        meets = np.flatnonzero((plain[1:] != plain[:-1]) & (plain[1:] >> 1 == plain[:-1] >> 1)) + 1
        if len(meets):
            lcps[meets] = common_prefix(self.text, positions[meets - 1], positions[meets], self.cap)
        if self.last >= 0 and self.text[self.last] == plain[0] >> 1 and self.is_s[self.last] != plain[0] & 1:
            lcps[0] = common_prefix(self.text, np.array([self.last]), positions[:1], self.cap)[0]
        self.last = int(positions[-1])
        return lcps

    def _common(self, source: np.ndarray, target: np.ndarray, lcps: np.ndarray) -> np.ndarray:
        """One more than the least common prefix between each source and the one before it with the same target."""
        lowest = lcps.min()
        if not len(source):
            np.minimum(self.least, lowest, out=self.least)
            return np.zeros(0, self.count)
        fresh = np.ones(len(target), dtype=bool)
        fresh[1:] = target[1:] != target[:-1]
        start = np.where(fresh, 0, np.append(0, source[:-1] + 1))
        cuts = np.stack([start, source + 1], axis=1).ravel()
        common = np.minimum.reduceat(np.append(lcps, self.cap).astype(self.count), cuts)[::2]
        common = np.where(fresh, np.minimum(common, self.least[target]), common)
        np.minimum(self.least, lowest, out=self.least)
        final = np.append(fresh[1:], True)
        # what has passed since the last item of each target
        rest = np.append(np.minimum.accumulate(lcps[::-1])[::-1], self.cap)
        self.least[target[final]] = rest[source[final] + 1]
        return np.minimum(common + 1, self.cap).astype(self.count)


def sorted_suffixes(text: np.ndarray, n_symbols: int, folder: Path, limit: int = 1 << 20, in_memory: int = 1 << 22, lcp: bool = True, cap: int = CAP):
    """Blocks of ``(positions, common prefix with the suffix before)`` from the largest suffix to the smallest.

    ``text`` holds symbols below ``n_symbols``; its last one is 0 and occurs nowhere else. That last suffix is
    not returned. ``limit`` is the number of tuples the queue keeps in memory; names up to
    ``in_memory`` are ordered there, more of them by this procedure. The recursion on names needs the
    order alone and runs without ``lcp``. Common prefixes are counted up to ``cap``.
    """
    folder = Path(folder)
    folder.mkdir(exist_ok=True)
    if len(text) < 2:
        return
    text = np.asarray(text)
    is_s = np.asarray(suffix_types(text, np.memmap(folder / "types", bool, "w+", shape=(len(text),))))
    stars = star_positions(is_s)
    names, n_names = _names(text, is_s, stars, folder)
    if n_names == len(names):
        order = np.argsort(names)
    elif len(names) <= in_memory:
        order = order_in_memory(names)
    else:
        down = [p for p, _ in sorted_suffixes(names, n_names, folder / "names", limit, in_memory, False)]
        order = np.concatenate([*down, [len(names) - 1]])[::-1]
    seeds = stars[order]
    up = _Induced(text, is_s, n_symbols, False, folder / "up", limit, lcp, cap)
    for lo in range(0, len(seeds), BLOCK):
        part = seeds[lo : lo + BLOCK]
        prior = seeds[max(0, lo - 1) : lo + len(part) - 1]
        common = common_prefix(text, prior, part[len(part) - len(prior) :], cap) if lcp else np.zeros(len(prior), np.int64)
        up.seed(part, np.append(np.zeros(len(part) - len(prior), np.int64), common))
    entry = np.dtype([("at", np.int32 if len(text) < 1 << 31 else np.int64), ("lcp", _count_kind(cap))])
    with (folder / "larger").open("wb") as out:
        for positions, lcps in up.run():
            kept = ~is_s[positions]
            found = np.empty(int(kept.sum()), entry)
            found["at"], found["lcp"] = positions[kept], lcps[kept]
            found.tofile(out)
    size = (folder / "larger").stat().st_size // entry.itemsize
    down = _Induced(text, is_s, n_symbols, True, folder / "down", limit, lcp, cap)
    if size:
        larger = np.memmap(folder / "larger", entry, "r", shape=(size,))
        for hi in range(size, 0, -BLOCK):
            lo = max(0, hi - BLOCK)
            positions = larger["at"][lo:hi].astype(np.int64)[::-1]
            lcps = np.append(larger["lcp"][hi] if hi < size else 0, larger["lcp"][lo + 1 : hi][::-1])
            down.seed(positions, lcps)
    yield from down.run()
