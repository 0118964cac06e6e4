"""Prefix tries of turn sequences as burst tries: containers of suffixes under trie heads.

A sequence is the list of digests of its prefixes, 16 bytes a turn, so a prefix is one value and texts are never
shuffled. All sequences start in the container of the root. A container of too many suffixes bursts: its head becomes a
trie node and its suffixes move to containers by their next turn. What is left are containers of a bounded size, each
sorted and swept into nodes by one task; the heads, few by construction, add up what lies below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.operators.frames import salted_join
from lexloom.session import cut_lineage, ship_package

ROOT = b"\0" * 16
SALTS = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Burst:
    """Containers hold at most ``most`` sequences; a round bursts up to ``levels`` turns deep.

    ``sent`` heads may go to every task after they were counted. ``piece`` ids are joined at a time for the digest of
    the sequences that end in a node.
    """

    most: int = 1024
    levels: int = 4
    sent: int = 100_000
    piece: int = 1 << 16


def turn_digest(*parts: str) -> Column:
    """A 128-bit digest of a turn; a null part counts as empty."""
    coalesced = [F.coalesce(F.col(p), F.lit("")) for p in parts]
    sized = [c for p in coalesced[:-1] for c in (F.octet_length(p).cast("string"), F.lit(":"), p)]
    return F.unhex(F.md5(F.concat(*sized, coalesced[-1]).cast("binary")))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of sorted batches; a group may reach over batches."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


PREFIXES = "id bigint, path array<binary>, sizes array<bigint>"
_PREFIXES = pa.schema([("id", pa.int64()), ("path", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64()))])
_PIECES = pa.schema([("end", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
_ENDS = pa.schema([("end", pa.binary()), ("ends_sha256", pa.string())])


def _chain(turns: list[tuple[bytes, int]]) -> tuple[list[bytes], list[int]]:
    """The digest of every prefix that has a turn, and the bytes of every turn."""
    path, above = [], ROOT
    for digest, _ in turns:
        above = hashlib.blake2b(above + digest, digest_size=16).digest()
        path.append(above)
    return path, [size for _, size in turns]


def _batches(rows: Iterator[tuple], schema: pa.Schema, weigh, weight: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows, about ``weight`` each."""
    held, total = [], 0

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        total += weigh(row)
        if total >= weight:
            yield batch()
            held.clear()
            total = 0
    if held:
        yield batch()


def _joined(piece: int):
    """Ascending ids of each end as text, in pieces; a piece never reaches over a task."""

    def texts(rows: Iterator[tuple]) -> Iterator[tuple[bytes, int, str]]:
        at, ids = None, []
        for end, name in rows:
            if ids and (end != at or len(ids) >= piece):
                yield at, ids[0], ",".join(map(str, ids))
                ids = []
            at = end
            ids.append(name)
        if ids:
            yield at, ids[0], ",".join(map(str, ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(texts(_rows(batches)), _PIECES, lambda row: 32 + len(row[2]))

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each end's pieces in order, read as a stream."""

    def digests(rows: Iterator[tuple]) -> Iterator[tuple[bytes, str]]:
        at, sha = None, None
        for end, _, ids in rows:
            if end == at:
                sha.update(b",")
            else:
                if sha is not None:
                    yield at, sha.hexdigest()
                at, sha = end, hashlib.sha256()
            sha.update(ids.encode())
        if sha is not None:
            yield at, sha.hexdigest()

    yield from _batches(digests(_rows(batches)), _ENDS, lambda row: 100)


def ends_digest(ends: DataFrame, piece: int) -> DataFrame:
    """``(end, ends_sha256)`` of rows ``(end, id)``: the SHA-256 of each end's ids, ascending and comma-joined.

    Rows are sorted over all tasks by end and id, so an end that a third of all ids share lies in many of them; each
    joins its share and only those texts meet, a stream that is hashed piece by piece.
    """
    ordered = ends.repartitionByRange("end", "id").sortWithinPartitions("end", "id")
    pieces = ordered.select("end", "id").mapInArrow(_joined(piece), "end binary, first bigint, ids string")
    return pieces.repartition("end").sortWithinPartitions("end", "first").mapInArrow(_hashed, "end binary, ends_sha256 string")


def distinct_sequences(prefixes: DataFrame, rule: Burst) -> DataFrame:
    """``(end, copies, low, path, sizes, ends_sha256, n_turns)`` of every distinct sequence, written; copies meet per task first.

    All begin in the root's container: ``depth`` 0, no ``parent``.
    """
    end = F.when(F.size("path") > 0, F.element_at("path", -1)).otherwise(F.lit(ROOT))
    named = prefixes.withColumn("end", end)
    one = named.groupBy("end").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("low"), F.first("path").alias("path"), F.first("sizes").alias("sizes"))
    whole = one.join(ends_digest(named.select("end", "id"), rule.piece), "end").withColumn("n_turns", F.size("path"))
    return cut_lineage(whole.withColumn("depth", F.lit(0)).withColumn("parent", F.lit(None).cast("bigint")))


def _prefix(level: Column) -> Column:
    """The digest of the prefix of ``level`` turns; null beyond the last turn."""
    return F.when(level == 0, F.lit(ROOT)).when(level <= F.col("n_turns"), F.get("path", level - 1))


HEADS = "node binary, depth int, n_convs bigint, low bigint, bytes bigint, above array<binary>"


def burst(sequences: DataFrame, rule: Burst = Burst()) -> tuple[DataFrame, DataFrame]:
    """The heads, and all sequences with the ``depth`` of their container and its parent's smallest member ``parent``.

    Each round counts the suffixes of the prefixes that the next ``levels`` turns make, for the sequences whose
    containers are still open; those of more than ``most`` become heads. A sequence that ends in a head has a ``depth``
    beyond its last turn and no container.
    """
    spark = sequences.sparkSession
    waiting, heads, placed, start = sequences, [], [], 0
    while True:
        level = F.explode(F.sequence(F.lit(start), F.least(F.lit(start + rule.levels - 1), F.col("n_turns")))).alias("at")
        size = F.coalesce(F.get("sizes", F.col("at") - 1), F.lit(0))
        at_levels = waiting.select("path", "sizes", "n_turns", "copies", "low", level)
        counted = (
            at_levels.select(_prefix(F.col("at")).alias("node"), F.col("at").alias("depth"), "copies", "low", size.alias("bytes"))
            .groupBy("node", "depth")
            .agg(F.count(F.lit(1)).alias("suffixes"), F.sum("copies").alias("n_convs"), F.min("low").alias("low"), F.max("bytes").alias("bytes"))
        )
        large = cut_lineage(counted.where(F.col("suffixes") > rule.most))
        n_large = large.limit(rule.sent + 1).count()
        if not n_large:
            placed.append(waiting)
            break
        few = n_large <= rule.sent
        # the prefixes of a head are those of the sequence that has its smallest member
        firsts = waiting.select("low", "path").join(F.broadcast(large) if few else large, "low")
        above = F.concat(F.array(F.lit(ROOT)), F.slice("path", F.lit(1), F.col("depth")))
        heads.append(firsts.select("node", "depth", "n_convs", "low", "bytes", above.alias("above")))
        # heads are closed under prefixes, so a sequence goes on as far as each of its prefixes is one
        known = large.select("node", F.col("low").alias("head_low"))
        for step in range(rule.levels):
            at = F.when(F.col("depth") == start + step, _prefix(F.col("depth")))
            asked = waiting.withColumn("node", at)
            met = asked.join(F.broadcast(known), "node", "left") if few else salted_join(asked, known, "node", "end", "left", SALTS)
            waiting = met.withColumns({
                "parent": F.coalesce("head_low", "parent"),
                "depth": F.when(F.col("head_low").isNotNull(), F.col("depth") + 1).otherwise(F.col("depth")),
            }).drop("node", "head_low")
        start += rule.levels
        written = cut_lineage(waiting.withColumn("open", (F.col("depth") == start) & (F.col("n_turns") >= start)))
        placed.append(written.where("not open").drop("open"))
        waiting = written.where("open").drop("open")
    none = spark.createDataFrame([], HEADS)
    all_heads = none if not heads else heads[0]
    for more in heads[1:]:
        all_heads = all_heads.union(more)
    sequences = placed[0]
    for more in placed[1:]:
        sequences = sequences.union(more)
    return cut_lineage(all_heads), sequences


NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)
_NODES = pa.schema([(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in (x.split()[0] for x in NODES.split(", "))] + [("head", pa.binary())])


def _fold(container: list[tuple], depth: int, parent: int | None) -> list[list]:
    """Nodes of one container from its sorted sequences, the top one first, its subtree summed."""
    nodes: list[list] = []  # conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends, bytes, index of parent
    stack: list[int] = []
    before: list[bytes] = []
    for path, sizes, copies, low, ends in container:
        shared = max(depth - 1, 0)
        while shared < min(len(path), len(before)) and path[shared] == before[shared]:
            shared += 1
        del stack[max(0, shared - depth + 1) :]
        for d in range(depth + len(stack), len(path) + 1):
            nodes.append([low, d, None, 0, 0, 0, 0, NO_ENDS, sizes[d - 1] if d else 0, stack[-1] if stack else -1])
            stack.append(len(nodes) - 1)
        for k in stack:
            nodes[k][3] += copies
            nodes[k][0] = min(nodes[k][0], low)
        nodes[stack[-1]][7] = ends
        before = path
    # parents stand before their children, so sums go up from the last node
    for node in reversed(nodes):
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * node[8]
        up = node[9]
        if up >= 0:
            above = nodes[up]
            above[4] += 1
            above[5] += node[5]
            above[6] += node[6]
    for node in nodes:
        node[2] = nodes[node[9]][0] if node[9] >= 0 else parent
    return nodes


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences sorted by path: the containers follow each other and are folded one by one."""

    def folded(rows: Iterator[tuple]) -> Iterator[tuple]:
        for top, group in groupby(rows, key=lambda row: row[:4]):
            _, depth, parent, head = top
            for k, node in enumerate(_fold([row[4:] for row in group], depth, parent)):
                yield (*node[:8], None if k else head)

    yield from _batches(folded(_rows(batches)), _NODES, lambda row: 150)


def _head_nodes(heads: DataFrame, tops: DataFrame, ended: DataFrame) -> DataFrame:
    """Nodes of the heads: what containers and heads below add up to; ``tops`` are the containers' first nodes."""
    below = tops.groupBy(F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("containers"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    own = F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")
    known = heads.join(below, "node", "left").na.fill(0, ["containers", "leaves", "saved"]).join(ended, "node", "left")
    known = cut_lineage(known.withColumn("saved", own))
    summed = known.select(F.explode("above").alias("node"), "leaves", "saved").groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parent = F.when(F.col("depth") > 0, F.get("above", F.col("depth") - 1))
    children = known.select(parent.alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("heads"))
    lows = known.select(F.col("node").alias("up"), F.col("low").alias("parent_conv_id"))
    return (
        known.drop("saved", "leaves").withColumn("up", parent).join(summed, "node").join(children, "node", "left").join(lows, "up", "left")
        .select(
            F.col("low").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs",
            (F.col("containers") + F.coalesce("heads", F.lit(0))).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


def prefix_trie(prefixes: DataFrame, rule: Burst = Burst()) -> DataFrame:
    """The nodes of the trie of all sequences ``(id, path, sizes)``: one row for each distinct prefix, the empty one included.

    ``path`` are digests of the prefixes with one turn and more, ``sizes`` the bytes that each turn's text has; ids are
    unique. Columns: ``conv_id`` (the smallest id that starts so), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (bytes that all but one of the sequences share, summed
    over the subtree) and ``ends_sha256`` (of the ids that end here, ascending and comma-joined).

    Copies of a sequence are one suffix, so a container bursts by its distinct ones, and no group of equal sequences is
    gathered. A sequence without turns ends in the root; an empty table has no nodes.
    """
    ship_package(prefixes.sparkSession)
    sequences = distinct_sequences(cut_lineage(prefixes.select("id", "path", "sizes")), rule)
    heads, placed = burst(sequences, rule)
    held = placed.where("depth <= n_turns").select(
        _prefix(F.col("depth")).alias("container"), "depth", "parent",
        F.when(F.col("depth") > 0, _prefix(F.col("depth") - 1)).alias("head"), "path", "sizes", "copies", "low", "ends_sha256",
    )
    swept = held.repartition("container").sortWithinPartitions("path").mapInArrow(_sweep, f"{NODES}, head binary")
    swept = cut_lineage(swept)
    ended = placed.where("depth > n_turns").select(F.col("end").alias("node"), "ends_sha256")
    return swept.drop("head").union(_head_nodes(heads, swept.where("head is not null"), ended))


def _rebuilt(keep: int):
    """Conversations of five neighbouring ids, the base's first: each starts with the base's turns, then its own."""

    def conversations(rows: Iterator[tuple]) -> Iterator[tuple[int, list[tuple[bytes, int]]]]:
        base, base_turns, at, lead, own, seen = None, [], None, 0, [], 0
        for group, name, lead_of, later, _, digest, size in rows:
            if name != at:
                if at is not None:
                    yield at, own
                if group != base:
                    base, base_turns = group, []
                at, lead, seen = name, lead_of, 0
                own = list(base_turns[:lead]) if later else []
            if not later:
                own.append((digest, size))
                if seen < keep:
                    base_turns.append((digest, size))
            elif seen >= lead:
                own.append((digest, size))
            seen += 1
        if at is not None:
            yield at, own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chained = ((name, *_chain(turns)) for name, turns in conversations(_rows(batches)))
        yield from _batches(chained, _PREFIXES, lambda row: 40 + 24 * len(row[1]))

    return run


def rebuilt_conversations(turns: DataFrame, base: Column, lead: Column, keep: int) -> DataFrame:
    """``(id, path, sizes)`` of every conversation in ``turns`` (``conv_id, turn, role, text``), rebuilt.

    Each starts with the first ``lead`` turns (at most ``keep``) of conversation ``base``, then has its own turns
    after its first ``lead``; ``base`` and ``lead`` are columns over ``conv_id``. Turns are ordered by ``turn``, null
    first, equal ones by the digest of role and text; a null role or text counts as empty; rows without ``conv_id``
    belong to no conversation; other columns are ignored. One shuffle of turn digests by base: a conversation is one
    row of 24 bytes a turn, its base's first turns are all that is kept beside it.
    """
    ship_package(turns.sparkSession)
    known = turns.where("conv_id is not null").select(
        base.alias("base"), F.col("conv_id").alias("id"), lead.cast("int").alias("lead"), (base != F.col("conv_id")).alias("later"), "turn",
        turn_digest("role", "text").alias("digest"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"),
    )
    # null sorts first
    return known.repartition("base").sortWithinPartitions("base", "later", "id", "turn", "digest").mapInArrow(_rebuilt(keep), PREFIXES)
