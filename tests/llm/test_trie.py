from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lexloom.llm.plans import QUERIES, checksum
from lexloom.llm.trie import Burst, burst, distinct_sequences, prefix_trie, rebuilt_conversations
from lexloom.session import cut_lineage

TALKS = "conv_id bigint, turn bigint, role string, text string"
FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    talks: dict[int, list] = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            talks.setdefault(conv, []).append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[3] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in talks.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def plain_nodes(sequences: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """Every prefix as a key, every node against every other."""
    members: dict[tuple, list[int]] = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children: dict[tuple, list[tuple]] = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, ids in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = sorted(c for c in ids if len(sequences[c]) == len(p))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        out.append((
            min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children.get(p, [])),
            sum(q not in children for q in below), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rebuilt(talks):
    return rebuilt_conversations(talks, F.expr("conv_id - conv_id % 5"), checksum("conv_id") % 9, keep=8)


def rows_of(nodes) -> list[tuple]:
    return sorted((tuple(r[c] for c in FIELDS) for r in nodes.collect()), key=repr)


@pytest.fixture(scope="module")
def talks() -> list[tuple]:
    """Conversations with shared openings, a third of them copies of one, some missing, null and tied turns."""
    rng = random.Random(3)
    out = []
    for c in range(150):
        if c % 11 == 10:
            continue
        n = rng.randrange(1, 14)
        for t in range(n):
            copied = c % 3 == 0
            text = f"shared {t}" if copied or t < rng.randrange(4) else rng.choice(["ä", "b", f"own {c}", None, ""])
            out.append((c, None if rng.random() < 0.05 else t + rng.randrange(2), rng.choice(["user", "bot", None]) if not copied else "user", text))
    return out + [(None, 1, "user", "no conversation"), (7, 3, "user", "tie"), (7, 3, "user", "tie"), (7, 3, "bot", "tie")]


@pytest.mark.parametrize("rule", [Burst(), Burst(most=3), Burst(most=1, levels=1), Burst(most=2, levels=2, sent=0), Burst(most=10, piece=2)])
def test_nodes_are_those_of_all_prefixes(spark, talks, rule):
    nodes = prefix_trie(rebuilt(spark.createDataFrame(talks, TALKS)), rule)
    assert rows_of(nodes) == plain_nodes(plain_rebuilt(talks))


def test_containers_are_bounded_and_hold_every_sequence(spark, talks):
    sequences = distinct_sequences(cut_lineage(rebuilt(spark.createDataFrame(talks, TALKS))), Burst())
    heads, placed = burst(sequences, Burst(most=4))
    assert heads.count() > 3 and placed.count() == sequences.count()
    held = placed.where("depth <= n_turns").withColumn("container", F.expr("if(depth = 0, null, path[depth - 1])"))
    assert held.groupBy("container").count().agg(F.max("count")).first()[0] <= 4


def test_edges(spark):
    nothing = spark.createDataFrame([], TALKS)
    assert prefix_trie(rebuilt(nothing)).count() == 0
    # no turn at all is left of a conversation whose base is missing
    alone = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    clash = spark.createDataFrame([(alone, 0, "user", "gone", 5, "x")], TALKS + ", depth int, path string")
    assert rows_of(prefix_trie(rebuilt(clash))) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
    long = [(5, t, "user", "x" * 2_000 if t % 50 == 0 else str(t)) for t in range(3_000)] + [(6, t, "user", str(t)) for t in range(20)]
    got = prefix_trie(rebuilt(spark.createDataFrame(long, TALKS)))
    assert got.agg(F.max("depth")).first()[0] == 3_000 and got.where("depth = 0").first()["n_convs"] == 2


def test_query_at_small_scale(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    assert rows_of(QUERIES["op12_trie"](spark, "/root/testdata/sf0.001")) == plain_nodes(plain_rebuilt([tuple(r) for r in given]))
