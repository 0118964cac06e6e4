"""Mixing sources to target weights: budgets by water level, filled by subset sums over exact document lengths.

Each source's documents are counted by their exact length. A source's budget is met by whole rounds of the source,
an even share of every length, and a bounded-knapsack table for what is left; the documents of each length
that the plan asks for are the first ones in a seeded order. Only counts by length meet in one task of a
source; documents are ranked inside hash buckets of their length, so a length that a third of all documents has
is spread out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexloom.llm.arrays import pieces, utf8, word_spans
from lexloom.llm.spans import digests_of, tags_of
from lexloom.session import cut_lineage

SOURCE = ["no_source", "name"]


@dataclass(frozen=True)
class Mix:
    """Weights by source in turn, most copies of a document, seed, words of the knapsack table, and buckets of a length."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    copies: int = 3
    seed: int = 17
    table: int = 1 << 16
    buckets: int = 4096


def _sizer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        data, at = utf8(piece.column("text"))
        _, _, row = word_spans(data, at)
        size = np.bincount(row, minlength=piece.num_rows)
        yield pa.record_batch([piece.column("doc_id"), piece.column("source"), pa.array(size, pa.int64()), pa.array(tags_of(digests_of(data, at)))], names=["doc_id", "source", "size", "tag"])


def document_sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, no_source, name, size, tag)``: words of every text (null: none)."""
    sized = docs.select("doc_id", "source", "text").mapInArrow(_sizer, "doc_id bigint, source string, size bigint, tag bigint")
    return sized.select("doc_id", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name"), "size", "tag")


def numbered(frame: DataFrame, *keys: str) -> DataFrame:
    """The rows with ``number`` from 0 in the order of the keys, from numbers inside range partitions."""
    placed = cut_lineage(frame.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, offsets = 0, []
    for row in sizes:
        offsets.append((row["part"], before))
        before += row["n"]
    if not offsets:
        return placed.withColumn("number", F.lit(0).cast("bigint")).drop("place")
    known = frame.sparkSession.createDataFrame(offsets, "part bigint, before bigint")
    return placed.withColumn("part", part).join(F.broadcast(known), "part").select(*frame.columns, (F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("number"))


def source_targets(sized: DataFrame, spec: Mix) -> DataFrame:
    """``(no_source, name, source_size, target)``: shares of all words by weight, at most ``copies`` times the source.

    Sources take the weights in turn, in order of their code points, null last. What the bound holds back goes
    to the others by weight, until none is above.
    """
    totals = sized.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in spec.weights)), (F.col("number") % len(spec.weights) + 1).cast("int"))
    sources = cut_lineage(numbered(totals, *SOURCE).withColumn("weight", weight).withColumn("most", spec.copies * F.col("source_size")))
    level, known = 0.0, -1
    while True:
        full = F.col("most") <= level * F.col("weight")
        held, free, total, n = sources.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0)), F.sum("source_size"), F.sum(full.cast("long"))
        ).first()
        if n is None or n == known or not free:
            break
        level, known = (total - held) / free, n
    target = F.least(F.col("most").cast("double"), level * F.col("weight"))
    return sources.select(*SOURCE, "source_size", target.alias("target"))


def fill_budget(sizes: np.ndarray, counts: np.ndarray, budget: float, spec: Mix, seed: int) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to the budget.

    An even share of every length, then one more of lengths in a seeded order, leave less than a table's width;
    that is met by subset sums over what there is left of every length.
    """
    take = np.zeros(len(sizes), np.int64)
    use = np.flatnonzero(sizes > 0)
    total = float((sizes[use] * counts[use]).sum())
    if budget <= 0 or not total:
        return take
    take[use] = np.minimum(counts[use], np.floor(min(1.0, budget / total) * counts[use]).astype(np.int64))
    order = np.random.Generator(np.random.PCG64(seed)).permutation(use)
    order = order[take[order] < counts[order]]
    rest = budget - float((sizes * take).sum())
    run = np.cumsum(sizes[order])
    more = order[run <= rest - spec.table]
    take[more] += 1
    rest -= float(sizes[more].sum())
    width = int(rest) + 1
    reached = np.zeros(width + 1, dtype=bool)
    reached[0] = True
    by = np.full(width + 1, -1, np.int64)
    steps: list[tuple[int, int]] = []
    for k in order.tolist():
        left, chunk = int(counts[k] - take[k]), 1
        while left > 0:
            n = min(chunk, left)
            words = n * int(sizes[k])
            if words <= width:
                fresh = np.flatnonzero(reached[: width + 1 - words] & ~reached[words:]) + words
                by[fresh] = len(steps)
                reached[fresh] = True
                steps.append((k, n))
            left, chunk = left - n, 2 * chunk
        if reached[int(round(rest))]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at:
        k, n = steps[by[at]]
        take[k] += n
        at -= n * int(sizes[k])
    return take


def _planner(spec: Mix):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        size = float(first["source_size"])
        rounds = min(int(first["target"] // size), spec.copies) if size else 0
        budget = first["target"] - rounds * size if rounds < spec.copies else 0.0
        rows = rows.sort_values("size")
        take = fill_budget(rows["size"].to_numpy(), rows["n"].to_numpy(), budget, spec, spec.seed)
        return rows[[*SOURCE, "size"]].assign(rounds=rounds, more=take)

    return run


def mix_sources(docs: DataFrame, spec: Mix = Mix()) -> DataFrame:
    """One row for each of ``docs`` (``doc_id, source, text``): size, its source's size and target, copies and words taken.

    A null or empty text has no words and is not taken; a null source is a source of its own, the last one. Repeated
    rows are documents of their own and rank next to each other; a row without ``doc_id`` ranks by its text. Other
    columns are ignored; an empty table gives no rows. The result depends on the rows and the seed alone.
    """
    sized = cut_lineage(document_sizes(docs))
    targets = cut_lineage(source_targets(sized, spec))
    counts = sized.groupBy(*SOURCE, "size").agg(F.count(F.lit(1)).alias("n"))
    kinds = "no_source boolean, name string, size bigint, rounds bigint, more bigint"
    plan = cut_lineage(counts.join(targets, SOURCE).groupBy(*SOURCE).applyInPandas(_planner(spec), kinds))
    luck = F.xxhash64("doc_id", "tag", F.lit(spec.seed))
    ranked = sized.withColumn("luck", luck).withColumn("bucket", F.pmod("luck", F.lit(spec.buckets)))
    group = [*SOURCE, "size"]
    filled = ranked.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy(*group).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    filled = filled.withColumn("before", F.coalesce(before, F.lit(0))).join(plan, group).select(*group, "bucket", "before", "rounds", "more")
    place = F.row_number().over(W.partitionBy(*group, "bucket").orderBy("luck", "doc_id", "tag"))
    chosen = ranked.join(filled, [*group, "bucket"]).withColumn("place", F.col("before") + place)
    copies = F.col("rounds") + (F.col("place") <= F.col("more")).cast("bigint")
    named = chosen.join(targets.hint("broadcast") if targets.limit(10_001).count() <= 10_000 else targets, SOURCE)
    return named.select(
        "doc_id", "tag", F.when(~F.col("no_source"), F.col("name")).alias("source"), "size", "source_size", "target",
        F.when(F.col("size") > 0, copies).otherwise(0).cast("bigint").alias("copies"), (F.col("size") * copies).alias("taken"),
    )
