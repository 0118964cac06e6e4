"""Components of a similarity that is only known pair by pair, from buckets of candidates, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.components import connected_components
from lexloom.session import cut_lineage

def shared_buckets(seen: DataFrame, useful: Column | None = None) -> DataFrame:
    """The rows ``(bucket, node, ...)`` of buckets with two nodes or more, and ``useful`` (an aggregate) of 1 where given.

    One exchange by bucket, which what is grouped by bucket later goes on from; the rows of a bucket are sorted and read
    by one task, which holds a few of them.
    """
    of_bucket = Window.partitionBy("bucket")
    wanted = seen.withColumn("low", F.min("node").over(of_bucket)).withColumn("high", F.max("node").over(of_bucket))
    wanted = wanted.withColumn("useful", F.lit(1) if useful is None else useful.over(of_bucket))
    return wanted.where("low < high and useful = 1").drop("low", "high", "useful")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def linked_components(
    members: DataFrame, attributes: list[str], within_reach: str, confirm: Callable[[DataFrame], DataFrame], rounds: int = 3,
    closer: tuple[DataFrame, list[str], str] | None = None, dense: int = 2,
) -> DataFrame | None:
    """``(node, component)`` of all nodes that a confirmed link joins; none: no candidate.

    ``members`` is a written table ``(bucket, node, *attributes)``; nodes that share a bucket are candidates.
    ``within_reach`` is SQL over the attributes and ``other_`` ones that every link satisfies; ``confirm`` keeps the
    linked ones of ``(a, b)``. ``closer`` takes the place of attributes and SQL for members that stay
    open: a frame ``(node, ...)`` that is too wide for all, the attributes, those of the frame among them, and the SQL.
    In each round the members outside a bucket's largest known group meet a representative of it and join it where they
    are linked; what is still in different groups at last meets pair by pair, so no link between them is lost. That comes
    after the first round where it looks at no more than ``dense`` pairs for each of ``members``, which pays where most
    candidates aren't linked, so that further rounds find little. Groups only grow, so a bucket that holds one group stays out of the rounds that follow. Hot buckets are aggregated per task;
    members meet what their bucket has in a plain join, whose large parts Spark's skew handling splits. Rounds are cut
    through the shared folder.
    """
    links = tested = labels = None
    columns = members.columns
    other = [F.col(c).alias(f"other_{c}") for c in attributes]
    n_members = members.count()
    for turn in range(rounds + 1):
        now = members.withColumn("component", F.col("node"))
        if labels is not None:
            now = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        luck = F.xxhash64(F.col("node"), F.lit(turn)) if turn else F.col("node")
        member = F.struct(luck.alias("luck"), F.col("node").alias("rep"), *other)
        if labels is None:
            parts = now.select("bucket", "component", F.lit(1).cast("bigint").alias("n"), member.alias("member"))
        else:
            parts = now.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.min(member).alias("member"))
        top = F.min(F.struct((-F.col("n")).alias("size"), "member", "component"))
        open_buckets = parts.groupBy("bucket").agg(top.alias("top"), F.sum("n").alias("nodes"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
        open_buckets = cut_lineage(open_buckets.select("bucket", "nodes", F.col("top.component").alias("main"), "top.size", "top.member.*"))
        work = open_buckets.agg(F.sum((F.col("nodes") + F.col("size")).cast("double") * F.col("nodes"))).first()[0] or 0.0
        still = now.join(open_buckets, "bucket")
        if labels is not None:
            still = cut_lineage(still)
            members = still.select(*columns)
        if turn == rounds or work <= (dense if turn else 2) * n_members:
            # every pair that is still open: this makes the result whole whatever the rounds have found
            if labels is None:
                still = cut_lineage(still)
            if closer is not None:
                wide, attributes, within_reach = closer
                still = still.select("bucket", "node", "component", "main", *(c for c in attributes if c not in wide.columns)).join(wide, "node")
                other = [F.col(c).alias(f"other_{c}") for c in attributes]
            one = still.select("bucket", F.col("node").alias("x"), *attributes, F.col("component").alias("c"))
            two = still.where("component <> main").select("bucket", F.col("node").alias("y"), *other, F.col("component").alias("d"), "main")
            # members outside the main group meet it, and each other once
            pairs = _ordered(one.join(two, "bucket").where(F.expr(f"c <> d and (c = main or x < y) and {within_reach}")))
            if tested is not None:
                # a pair meets in several buckets; written first, it is looked up once
                pairs = cut_lineage(pairs).join(tested, ["a", "b"], "left_anti")
            found = cut_lineage(confirm(cut_lineage(pairs)))
            return connected_components(found if links is None else links.union(found))
        # one representative a round for each member: the same one in most of the buckets that a group shares
        first = F.min(F.struct("luck", "rep", "main"))
        met = still.where(f"component <> main and {within_reach}").groupBy(F.col("node").alias("a")).agg(first.alias("met"))
        met = cut_lineage(met.select("a", F.col("met.rep").alias("b"), "met.main"))
        found = cut_lineage(confirm(met.select("a", "b")))
        joined = found.join(met, ["a", "b"]).select(F.col("a").alias("node"), F.col("main").alias("joined"))
        named = joined.withColumnRenamed("joined", "component")
        if labels is not None:
            named = labels.join(joined, "node", "full").select("node", F.coalesce("joined", "component").alias("component"))
        named = cut_lineage(named)
        # a representative may have joined a group of its own
        onward = named.select(F.col("node").alias("component"), F.col("component").alias("onward"))
        labels = cut_lineage(named.join(onward, "component", "left").select("node", F.coalesce("onward", "component").alias("component")))
        pairs = _ordered(met.select(F.col("a").alias("x"), F.col("b").alias("y")))
        links = found if links is None else links.union(found)
        tested = pairs if tested is None else tested.union(pairs)
    return None
