"""Bounds that are checked before anything is sent to every task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_of_heaviest(frame: DataFrame, weight: str, most: int) -> int:
    """The smallest weight such that at most ``most`` rows weigh as much or more; weights are whole numbers from 1.

    Found on a histogram of a fixed number of steps, so it may be larger than it need be by an eighth of an octave.
    """
    step = F.floor(8 * F.log2(F.col(weight).cast("double")) + 1e-9).cast("int")
    rows = frame.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min(weight).alias("least")).collect()
    total, least = 0, None
    for row in sorted(rows, key=lambda r: -r["step"]):
        total += row["n"]
        if total > most:
            break
        least = row["least"]
    return least if least is not None else (1 << 62)


def join_checked(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", most: int = 10_000) -> DataFrame:
    """Join with ``right`` sent to every task if it is counted to have at most ``most`` rows, else shuffled.

    ``right`` should be a written table: it is counted here, and beyond the bound Spark can split a hot key of
    ``left`` where both sides meet.
    """
    few = right.limit(most + 1).count() <= most
    return left.join(F.broadcast(right) if few else right, on, how)
