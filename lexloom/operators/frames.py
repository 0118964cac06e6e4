"""Joins, rankings, previews and printable tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexloom.functions.text import pad_left, pad_right
from lexloom.session import cut_lineage


def unnest(
    df: DataFrame, array: Column | str, *keep: str, name: str = "token", pos: str | None = None
) -> DataFrame:
    """One row per array element, null ones too, with the columns ``keep`` (and its 0-based ``pos``).

    Null and empty arrays give no rows.

    The outer form is used on purpose: for the plain one Spark puts a "not empty" filter in
    front, which would work out the array a second time, before any repartitioning.
    """
    at = pos or "_pos"
    rows = df.select(*keep, F.posexplode_outer(array).alias(at, name)).filter(F.col(at).isNotNull())
    return rows if pos else rows.drop(at)


# Rows of a right side that may be sent to every task after they were counted.
SENT_ROWS = 100_000


def salted_join(
    left: DataFrame, right: DataFrame, key: str, by: str, how: str = "inner", salts: int = 1
) -> DataFrame:
    """Join ``left`` to a ``right`` whose keys are unique; ``left`` may have many rows of one key.

    Both sides are plain exchanges that meet in a merge join: neither is sent to every task or held by
    the driver, and Spark's skew handling splits a part that one key makes large. A ``right`` that is small
    beside ``left`` can be repeated ``salts`` times, so that a key's rows are divided by a hash of column ``by``.
    """
    if salts == 1:
        return left.join(right.hint("merge"), key, how)
    salt = F.pmod(F.xxhash64(by), F.lit(salts))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    # Spark takes the repeated rows for as few as they were, so it must not choose a broadcast by their size
    return left.withColumn("_salt", salt).join(repeated.hint("merge"), [key, "_salt"], how).drop("_salt")


def checked_join(
    left: DataFrame, right: DataFrame, key: str, by: str, how: str = "inner", most: int = SENT_ROWS
) -> DataFrame:
    """Join ``left`` to a ``right`` whose keys are unique and usually few.

    ``right`` is written to the shared folder and counted up to ``most`` rows: that many go to every
    task and ``left`` is not shuffled; more of them meet it in a merge join.
    """
    written = cut_lineage(right)
    if written.limit(most + 1).count() <= most:
        return left.join(F.broadcast(written), key, how)
    return salted_join(left, written, key, by, how)


def preview(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in an explicit order."""
    return df.orderBy(*order).limit(n)


def top_n(df: DataFrame, n: int, score: str, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest score; ties go by the given keys."""
    return df.orderBy(F.desc(score), *ties).limit(n)


def rank_hits(df: DataFrame, part: str | list[str], score: str, *ties: str, k: int | None = None) -> DataFrame:
    """1-based rank by descending score inside ``part``; with ``k``, only the best ``k``.

    With ``k`` Spark keeps the best ``k`` of every group before the shuffle. Without it every
    group is ranked whole, so use it on groups that are known to be small.
    """
    parts = [part] if isinstance(part, str) else part
    order = W.partitionBy(*parts).orderBy(F.desc(score), *ties)
    ranked = df.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def format_report(df: DataFrame, spec: list[tuple[str, int, str]], sep: str = " | ") -> DataFrame:
    """One aligned ``line`` per row, next to the original columns.

    ``spec`` lists ``(column, width, kind)``; kind is ``<`` or ``>`` for left and right
    alignment, optionally with decimals as in ``>.4``.
    """
    cells = []
    for name, width, kind in spec:
        value = F.col(name)
        if "." in kind:
            value = F.format_string(f"%.{int(kind.split('.')[1])}f", value)
        cells.append((pad_left if kind.startswith(">") else pad_right)(value, width))
    return df.withColumn("line", F.concat_ws(sep, *cells))


def report_header(spec: list[tuple[str, int, str]], titles: list[str], sep: str = " | ") -> list[str]:
    """The header line and the rule under it, for printing above the lines."""
    cells = [
        title.rjust(width) if kind.startswith(">") else title.ljust(width)
        for (_, width, kind), title in zip(spec, titles, strict=True)
    ]
    header = sep.join(cells)
    return [header, "-" * len(header)]


def softmax_over(df: DataFrame, group: str, score: str, by: str, out: str = "prob") -> DataFrame:
    """Softmax of ``score`` over all rows with the same ``group``; ``by`` tells its rows apart.

    The group's maximum and sum are aggregated inside each task first and joined back by
    :func:`checked_join`, so few large groups are neither sorted nor shuffled.
    """
    top = df.groupBy(group).agg(F.max(score).alias("_top"))
    shifted = checked_join(df, top, group, by).withColumn("_power", F.exp(F.col(score) - F.col("_top")))
    total = shifted.groupBy(group).agg(F.sum("_power").alias("_total"))
    return (
        checked_join(shifted, total, group, by)
        .withColumn(out, F.col("_power") / F.col("_total"))
        .drop("_top", "_power", "_total")
    )


def argmax_rows(df: DataFrame, group: list[str], label: str, score: str) -> DataFrame:
    """The label with the largest score of each group; the lowest label wins ties."""
    best = F.min(F.struct((-F.col(score)).alias("down"), F.col(label).alias("label")))
    return (
        df.groupBy(*group)
        .agg(best.alias("_best"))
        .select(*group, F.col("_best.label").alias(label), (-F.col("_best.down")).alias(score))
    )
