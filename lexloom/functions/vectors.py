"""Columns over vectors held as ``array<double>`` (or ``array<float>``, widened here)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.functions.text import _col


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``: a lambda body would repeat it per element."""
    return F.transform(F.array(value), use)[0]


def as_doubles(vec: Column | str) -> Column:
    return _col(vec).cast("array<double>")


def literal_vector(values: list[float]) -> Column:
    """A constant vector; one literal that Spark folds, instead of one per value."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product; null when the lengths differ."""
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vec: Column | str) -> Column:
    return F.sqrt(dot(vec, vec))


def unit(vec: Column | str) -> Column:
    """The vector scaled to length one; a zero vector stays as it is."""
    wide = as_doubles(vec)
    return _let(
        l2_norm(vec),
        lambda norm: F.when(norm > 0, F.transform(wide, lambda x: x / norm)).otherwise(wide),
    )


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; null for a zero vector and for unequal lengths."""
    scale = l2_norm(a) * l2_norm(b)
    return F.when(scale > 0, dot(a, b) / scale)


def vec_slice(vec: Column | str, n: int) -> Column:
    return F.slice(_col(vec), 1, n)


def vec_at(vec: Column | str, index: int) -> Column:
    """The ``index``-th value, 0-based, negative from the end; null when out of range."""
    return F.try_element_at(_col(vec), F.lit(index + 1 if index >= 0 else index))


def argmax(vec: Column | str) -> Column:
    """0-based index of the largest value; the first one wins ties."""
    c = _col(vec)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def topk(vec: Column | str, k: int) -> Column:
    """The ``k`` largest values as array<struct<index, value>>; lower index first on ties."""
    ordered = F.array_sort(
        F.transform(as_doubles(vec), lambda x, i: F.struct((-x).alias("neg"), i.alias("index")))
    )
    return F.transform(
        F.slice(ordered, 1, k),
        lambda s: F.struct(s["index"].alias("index"), (-s["neg"]).alias("value")),
    )


def softmax(vec: Column | str) -> Column:
    """Scores to probabilities; the largest score is taken off first, so nothing overflows."""
    wide = as_doubles(vec)
    powers = _let(
        F.array_max(wide), lambda top: F.transform(wide, lambda x: F.exp(x - top))
    )
    total = F.aggregate(powers, F.lit(0.0), lambda s, x: s + x)
    return _let(total, lambda s: F.transform(powers, lambda p: p / s))


def closer_label(sim_a: Column, sim_b: Column, a: str, b: str) -> Column:
    """Which of two candidates is nearer; a tie goes to the second one."""
    return F.when(sim_a > sim_b, a).otherwise(b)
