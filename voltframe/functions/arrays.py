"""Array functions of a row, as higher-order expressions (positions from 0)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(a: Column) -> Column:
    """Position of the first greatest value; NULL for an array without values."""
    return (F.nullif(F.array_position(a, F.array_max(a)), F.lit(0)) - 1).cast("int")


def argsort(a: Column) -> Column:
    """Positions in the order of their values, equal values by position (NULLs first)."""
    return F.transform(F.sort_array(F.transform(a, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), lambda s: s["i"])


def flatnonzero(a: Column) -> Column:
    """Positions of the values that are neither 0 nor NULL."""
    at = F.transform(a, lambda x, i: F.when(x != 0, i))
    return F.filter(at, lambda i: i.isNotNull())


def take(a: Column, start: int, stop: int) -> Column:
    """a[start:stop]; a negative position counts from the end, and what lies outside is left out."""
    n = F.size(a)
    first = F.greatest(n + start, F.lit(0)) if start < 0 else F.least(F.lit(start), n)
    last = F.greatest(n + stop, F.lit(0)) if stop < 0 else F.least(F.lit(stop), n)
    return F.slice(a, first + 1, F.greatest(last - first, F.lit(0)))


def windows(a: Column, length: int) -> Column:
    """Every run of ``length`` neighbours, in order; none where the array is shorter."""
    starts = F.when(F.size(a) >= length, F.sequence(F.lit(1), F.size(a) - length + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(a, i, length))
