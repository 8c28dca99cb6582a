"""Points joined with the intervals that hold them, without a nested loop.

An interval goes to the level whose bins are at least as long as it is, so it
lies in two bins at most, whether it lasts a second or a year; a point looks up
its bin of each level that occurs (their number grows with the logarithm of the
longest interval).  The join is an equi-join on (level, bin), with the exact test
after it.  A bin that many points and intervals share is split by AQE's skew
join; no pair is formed that does not share a bin.

Pairs grow with the square of the density.  Where only sums over each interval's
points are asked for (``totals``), none are formed: the points are summed by time,
running sums over the distinct times of points and ends are taken in blocks that
Spark's range partitioning cuts, and each interval is joined with the sums at its
two ends.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import series

#: length of the shortest bins in seconds, and of the bins of a level in those of the one below
BASE, FACTOR = 3600, 8


def _micros(c):
    return F.unix_micros(c.cast("timestamp"))


def interval_join(points: DataFrame, intervals: DataFrame, ts: str, start: str, end: str, closed: bool = False,
                  base: int = BASE, factor: int = FACTOR, totals: Mapping[str, Column | str] | None = None,
                  blocks: int | None = None) -> DataFrame:
    """All columns of both sides for each point in [start, end), or [start, end] if
    ``closed``.  NULL times and intervals that end before they start match nothing.

    With ``totals`` (names and columns of the points, integers or decimals) the rows
    of each interval are summed: its columns and the sums, for each interval row that
    holds a point.  A sum over NULLs alone is NULL.  ``blocks`` fixes the number of
    blocks of times, which otherwise follows from their size."""
    spans = intervals.filter(F.col(end) >= F.col(start))
    if totals is not None:
        return _summed(points.filter(F.col(ts).isNotNull()), spans, ts, start, end, closed, totals, blocks)
    first, last = _micros(F.col(start)), _micros(F.col(end))
    spans = spans.withColumn("_len", last - first)
    level = F.greatest(F.lit(0), F.ceil(F.log(F.col("_len") / F.lit(base * 1e6)) / F.log(F.lit(float(factor)))).cast("int"))
    spans = spans.withColumn("_level", F.when(F.col("_len") <= F.lit(base * 1_000_000), 0).otherwise(level)).drop("_len")
    levels = sorted(r["_level"] for r in spans.select("_level").distinct().collect())
    width = F.lit(base * 1_000_000) * F.pow(F.lit(float(factor)), F.col("_level")).cast("long")
    bins = F.sequence(F.floor(first / width), F.floor(last / width))
    spans = spans.withColumn("_bin", F.explode(bins))
    seen = points.filter(F.col(ts).isNotNull()).withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
    seen = seen.withColumn("_bin", F.floor(_micros(F.col(ts)) / width))
    inside = (F.col(ts) >= F.col(start)) & ((F.col(ts) <= F.col(end)) if closed else (F.col(ts) < F.col(end)))
    return seen.join(spans, ["_level", "_bin"]).filter(inside).drop("_level", "_bin")


def _summed(points: DataFrame, spans: DataFrame, ts: str, start: str, end: str, closed: bool,
            totals: Mapping[str, Column | str], blocks: int | None) -> DataFrame:
    """Sums over the points in each interval: those up to its end less those before its start."""
    values = {f"_v{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(totals.values())}
    counted = {"_n": F.lit(1)} | {f"_n{k}": c.isNotNull().cast("int") for k, c in values.items()}
    at = points.select(F.col(ts).alias("_at"), *[c.alias(k) for k, c in (values | counted).items()])
    if inexact := [n for n, k in zip(totals, values) if not isinstance(at.schema[k].dataType, (T.IntegralType, T.DecimalType))]:
        raise TypeError(f"Differences of running sums are exact for integers and decimals only: {inexact}")
    for edge in (start, end):       # each end is one of the times
        at = at.unionByName(spans.select(F.col(edge).alias("_at")), allowMissingColumns=True)
    cols = [*values, *counted]
    at = at.groupBy("_at").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])
    at = (at.repartitionByRange(blocks, "_at") if blocks else at.repartitionByRange("_at")).withColumn("_block", F.spark_partition_id())
    at = series.prefix_sums(materialize(at, "times"), cols, "_at", block=F.col("_block"))

    def upto(edge: str, inclusive: bool) -> DataFrame:
        return at.select(F.col("_at").alias(f"_at_{edge}"), *[
            (F.col(f"{c}_cum") if inclusive else F.col(f"{c}_cum") - F.col(c)).alias(f"{c}_{edge}") for c in cols])

    both = (spans.join(upto("a", False), F.col(start) == F.col("_at_a"))
                 .join(upto("b", closed), F.col(end) == F.col("_at_b")))
    inside = lambda c: F.col(f"{c}_b") - F.col(f"{c}_a")
    return both.filter(inside("_n") > 0).select(*[spans[c] for c in spans.columns], *[
        F.when(inside(f"_n{k}") > 0, inside(k)).alias(name) for name, k in zip(totals, values)])
