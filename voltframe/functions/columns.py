"""Column-expression helpers (all JVM-side Catalyst expressions)."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """Division that yields NULL for a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(col(a), col(b))


def ratio0(a, b) -> Column:
    """Metric ratio with zero_division=0."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b).cast("double")), F.lit(0.0))


def nan_to_null(c) -> Column:
    """pandas' missing is NaN; Spark's is NULL. Normalise on read."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def total(cols) -> Column:
    return reduce(add, [col(c) for c in cols])


def r6(c) -> Column:
    """Round to 6 places; adding 0.0 normalises -0.0 to 0.0."""
    return F.round(col(c), 6) + F.lit(0.0)


def money(c) -> Column:
    """Exact two-decimal representation for order-independent sums."""
    return col(c).cast("decimal(18,2)")


def clip_lower_dead_band(c, band: float) -> Column:
    v = F.greatest(col(c), F.lit(0.0))
    return F.when(v < band, F.lit(0.0)).otherwise(v)


def flag_above(c, threshold: float) -> Column:
    """(c > t) as int; NULL stays NULL."""
    return (col(c) > F.lit(threshold)).cast("int")


# Abramowitz & Stegun 7.1.26 coefficients (fixed values of the published formula)
_AS_P = 0.3275911
_AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(x) -> Column:
    x = col(x)
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_AS_P) * ax)
    poly = reduce(lambda acc, a: acc * t + F.lit(a), reversed(_AS_A[:-1]), F.lit(_AS_A[-1]))
    y = F.lit(1.0) - poly * t * F.exp(-ax * ax)
    return F.when(x < 0, -y).otherwise(y)


def normal_sf(z) -> Column:
    """Upper-tail probability of a standard normal, P(Z > z)."""
    return F.lit(0.5) * (F.lit(1.0) - erf(col(z) / F.lit(math.sqrt(2.0))))


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(z)))


def grid_value(i, start: float, stop: float, count: int) -> Column:
    """linspace(start, stop, count)[i] with the same double arithmetic
    (i * step + start; the endpoint is exactly ``stop``)."""
    step = (stop - start) / (count - 1)
    i = col(i)
    return F.when(i == count - 1, F.lit(float(stop))).otherwise(i.cast("double") * F.lit(step) + F.lit(float(start)))


def grid_bucket(score, start: float, stop: float, count: int) -> Column:
    """Number of grid thresholds t_i <= score, exact at the grid edges.

    A closed-form guess is corrected by exact comparisons against the four
    neighbouring grid values, so floating error never moves a row.
    """
    step = (stop - start) / (count - 1)
    s = col(score).cast("double")
    guess = F.floor((s - F.lit(start)) / F.lit(step)).cast("long")
    guess = F.least(F.greatest(guess, F.lit(-2)), F.lit(count + 1))
    base = F.least(F.greatest(guess - 1, F.lit(0)), F.lit(count))
    extra = F.lit(0)
    for d in (-1, 0, 1, 2):
        k = guess + F.lit(d)
        tk = grid_value(k, start, stop, count)
        extra = extra + F.when((k >= 0) & (k < count) & (k >= guess - 1) & (tk <= s), 1).otherwise(0)
    return F.when(s.isNull(), F.lit(None)).otherwise(base + extra)
