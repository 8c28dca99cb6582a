"""Descriptive tables: pivots, resampling, exact quantiles, histograms,
box statistics, correlations, profiles.

Exact quantiles are distributed: a frequency table (value -> count, map-side
combined), two-level prefix sums over it, and one aggregate that picks the
values at the interpolation ranks.  Nothing collects a group's values in one
task; ``percentile_approx`` is available behind ``approx=True``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import r6
from ..session import join_small, materialize
from . import series


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (),
                    block_width: float | None = None, approx: bool = False, names=None) -> DataFrame:
    """Linear-interpolation quantiles (pandas/numpy default) per group.

    Output: ``groups`` + one column per prob (``q_<p>`` or ``names``).
    """
    groups = list(groups)
    names = list(names) if names else [f"q_{str(p).replace('.', '_')}" for p in probs]
    v = F.col(value).cast("double")
    if approx:
        arr = F.percentile_approx(v, list(probs), 100000)
        out = df.groupBy(*groups).agg(arr.alias("_q"))
        return out.select(*groups, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    freq = value_counts_by(df, value, groups)
    if block_width:
        freq = freq.withColumn("_vblk", F.floor(F.col("_v") / F.lit(block_width)))
    else:
        freq = series.with_value_blocks(freq, "_v")          # ~equal distinct values per block
    return _picked(freq, probs, groups, names)


def value_counts_by(df: DataFrame, value: str, groups: Sequence[str]) -> DataFrame:
    """``groups``, ``_v`` (distinct values, NULLs left out) and ``_n``."""
    v = F.col(value).cast("double")
    return df.filter(v.isNotNull()).groupBy(*groups, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def _picked(freq: DataFrame, probs: Sequence[float], groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Interpolated quantiles from counts of distinct values in blocks ``_vblk``."""
    cum = series.prefix_sums(freq, ["_n"], "_v", groups, block=F.col("_vblk")).drop("_vblk")
    totals = freq.groupBy(*groups).agg(F.sum("_n").alias("_total"))
    t = series.attach_totals(cum, totals, groups).withColumn("_prev", F.col("_n_cum") - F.col("_n"))
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_total") - 1).cast("double")
        lo, hi = F.floor(pos), F.ceil(pos)
        hit_lo = (F.col("_prev") <= lo) & (lo < F.col("_n_cum"))
        hit_hi = (F.col("_prev") <= hi) & (hi < F.col("_n_cum"))
        aggs += [F.max(F.when(hit_lo, F.col("_v"))).alias(f"_lo{i}"), F.max(F.when(hit_hi, F.col("_v"))).alias(f"_hi{i}"),
                 F.max(pos - lo).alias(f"_fr{i}")]
    out = t.groupBy(*groups).agg(*aggs)
    return out.select(*groups, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_fr{i}")).alias(n)
        for i, n in enumerate(names)])


def pivot_mean(df: DataFrame, row: str, col: str, value: str, values: Sequence, scale: float = 1.0,
               prefix: str = "h") -> DataFrame:
    """groupBy(row).pivot(col, values).avg(value) with fixed columns."""
    p = df.groupBy(row).pivot(col, list(values)).agg(F.avg(F.col(value) * F.lit(scale)))
    return p.select(row, *[r6(F.col(str(v))).alias(f"{prefix}{int(v):02d}") for v in values])


def mean_by(df: DataFrame, value: str, dims: Sequence[str]) -> DataFrame:
    """Mean of ``value`` by each calendar dimension (long form, one pass),
    the highest mean of a dimension first."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("int").alias("key")) for d in dims]))
    out = df.select(each.alias("_d"), value).groupBy("_d.dimension", "_d.key").agg(r6(F.avg(value)).alias(f"mean_{value}"))
    return out.orderBy("dimension", F.desc(f"mean_{value}"), "key")


def null_profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """A10: one-pass NULL counts per column, unpivoted, optionally top n."""
    cols = [c for c in df.columns]
    row = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = row.unpivot([], cols, "column", "nulls")
    if top:
        long = long.orderBy(F.col("nulls").desc(), F.col("column").asc()).limit(top)
    return long


def histogram(df: DataFrame, value: str, bins: int, clip_upper: float | None = None) -> DataFrame:
    """A17 (T26): equal-width bins over [min, max], last bin closed, empty bins kept.

    The bounds are one global aggregate attached as a scalar subquery (evaluated
    once, inlined); the per-row bucket is then a plain column expression.  The
    dense bin list is the aggregate exploded into ``bins`` rows.
    """
    v = F.col(value).cast("double")
    if clip_upper is not None:
        v = F.least(v, F.lit(float(clip_upper)))
    d = df.select(v.alias("_v")).filter(F.col("_v").isNotNull())
    bounds = d.agg(F.min("_v").alias("mn"),
                   F.when(F.max("_v") > F.min("_v"), F.max("_v") - F.min("_v")).otherwise(F.lit(1.0)).alias("w"))
    b = series.attach_totals(d, bounds, [])
    nb = F.lit(float(bins))
    bucket = F.least(F.floor((F.col("_v") - F.col("mn")) * nb / F.col("w")).cast("int") + 1, F.lit(bins))
    counts = b.groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    dense = (bounds.filter(F.col("mn").isNotNull())
                   .select("mn", "w", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")))
    out = dense.join(counts, "bin", "left")
    lower = F.col("mn") + (F.col("bin") - 1).cast("double") * F.col("w") / nb
    upper = F.col("mn") + F.col("bin").cast("double") * F.col("w") / nb
    return out.select("bin", r6(lower).alias("lower"), r6(upper).alias("upper"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def box_stats(df: DataFrame, value: str, group: str, block_width: float | None = None) -> DataFrame:
    """Quartiles, 1.5 IQR fences, whiskers at the extreme values inside them."""
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], [group], block_width, names=["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    # counts of distinct values stand in for the rows; a large group is not gathered to meet its one row of q
    freq = df.groupBy(group, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    j = join_small(freq, q, group)
    inside = (F.col("_v") >= F.col("q1") - 1.5 * F.col("iqr")) & (F.col("_v") <= F.col("q3") + 1.5 * F.col("iqr"))
    out = j.groupBy(group).agg(F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
                               F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
                               F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
                               F.sum("_c").alias("rows"))
    return out.select(group, *[r6(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "rows")


def correlation_long(df: DataFrame, cols: Sequence[str], lower_only: bool = True, pairs=None) -> DataFrame:
    """A16 (T9): pairwise-complete Pearson correlation.

    One aggregate holds the co-moments of all pairs (partial map-side), and its
    one row is turned into the pair table; rows where either value is NULL do not
    count for a pair, so only columns that have NULLs need deviations of their own
    for each pair; a constant column gives NULL instead of an ANSI error.
    """
    if pairs is None:
        pairs = [(a, b) for i, a in enumerate(cols) for j, b in enumerate(cols)
                 if (j < i if lower_only else j != i)]
    used = list(dict.fromkeys(c for pair in pairs for c in pair))
    d = df.select(*[F.col(c).cast("double").alias(c) for c in used])
    nulls = d.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in used]).first()
    full = [c for c in used if not nulls[c]]
    aggs = [F.stddev_pop(c).alias(f"s_{c}") for c in full]
    for k, (a, b) in enumerate(pairs):
        aggs.append(F.covar_pop(a, b).alias(f"c{k}"))
        if a not in full or b not in full:
            aggs += [F.stddev_pop(F.when(F.col(o).isNotNull(), F.col(c))).alias(f"{n}{k}") for n, c, o in (("x", a, b), ("y", b, a))]
    row = d.agg(*aggs)
    spread = lambda k, a, b: (F.col(f"s_{a}") * F.col(f"s_{b}") if a in full and b in full
                              else F.col(f"x{k}") * F.col(f"y{k}"))
    table = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.try_divide(F.col(f"c{k}"), spread(k, a, b)).alias("corr"))
                      for k, (a, b) in enumerate(pairs)])
    return row.select(F.explode(table).alias("_p")).select("_p.feature_a", "_p.feature_b", r6(F.col("_p.corr")).alias("corr"))


def period_spine(df: DataFrame, period: str, ts: str = "ts") -> DataFrame:
    """Calendar spine of periods between min and max (one-row aggregate, exploded)."""
    b = df.agg(F.min(F.date_trunc(period, F.col(ts))).alias("_a"), F.max(F.date_trunc(period, F.col(ts))).alias("_b"))
    return b.select(F.explode(F.sequence(F.col("_a").cast("timestamp_ntz"), F.col("_b").cast("timestamp_ntz"),
                                         F.expr(f"INTERVAL 1 {period.upper()}"))).alias("period"))


def month_spine(df: DataFrame, ts: str = "ts") -> DataFrame:
    return period_spine(df, "month", ts).withColumnRenamed("period", "month")


def monthly_resample(df: DataFrame, median_of: str, mean_of: Sequence[str], ts: str = "ts",
                     block_width: float | None = None) -> DataFrame:
    """A15 (T27): monthly median / means; months without rows appear with NULLs."""
    m = df.withColumn("month", F.date_trunc("month", F.col(ts)).cast("timestamp_ntz"))
    med = exact_quantiles(m, median_of, [0.5], ["month"], block_width, names=[f"median_{median_of}"])
    means = m.groupBy("month").agg(*[F.avg(c).alias(f"mean_{c}") for c in mean_of], F.count(F.lit(1)).alias("rows"))
    spine = month_spine(df, ts)
    out = spine.join(med, "month", "left").join(means, "month", "left")
    return out.select("month", r6(f"median_{median_of}").alias(f"median_{median_of}"),
                      *[r6(f"mean_{c}").alias(f"mean_{c}") for c in mean_of],
                      F.coalesce(F.col("rows"), F.lit(0)).alias("rows"))


def stacked(df: DataFrame, cols: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """(ids..., column, value): one row for each value that is not NULL, in one pass."""
    d = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return d.unpivot(list(ids), list(cols), "column", "value").filter(F.col("value").isNotNull())


def in_periods(df: DataFrame, period: str, ts: str = "ts") -> DataFrame:
    return df.withColumn("period", F.date_trunc(period, F.col(ts)).cast("timestamp_ntz"))


def period_profile(df: DataFrame, cols: Sequence[str], period: str = "month", ts: str = "ts",
                   block_values: int = series.BLOCK_VALUES) -> DataFrame:
    """A15 (T27) over any number of columns: exact median and mean of each column in
    each period; periods without rows appear with NULLs.

    The columns are stacked and counted by (period, column, value), so all of them
    share one shuffle; running counts go by blocks of values cut for each column."""
    long = stacked(in_periods(df, period, ts), cols, ["period"])
    freq = materialize(value_counts_by(long, "value", ["period", "column"]), "value-counts")
    cuts = series.value_cuts(freq, "_v", ["column"], block_values)
    block = F.lit(0).cast("long")
    for (column,), own in cuts.items():
        if own:
            block = F.when(F.col("column") == column, series.value_block(F.col("_v"), own)).otherwise(block)
    keys = ["period", "column"]
    medians = _picked(freq.withColumn("_vblk", block), [0.5], keys, ["median"])
    means = freq.groupBy(*keys).agg(F.try_divide(F.sum(F.col("_v") * F.col("_n")), F.sum("_n")).alias("mean"), F.sum("_n").alias("rows"))
    return _on_spine(df, cols, period, ts, medians.join(means, keys))


def _on_spine(df: DataFrame, cols: Sequence[str], period: str, ts: str, found: DataFrame) -> DataFrame:
    every = F.explode(F.array(*[F.lit(c) for c in cols])).alias("column")
    spine = period_spine(df, period, ts).select("period", every)
    out = spine.join(found, ["period", "column"], "left")
    return out.select("period", "column", r6("median").alias("median"), r6("mean").alias("mean"), F.coalesce("rows", F.lit(0)).alias("rows"))


#: largest share of all ranks by which a quantile of a sketch with KLL_K may be off (with 99 % confidence)
KLL_K, KLL_RANK_ERROR = 400, 0.01


def column_sketches(df: DataFrame, cols: Sequence[str], period: str = "day", ts: str = "ts", k: int = KLL_K) -> DataFrame:
    """``period``, ``column``, ``sketch`` (KLL, some kilobytes whatever the rows),
    ``total``, ``rows``: parts that can be merged over any longer period."""
    long = stacked(in_periods(df, period, ts), cols, ["period"])
    return long.groupBy("period", "column").agg(F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"), F.sum("value").alias("total"),
                                                F.count("value").alias("rows"))


def merged_profile(sketches: DataFrame, df: DataFrame, cols: Sequence[str], period: str = "month", ts: str = "ts", k: int = KLL_K) -> DataFrame:
    """The profile of longer periods from stored sketches of shorter ones: medians
    within ``KLL_RANK_ERROR`` of the true rank, means exact."""
    whole = sketches.withColumn("period", F.date_trunc(period, "period").cast("timestamp_ntz"))
    found = whole.groupBy("period", "column").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("total").alias("total"), F.sum("rows").alias("rows"))
    found = found.withColumns({"median": F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)), "mean": F.try_divide("total", "rows")})
    return _on_spine(df, cols, period, ts, found.select("period", "column", "median", "mean", "rows"))


def describe(df: DataFrame, value: str, percentiles: Sequence[float], block_width: float | None = None) -> DataFrame:
    """Count, mean, std (ddof 1), min, chosen percentiles, max, long form."""
    v = F.col(value).cast("double")
    base = df.agg(F.count(v).cast("double").alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                  F.min(v).alias("min"), F.max(v).alias("max"))
    names = [f"p{round(p * 1000):04d}" for p in percentiles]
    q = exact_quantiles(df, value, percentiles, [], block_width, names=names)
    long = (base.unpivot([], ["count", "mean", "std", "min", "max"], "stat", "value")
                .unionByName(q.unpivot([], names, "stat", "value")))
    return long.withColumn("value", r6("value"))


def unpivot_measures(df: DataFrame, ids: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Melt to (ids..., measure, value)."""
    d = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in measures])
    return d.unpivot(list(ids), list(measures), "measure", "value")


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Counts of non-null values."""
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("count"))
