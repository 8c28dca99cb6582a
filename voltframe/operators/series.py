"""Ordered-series operators without a single global partition.

Row-position semantics (lag/lead/diff/rolling by row, not by time) need a
global order.  ``Window.orderBy(ts)`` without ``partitionBy`` moves every row
into one task (``Exchange SinglePartition``), which does not survive a long
series or one hot key holding a third of all rows.  Two layouts avoid it:

* **row index** -- ``row_number`` inside coarse time blocks, per-block counts
  (one row per block), a running offset over that small table, and an equi
  join back (AQE turns it into a broadcast after measuring the block table).
* **halo windows** -- with the row index ``idx`` and a reach ``H`` (largest
  lag/lead/frame), rows are bucketed into blocks of ``B >= H`` rows and each
  row is also copied into the neighbouring block it can be seen from.  A
  window partitioned by (keys, target block) then sees every row it needs;
  only rows whose own block is the target are kept.  Duplication is about
  ``1 + 2H/B``.

NULLs: a NULL key is a series of its own, and rows with a NULL order value come
first in their series.  A row whose given index is NULL stays and sees no
neighbours; negative indexes are positions like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BLOCK_ROWS = 8760          # one year of hours per halo block
DEFAULT_INDEX_BLOCK_SECONDS = 30 * 86400


def _order_number(df: DataFrame, order: str) -> Column:
    dtype = df.schema[order].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_timestamp(F.col(order).cast("timestamp"))
    return F.col(order)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the keys of ``left`` stay."""
    right = right.withColumnsRenamed({k: f"_j_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_j_{k}"]) for k in keys]
    return left.join(right, on, how).drop(*[f"_j_{k}" for k in keys])


def add_row_index(df: DataFrame, order: str = "ts", keys: Sequence[str] = (), idx: str = "idx",
                  tiebreak: Sequence[str] = (), block_width: float = DEFAULT_INDEX_BLOCK_SECONDS) -> DataFrame:
    """0-based row position per series in ``order`` (W10), two-level."""
    keys = list(keys)
    blk = F.floor(_order_number(df, order) / F.lit(float(block_width)))
    local = df.withColumn("_blk", blk)
    w_local = Window.partitionBy(*keys, "_blk").orderBy(order, *tiebreak)
    local = local.withColumn("_rn", F.row_number().over(w_local))
    counts = local.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_blk", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    return (null_safe_join(local, offsets, [*keys, "_blk"])
                 .withColumn(idx, (F.col("_off") + F.col("_rn") - 1).cast("long"))
                 .drop("_blk", "_rn", "_off"))


def ordered(df: DataFrame, build: Callable[[WindowSpec], dict], order: str = "ts",
            keys: Sequence[str] = (), reach: int = 24,
            block_rows: int = DEFAULT_BLOCK_ROWS, idx: str | None = None,
            keep_idx: bool = False, index_block_width: float = DEFAULT_INDEX_BLOCK_SECONDS) -> DataFrame:
    """Add the columns of ``build(w)``; ``w`` is ordered by row position.

    ``reach`` must cover the farthest row any expression looks at.
    """
    keys = list(keys)
    drop_idx = False
    if idx is None:
        df = add_row_index(df, order, keys, idx="_idx", block_width=index_block_width)
        idx, drop_idx = "_idx", not keep_idx
    b = max(int(block_rows), int(reach), 1)
    own = F.floor(F.col(idx) / F.lit(b))
    targets = F.array_distinct(F.array(own, F.floor((F.col(idx) - F.lit(reach)) / F.lit(b)),
                                       F.floor((F.col(idx) + F.lit(reach)) / F.lit(b))))
    # a row without a position is alone in its window
    alone = F.when(F.col(idx).isNull(), F.monotonically_increasing_id())
    ex = df.withColumns({"_own": own, "_alone": alone}).withColumn("_tgt", F.explode(targets))
    w = Window.partitionBy(*keys, "_tgt", "_alone").orderBy(idx)
    out = ex.withColumns(build(w)).filter(F.col("_own").eqNullSafe(F.col("_tgt"))).drop("_own", "_tgt", "_alone")
    if drop_idx:
        out = out.drop(idx)
    elif keep_idx and idx == "_idx":
        out = out.withColumnRenamed("_idx", "idx")
    return out


# --- expression builders -------------------------------------------------------------

def leads(src: str, ks, name: str = "{src}_lead_{k}", cast: str | None = None):
    def build(w):
        out = {}
        for k in ks:
            c = F.lead(src, k).over(w)
            out[name.format(src=src, k=k)] = c.cast(cast) if cast else c
        return out
    return build


def lags(src: str, ks, name: str = "{src}_lag_{k}", cast: str | None = None):
    def build(w):
        out = {}
        for k in ks:
            c = F.lag(src, k).over(w)
            out[name.format(src=src, k=k)] = c.cast(cast) if cast else c
        return out
    return build


def diffs(src: str, ks, name: str = "{src}_change_{k}"):
    def build(w):
        return {name.format(src=src, k=k): F.col(src) - F.lag(src, k).over(w) for k in ks}
    return build


def shifted_rolling_mean(src: str, n: int, name: str):
    """shift(1).rolling(n).mean(): NULL unless n non-null values precede."""
    def build(w):
        frame = w.rowsBetween(-n, -1)
        return {name: F.when(F.count(src).over(frame) == n, F.avg(src).over(frame))}
    return build


def combine(*builders):
    def build(w):
        out = {}
        for b in builders:
            out.update(b(w))
        return out
    return build


# --- two-level prefix sums -----------------------------------------------------------

def prefix_sums(df: DataFrame, cols: Sequence[str], order: str, keys: Sequence[str] = (),
                block: Column | None = None, descending: bool = False, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order`` per ``keys``.

    ``block`` groups rows into chunks that are summed locally; the chunk totals
    (one row per chunk) get their own running sum and are joined back.
    """
    keys = list(keys)
    o = F.col(order).desc() if descending else F.col(order).asc()
    if block is None:
        block = F.lit(0)
    blk_sign = -1 if descending else 1
    d = df.withColumn("_pblk", block * F.lit(blk_sign))
    w_local = Window.partitionBy(*keys, "_pblk").orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"_loc_{c}": F.sum(c).over(w_local) for c in cols})
    tot = d.groupBy(*keys, "_pblk").agg(*[F.sum(c).alias(f"_tot_{c}") for c in cols])
    w_blk = Window.partitionBy(*keys).orderBy("_pblk").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, "_pblk", *[F.coalesce(F.sum(f"_tot_{c}").over(w_blk), F.lit(0)).alias(f"_off_{c}") for c in cols])
    out = null_safe_join(d, tot, [*keys, "_pblk"])
    out = out.withColumns({f"{c}{suffix}": F.col(f"_off_{c}") + F.col(f"_loc_{c}") for c in cols})
    return out.drop("_pblk", *[f"_loc_{c}" for c in cols], *[f"_off_{c}" for c in cols])


def attach_totals(df: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach per-group totals to rows.

    Without keys ``totals`` is a global aggregate (exactly one row): it becomes a
    scalar subquery (``DataFrame.scalar()``), which Spark evaluates once and
    inlines -- no join at all.  With keys it is one row per group and an equi
    join whose strategy AQE picks from the measured size.
    """
    keys = list(keys)
    if keys:
        return null_safe_join(df, totals, keys)
    cols = totals.columns
    packed = totals.select(F.struct(*cols).alias("_tot")).scalar()
    return df.withColumn("_tot", packed).select(*df.columns, *[F.col(f"_tot.{c}").alias(c) for c in cols])


#: rows of one block of values, and cuts that one look at the values may give
BLOCK_VALUES, FIRST_CUTS = 100_000, 1024


def value_cuts(df: DataFrame, value: str, keys: Sequence[str] = (), block_values: int = BLOCK_VALUES) -> dict[tuple, list[float]]:
    """Cuts of each key's values into blocks of about ``block_values`` rows (none
    where there are fewer).  One aggregate; a second one where a key has so many
    rows that ``FIRST_CUTS`` cuts leave larger blocks.  Some 8 bytes a block reach
    the driver."""
    def look(rows: DataFrame, most: int) -> list:
        probs = [i / most for i in range(1, most)]
        quantiles = F.percentile_approx(F.col(value).cast("double"), probs, 10 * most)
        return rows.groupBy(*keys).agg(F.count(value).alias("n"), quantiles.alias("q")).collect()

    found, most = look(df, FIRST_CUTS), FIRST_CUTS
    needed = max((-(-r["n"] // block_values) for r in found), default=0)
    if needed > most:
        found, most = look(df, needed), needed
    out = {}
    for r in found:
        blocks = max(-(-r["n"] // block_values), 1)
        picked = [r["q"][min(most * k // blocks, most - 1) - 1] for k in range(1, blocks)]
        out[tuple(r[k] for k in keys)] = sorted({float(x) for x in picked if x is not None})
    return out


def value_block(value: Column, cuts: Sequence[float]) -> Column:
    """Number of the block of ``value``: cuts up to it, found among every 64th one
    and then among the 64 that follow."""
    if not cuts:
        return F.lit(0).cast("long")
    wide = F.array(*[F.lit(float(c)) for c in cuts[::64]])
    coarse = F.size(F.filter(wide, lambda c: c <= value))
    near = F.slice(F.array(*[F.lit(float(c)) for c in cuts]), F.greatest((coarse - 1) * 64, F.lit(0)) + 1, 64)
    return (F.greatest((coarse - 1) * 64, F.lit(0)) + F.size(F.filter(near, lambda c: c <= value))).cast("long")


def with_value_blocks(df: DataFrame, value: str, out: str = "_vblk", block_values: int = BLOCK_VALUES) -> DataFrame:
    """Add ``out``: block number of ``value`` such that blocks hold about equally many
    rows, however many there are.  Used to cut prefix-sum inputs into ranges whose
    size depends neither on the value range nor on where the values concentrate."""
    cuts = value_cuts(df, value, block_values=block_values).get((), [])
    return df.withColumn(out, value_block(F.col(value).cast("double"), cuts))


# --- gaps, folds, tails ---------------------------------------------------------------

def axis_gaps(df: DataFrame, order: str = "ts", keys: Sequence[str] = (), step_seconds: int = 3600) -> DataFrame:
    """Rows whose predecessor is more than one step earlier."""
    sec = F.unix_timestamp(F.col(order).cast("timestamp"))
    d = df.select(*keys, order).withColumn("_sec", sec)
    out = ordered(d, lambda w: {"prev_ts": F.lag(order).over(w), "_prev_sec": F.lag("_sec").over(w)},
                  order=order, keys=keys, reach=1)
    return (out.filter(F.col("_sec") - F.col("_prev_sec") > step_seconds)
               .select(*keys, "prev_ts", F.col(order).alias("next_ts"),
                       ((F.col("_sec") - F.col("_prev_sec")) / step_seconds - 1).cast("long").alias("missing_steps")))


def expanding_folds(indexed: DataFrame, n_rows: Column | int, n_splits: int, idx: str = "idx",
                    fold_table: DataFrame | None = None) -> DataFrame:
    """TimeSeriesSplit roles computed from the row index.

    Fold i (0-based) of n: test size floor(N/(n+1)), test starts at
    N - (n - i) * size, train is everything before it.  The fold list is a
    literal of n rows, explode()d per row -- no join needed.
    """
    n = F.lit(n_rows) if isinstance(n_rows, int) else n_rows
    size = F.floor(n / F.lit(n_splits + 1))
    folds = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1)))
    d = indexed.withColumn("fold", folds)
    start = n - (F.lit(n_splits) - F.col("fold")) * size
    role = (F.when(F.col(idx) < start, F.lit("train"))
             .when(F.col(idx) < start + size, F.lit("test")))
    return d.withColumn("role", role).filter(F.col("role").isNotNull())
