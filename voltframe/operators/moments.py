"""Products of columns: one array-valued aggregate for any number of columns,
the sweep operator on its result, and running sums of products along a series.

A matrix of p columns has p(p+1)/2 sums.  Written as SQL aggregates they make an
unwieldy plan from some twenty columns on; here each task adds up its rows as one
matrix (centred, so digits do not go as rows grow), a few tasks merge the
matrices, and the driver gets at most ``MERGERS`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import series

#: tasks that merge the matrices of all others
MERGERS = 16
#: a column with less than this share of itself left by other columns is spanned by them
SPANNED = 1e-8

_PART = "n long, mean array<double>, moments array<double>"


def _merge(a: tuple, b: tuple) -> tuple:
    """Count, means and centred products of two sets of rows together."""
    (n, m, c), (k, o, d) = a, b
    if not n or not k:
        return a if n else b
    gap = o - m
    return n + k, m + gap * (k / (n + k)), c + d + np.outer(gap, gap) * (n * k / (n + k))


def _none(p: int) -> tuple:
    return 0, np.zeros(p), np.zeros((p, p))


def _row(total: tuple) -> pa.RecordBatch:
    n, m, c = total
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([m], pa.list_(pa.float64())), pa.array([c.ravel()], pa.list_(pa.float64()))],
                                      ["n", "mean", "moments"])


def co_moments(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, int, np.ndarray]:
    """Sums of centred products of ``columns`` over complete rows, their number, and the means."""
    p = len(columns)
    rows = df.select(*[F.col(c).cast("double").alias(f"_m{i}") for i, c in enumerate(columns)]).na.drop()

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _none(p)
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                mean = x.mean(0)
                total = _merge(total, (len(x), mean, (x - mean).T @ (x - mean)))
        yield _row(total)

    def parts_of(batches) -> tuple:
        total = _none(p)
        for batch in batches:
            for r in batch.to_pylist():
                total = _merge(total, (r["n"], np.array(r["mean"]), np.array(r["moments"]).reshape(p, p)))
        return total

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _row(parts_of(batches))

    few = rows.mapInArrow(local, _PART).repartition(MERGERS).mapInArrow(merged, _PART)
    n, mean, moments = parts_of(few.toArrow().to_batches())
    return moments, n, mean


def products(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, int]:
    """Uncentred sums of products of ``columns`` over complete rows, and their number."""
    moments, n, mean = co_moments(df, columns)
    return moments + n * np.outer(mean, mean), n


# --- sweep operator ---------------------------------------------------------------------------

def sweep(a: np.ndarray, k: int) -> None:
    """Brings variable ``k`` of a matrix of products into the regression, in place;
    a second sweep takes it out again (each a rank-one update)."""
    d, row, column = a[k, k], a[k].copy(), a[:, k].copy()
    a -= np.outer(column, row) / d
    a[k], a[:, k] = row / d, -column / d
    a[k, k] = 1.0 / d


def screened(g: np.ndarray, names: Sequence[str], limit: float, least: int) -> list[dict]:
    """Variance inflation on a matrix of products.  Columns that earlier ones span
    (and columns of zeros) have no finite value and go first; then the largest
    goes, the first of equal ones, while it exceeds ``limit`` and more than
    ``least`` columns are left.  One row for each step and column still in."""
    scale = np.sqrt(np.maximum(np.diag(g), 0.0))
    a = g / np.outer(np.where(scale > 0, scale, 1.0), np.where(scale > 0, scale, 1.0))
    inside, spanned = [], []
    for k in range(len(names)):
        if a[k, k] > SPANNED:
            sweep(a, k)
            inside.append(k)
        else:
            spanned.append(k)
    rows, step = [{"step": 0, "feature": names[k], "vif": None} for k in spanned], 0
    while inside:
        vifs = a[inside, inside]
        rows += [{"step": step, "feature": names[k], "vif": float(v)} for k, v in zip(inside, vifs)]
        if vifs.max() <= limit or len(inside) <= least:
            break
        sweep(a, inside.pop(int(np.argmax(vifs))))
        step += 1
    return rows


# --- fits of all rows so far ------------------------------------------------------------------

def running_products(df: DataFrame, columns: Sequence[str], order: str = "ts", keys: Sequence[str] = (), out: str = "products",
                     idx: str | None = None, block_rows: int = series.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Adds ``out``: the sums of products of ``columns`` over all rows of the series
    up to and including each row (upper triangle, row by row), and ``out``_n, the
    rows that count.  A row with a NULL in ``columns`` adds nothing.  ``idx`` names
    the rows' positions where they are known.

    Two-level running sums: inside blocks of ``block_rows`` rows, over the totals
    of the blocks, and a join of the two; no task sees a whole series."""
    cols = list(columns)
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.col(c).isNotNull()
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    d = df.withColumn("_idx", F.col(idx)) if idx else series.add_row_index(df, order, keys, idx="_idx")
    d = d.withColumns({f"_x{k}": F.when(whole, F.col(a).cast("double") * F.col(b)).otherwise(F.lit(0.0)) for k, (a, b) in enumerate(pairs)}
                      | {"_n": whole.cast("long")})
    sums = [f"_x{k}" for k in range(len(pairs))]
    d = series.prefix_sums(d, [*sums, "_n"], "_idx", keys, block=F.floor(F.col("_idx") / F.lit(block_rows)))
    return d.select(*df.columns, F.array(*[f"{c}_cum" for c in sums]).alias(out), F.col("_n_cum").alias(f"{out}_n"))


def solved(out: Column, n: Column, k: int) -> Column:
    """Least squares of the last of k + 1 columns on the first k, from each row's sums
    of products: struct of ``beta`` and ``s2``; NULL up to 2k rows.  Rows are
    solved a batch at a time."""
    upper = np.triu_indices(k + 1)

    @F.pandas_udf("struct<beta:array<double>,s2:double>")
    def solve(sums: pd.Series, rows: pd.Series) -> pd.DataFrame:
        known = sums.notna().to_numpy() & (rows.to_numpy() > 2 * k)
        beta, s2 = np.full(len(sums), None, object), np.full(len(sums), np.nan)
        if known.any():
            g = np.zeros((int(known.sum()), k + 1, k + 1))
            packed = np.stack(sums[known].to_numpy())
            g[:, upper[0], upper[1]] = packed
            g[:, upper[1], upper[0]] = packed
            scale = np.sqrt(np.maximum(np.einsum("nii->ni", g), 0.0))
            scale[scale == 0] = 1.0
            g /= scale[:, :, None] * scale[:, None, :]
            xtx, xty = g[:, :k, :k], g[:, :k, k]
            b = np.einsum("nij,nj->ni", np.linalg.pinv(xtx, rcond=1e-12, hermitian=True), xty)
            sse = (g[:, k, k] - np.einsum("ni,ni->n", b, xty)) * scale[:, k] ** 2
            s2[known] = np.maximum(sse, 0.0) / (rows.to_numpy()[known] - k)
            for at, row in zip(np.flatnonzero(known), b * scale[:, k:] / scale[:, :k]):
                beta[at] = row
        return pd.DataFrame({"beta": beta, "s2": s2})

    return solve(out, n)


def walk_forward(df: DataFrame, value: str, exog, order: str = "ts", step=None, lags: int = 3) -> DataFrame:
    """Two-step-ahead forecasts of ``value``, each from the fit of all rows up
    to its own: an autoregression of the change on ``lags`` earlier changes and
    the terms ``exog(time)`` (known in advance).  Adds ``forecast`` and
    ``forecast_se``; NULL where too few rows precede."""
    step = step or (lambda t, k: t + F.make_dt_interval(hours=F.lit(k)))
    names = list(exog(F.col(order)))

    def build(w):
        back = [F.col(value)] + [F.lag(value, k).over(w) for k in range(1, lags + 2)]
        return {f"_d{k}": back[k] - back[k + 1] for k in range(lags + 1)}

    d = series.ordered(series.add_row_index(df, order, idx="_at"), build, order=order, reach=lags + 1, idx="_at")
    terms = exog(F.col(order))
    d = d.withColumns({f"_f{k}": terms[name] for k, name in enumerate(names)})
    xs = [*[f"_d{k}" for k in range(1, lags + 1)], *[f"_f{k}" for k in range(len(names))]]
    d = running_products(d, [*xs, "_d0"], order, out="_g", idx="_at")
    d = d.withColumn("_fit", solved(F.col("_g"), F.col("_g_n"), len(xs)))
    beta = [F.get("_fit.beta", F.lit(k)) for k in range(len(xs))]

    def one_step(changes, ahead):
        later = exog(step(F.col(order), ahead))
        out = sum((b * x for b, x in zip(beta, changes)), F.lit(0.0))
        return sum((b * later[name] for b, name in zip(beta[lags:], names)), out)

    first = one_step([F.col(f"_d{k}") for k in range(lags)], 1)
    d = d.withColumn("_s1", first)
    second = one_step([F.col("_s1"), *[F.col(f"_d{k}") for k in range(lags - 1)]], 2)
    return d.select(*df.columns, (F.col(value) + F.col("_s1") + second).alias("forecast"),
                    F.sqrt(F.col("_fit.s2") * ((1 + beta[0]) * (1 + beta[0]) + 1)).alias("forecast_se"))
