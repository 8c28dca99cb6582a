"""Splits, feature selection, scaling, class weights and sequence windows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import series


def assign_split(df: DataFrame, bounds, ts: str = "ts", test_end: str | None = None,
                 train_start: str | None = None, name: str = "split") -> DataFrame:
    """Train < b1 <= validation < b2 <= test [<= test_end]; others dropped."""
    b1 = F.to_timestamp_ntz(F.lit(bounds[0]))
    b2 = F.to_timestamp_ntz(F.lit(bounds[1]))
    t = F.col(ts)
    train = t < b1
    if train_start:
        train = train & (t >= F.to_timestamp_ntz(F.lit(train_start)))
    test = t >= b2
    if test_end:
        test = test & (t <= F.to_timestamp_ntz(F.lit(test_end)))
    label = (F.when(train, F.lit("train"))
              .when((t >= b1) & (t < b2), F.lit("validation"))
              .when(test, F.lit("test")))
    return df.withColumn(name, label).filter(F.col(name).isNotNull())


def feature_catalog(columns: Sequence[str], exclude_prefixes=("spike_lead_",),
                    exclude=("ts", "split", "y_true"), flags=("spike", "is_weekend", "is_event"),
                    unscaled_prefixes=("sin_", "cos_", "hour_", "dow_", "month_", "spike_lag_")) -> list[tuple]:
    """Classify columns by explicit rules (metadata only, no job).

    One-hot columns are matched as ``<prefix><digits>``, so ``hour_of_day`` is
    not mistaken for an indicator.
    """
    out = []
    for pos, c in enumerate(columns):
        if c in exclude or any(c.startswith(p) for p in exclude_prefixes):
            role = "excluded"
        elif c in flags:
            role = "flag"
        elif any(c.startswith(p) and (c[len(p):].isdigit() or p in ("sin_", "cos_", "spike_lag_"))
                 for p in unscaled_prefixes):
            role = "unscaled"
        else:
            role = "continuous"
        out.append((pos, c, role))
    return out


#: families of columns that a kind of model leaves out, by pattern (a sequence model sees the past itself)
MODEL_DROPS = {"mlp": (), "cnn": (), "lstm": (r"spike_lag_\d+", r"price_lag_\d+h", r"price_rolling_mean_\d+h")}


def model_features(columns: Sequence[str], model: str, exclude: Sequence[str] = ("ts", "split", "y_true"),
                   exclude_pattern: str = r"spike_lead_\d+", flag_pattern: str = r"spike|is_weekend|is_event|spike_lag_\d+",
                   drops: dict[str, Sequence[str]] = MODEL_DROPS) -> list[tuple]:
    """(position, column, scaled) of the inputs of a kind of model, in table
    order; flags stay as they are, every other input is standardised."""
    if model.lower() not in drops:
        raise ValueError(f"unknown model {model!r}; known: {', '.join(sorted(drops))}")
    out = re.compile("|".join([exclude_pattern, *drops[model.lower()]]))
    flag = re.compile(flag_pattern)
    inputs = [c for c in columns if c not in exclude and not out.fullmatch(c)]
    return [(k, c, not flag.fullmatch(c)) for k, c in enumerate(inputs)]


def scaler_fit(df: DataFrame, cols: Sequence[str], ddof: int = 1, fill_na: float | None = None) -> DataFrame:
    """One global aggregate -> long (column, mean, std) table.

    std: ddof 1 (pandas) or 0 (StandardScaler); zero or NULL std -> 1.
    """
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        if fill_na is not None:
            v = F.coalesce(v, F.lit(float(fill_na)))
        sd = F.stddev_samp(v) if ddof == 1 else F.stddev_pop(v)
        aggs += [F.avg(v).alias(f"m__{c}"), sd.alias(f"s__{c}")]
    row = df.agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m__{c}").alias("mean"),
                                         F.col(f"s__{c}").alias("std")) for c in cols]))
    out = row.select(stack.alias("_s")).select("_s.*")
    return out.withColumn("std", F.coalesce(F.nullif(F.col("std"), F.lit(0.0)), F.lit(1.0)))


def scaler_apply(df: DataFrame, stats_long: DataFrame, cols: Sequence[str],
                 fill_na: float | None = None) -> DataFrame:
    """(x - mean) / std with the fitted stats.

    Fitting is an action, like ``StandardScaler.fit``: the stats table has one
    row per column (bounded by the column list), is brought to the driver and
    inlined as literals -- no join with the data at all.
    """
    stats = {r["column"]: (r["mean"], r["std"]) for r in stats_long.collect()}
    exprs = {}
    for c in cols:
        mean, std = stats[c]
        v = F.col(c).cast("double")
        if fill_na is not None:
            v = F.coalesce(v, F.lit(float(fill_na)))
        exprs[c] = (v - F.lit(mean).cast("double")) / F.lit(std).cast("double")
    return df.withColumns(exprs)


def class_weight(df: DataFrame, label: str = "y_true", guard_pos: bool = True, floor_one: bool = False) -> DataFrame:
    """neg/pos weight; ``guard_pos`` uses max(pos,1), ``floor_one`` max(w,1)."""
    pos = F.sum(F.col(label)).cast("double")
    n = F.count(F.col(label)).cast("double")
    neg = n - pos
    denom = F.greatest(pos, F.lit(1.0)) if guard_pos else pos
    w = F.try_divide(neg, denom)
    if floor_one:
        w = F.greatest(w, F.lit(1.0))
    return df.agg(F.count(F.col(label)).alias("rows"), pos.cast("long").alias("positives"),
                  neg.cast("long").alias("negatives"), w.alias("pos_weight"))


def sequence_windows(df: DataFrame, features: Sequence[str], length: int, label: str = "y_true",
                     order: str = "ts", keys: Sequence[str] = (), scope_col: str | None = None) -> DataFrame:
    """Windows of ``length`` rows ending at each row, label of the last row.

    ``scope_col`` (e.g. the split) restarts windows inside each scope value
    (per-split cutting); without it windows reach across splits (global).
    """
    keys = list(keys) + ([scope_col] if scope_col else [])
    vec = F.array(*[F.col(c).cast("double") for c in features])
    d = df.withColumn("_vec", vec)

    def build(w):
        frame = w.rowsBetween(-(length - 1), 0)
        return {"window": F.collect_list("_vec").over(frame)}

    out = series.ordered(d, build, order=order, keys=keys, reach=length - 1)
    return (out.filter(F.size("window") == length)
               .select(*keys, F.col(order).alias("end_ts"), "window", F.col(label).alias("label")))
