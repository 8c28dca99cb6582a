"""Alignment of external forecasts, coverage, nearest grid point, byte-range
inventories and resumable backfills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def align_to_axis(axis: DataFrame, forecast: DataFrame, ts: str = "ts", provenance: dict | None = None) -> DataFrame:
    """J03 + P29: left join of a forecast onto the reference axis, constant provenance columns."""
    out = axis.select(ts).join(forecast, ts, "left")
    for k, v in (provenance or {}).items():
        out = out.withColumn(k, F.lit(v))
    return out


def wind_speed(u, v, kmh: bool = True):
    """Speed from u/v components (m/s -> km/h)."""
    s = F.hypot(F.col(u) if isinstance(u, str) else u, F.col(v) if isinstance(v, str) else v)
    return s * F.lit(3.6) if kmh else s


def wrap_longitude(lon):
    """0..360 -> -180..180 (west negative)."""
    l = F.pmod(F.col(lon) if isinstance(lon, str) else lon, F.lit(360.0))
    return F.when(l > 180.0, l - 360.0).otherwise(l)


def nearest_point(df: DataFrame, group: Sequence[str], lat: str, lon: str, target_lat: float, target_lon: float,
                  extra: Sequence[str] = ()) -> DataFrame:
    """Grid point nearest to a coordinate per group.

    ``min(struct(distance, lat, lon, ...))`` is an ordinary aggregate with
    map-side partial results, so a hot group never gathers its rows in one task;
    ties resolve deterministically by the struct order.
    """
    d2 = (F.col(lat) - F.lit(target_lat)) ** 2 + (F.col(lon) - F.lit(target_lon)) ** 2
    best = F.min(F.struct(d2.alias("d2"), F.col(lat).alias("lat"), F.col(lon).alias("lon"),
                          *[F.col(c).alias(c) for c in extra])).alias("_b")
    return df.groupBy(*group).agg(best).select(*group, F.sqrt("_b.d2").alias("distance_deg"), "_b.lat", "_b.lon",
                                               *[F.col(f"_b.{c}").alias(c) for c in extra])


def parse_inventory(lines: DataFrame, file_col: str = "file") -> DataFrame:
    """``n:offset:d=date:var:level:...`` -> (file, n, var, level, start, end).

    end = offset of the next line of the file - 1, whatever its number (NULL for
    the last line).  Lines are indexed by offset, and the lead runs as a halo
    window on that index: a very long inventory is split into bounded blocks.
    """
    from . import series
    parts = F.split(F.col("value"), ":")
    d = lines.select(file_col, parts.getItem(0).cast("long").alias("n"), parts.getItem(1).cast("long").alias("start"),
                     F.regexp_replace(parts.getItem(2), "^d=", "").alias("run"), parts.getItem(3).alias("var"),
                     F.trim(parts.getItem(4)).alias("level"))

    def build(w):
        return {"end": F.lead("start", 1).over(w) - 1}

    return series.ordered(d, build, order="start", keys=[file_col], reach=1, block_rows=1 << 16, index_block_width=1 << 28)


def resume_backfill(requested: DataFrame, existing: DataFrame, key: str, compute, max_new: int | None = None,
                    order: Sequence[str] = ()) -> DataFrame:
    """Pending keys = requested anti existing, computed, appended
    and deduplicated (existing rows win).  Only a caller that passes ``max_new``
    gets a capped run (the first keys); the next run resumes after them."""
    pending = requested.select(key).distinct().join(existing.select(key), key, "left_anti")
    if max_new is not None:
        pending = pending.orderBy(key).limit(max_new)
    new = compute(pending).withColumn("_prio", F.lit(1))
    old = existing.withColumn("_prio", F.lit(0))
    both = old.unionByName(new, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.col("_prio"), *order)
    return both.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_prio")


def dedupe_first(df: DataFrame, key: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Keep the first row per key in an explicit order.

    Expressed as ``min(struct(order..., keep...))`` per key: partial aggregation
    runs map-side, so a key holding a third of all rows is reduced before the
    shuffle instead of being gathered into one window partition.
    """
    s = F.min(F.struct(*[F.col(c).alias(c) for c in order], *[F.col(c).alias(f"_k_{c}") for c in keep])).alias("_f")
    out = df.groupBy(*key).agg(s)
    return out.select(*key, *[F.col(f"_f.{c}").alias(c) for c in order],
                      *[F.col(f"_f._k_{c}").alias(c) for c in keep if c not in order])


def coverage_rows(aligned: DataFrame, dataset: str, value: str, ts: str = "ts") -> DataFrame:
    """Requested range (the axis itself), rows, non-null rows, first/last valid time."""
    ok = F.col(value).isNotNull()
    return aligned.agg(F.lit(dataset).alias("dataset"), F.min(ts).alias("requested_start"),
                       F.max(ts).alias("requested_end"), F.count(F.lit(1)).alias("rows_in_output"),
                       F.count(F.col(value)).alias("non_null_rows"),
                       F.min(F.when(ok, F.col(ts))).alias("available_start"),
                       F.max(F.when(ok, F.col(ts))).alias("available_end"))


__all__ = ["align_to_axis", "wind_speed", "wrap_longitude", "nearest_point", "parse_inventory",
           "resume_backfill", "dedupe_first", "coverage_rows"]
