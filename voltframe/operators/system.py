"""Integration of the long generation source with the wide price source.

Plan shape at scale: the raw long table is aggregated once by (hour, type) --
partial aggregation happens map-side, and the distinct count is planned by
Catalyst as a two-level aggregate keyed by (hour, type, unit), so one hot
hour or type never lands whole in one task.  The pivot runs on the already
aggregated (hour x type) cells, and the join with the price table is an equi
join on the hour (both sides are small after aggregation; AQE sizes them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.columns import clip_lower_dead_band, money, safe_div, total
from ..sources.tables import hour_floor


def hourly_by_type(gen_long: DataFrame) -> DataFrame:
    """Floor to hour, group by (hour, type), sum volume and capability."""
    return (gen_long.groupBy(hour_floor("ts").alias("ts"), "fuel_type")
                    .agg(F.sum(money("volume")).cast("double").alias("volume"),
                         (F.count_distinct("unit_id") * 100).cast("double").alias("capability")))


def pivot_fuels(by_type: DataFrame, fuel_map: dict = P.FUEL_MAP, solar: str = "solar",
                dead_band: float = P.SOLAR_DEAD_BAND) -> DataFrame:
    """A02 + P05 + P07: dense wide table with an explicit value list.

    The explicit list makes absent types appear as columns; cells without
    readings are filled with 0.0 (pandas sums give 0.0 there).
    """
    types = list(fuel_map)
    wide = (by_type.groupBy("ts").pivot("fuel_type", types)
                   .agg(F.sum("volume").alias("v"), F.sum("capability").alias("c")))
    cols = [F.col("ts")]
    for t, fuel in fuel_map.items():
        vol = F.coalesce(F.col(f"{t}_v"), F.lit(0.0))
        if fuel == solar:
            vol = clip_lower_dead_band(vol, dead_band)
        cols.append(vol.alias(f"{fuel}_total"))
    for t, fuel in fuel_map.items():
        cols.append(F.coalesce(F.col(f"{t}_c"), F.lit(0.0)).alias(f"{fuel}_cap"))
    return wide.select(*cols)


def merge_hourly(price: DataFrame, gen_wide: DataFrame) -> DataFrame:
    """Inner equi join on the hour, final column order."""
    return price.join(gen_wide, "ts", "inner").select("ts", *P.BASE_COLUMNS)


def hourly_wide(events: DataFrame, fuel_map: dict = P.FUEL_MAP, solar: str = "solar", dead_band: float = P.SOLAR_DEAD_BAND) -> DataFrame:
    """The merged hourly table where prices and readings are rows of one source: one
    scan and one aggregate by (hour, type) give both sides, and the hour's row is
    put together from its few types.  Equal to ``merge_hourly`` of the two."""
    v, unit = money("value"), F.col("user_id") % 10
    cells = events.groupBy(hour_floor("ts").alias("ts"), "event_type").agg(
        F.sum(v).alias("volume"), (F.count_distinct("user_id") * 100).cast("double").alias("capability"), F.max("value").alias("top"),
        F.sum(F.when(unit == 0, v)).alias("imp"), F.sum(F.when(unit == 1, v)).alias("exp"))
    is_fuel = F.col("event_type").isin(list(fuel_map))
    aggs = [F.max("top").alias("price"), F.sum("volume").cast("double").alias("load")]
    for t, fuel in fuel_map.items():
        own = F.coalesce(F.max(F.when(F.col("event_type") == t, F.col("volume"))).cast("double"), F.lit(0.0))
        aggs.append((clip_lower_dead_band(own, dead_band) if fuel == solar else own).alias(f"{fuel}_total"))
        aggs.append(F.coalesce(F.max(F.when(F.col("event_type") == t, F.col("capability"))), F.lit(0.0)).alias(f"{fuel}_cap"))
    aggs += [F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in ("imp", "exp")]
    hours = cells.groupBy("ts").agg(F.count_if(is_fuel).alias("_fuels"), *aggs).filter("_fuels > 0")
    return hours.select("ts", *P.BASE_COLUMNS)


def system_totals(df: DataFrame) -> DataFrame:
    """P10: row-wise totals."""
    fuels = P.FUELS
    return df.withColumns({
        "net_export": F.col("exp") - F.col("imp"),
        "total_generation": total([f"{f}_total" for f in fuels]),
        "total_capability": total([f"{f}_cap" for f in fuels]),
        "dispatchable_generation": total([f"{f}_total" for f in P.DISPATCHABLE] + ["imp"]),
        "dispatchable_capability": total([f"{f}_cap" for f in P.DISPATCHABLE]),
        "renewable_generation": total([f"{f}_total" for f in P.RENEWABLE]),
        "renewable_capability": total([f"{f}_cap" for f in P.RENEWABLE]),
    })


def generation_mix(df: DataFrame) -> DataFrame:
    """Share of each fuel in total generation (NULL when total is 0)."""
    return df.withColumns({f"{f}_mix": safe_div(f"{f}_total", "total_generation") for f in P.FUELS})


def demand_ratios(df: DataFrame) -> DataFrame:
    """P12."""
    return df.withColumns({
        "renewables_share": safe_div("renewable_generation", "load"),
        "dispatchable_ratio": safe_div("dispatchable_generation", "load"),
        "gas_ratio": safe_div("gas_total", "load"),
        "intertie_support": safe_div("imp", "load"),
    })


def capacity_ratios(df: DataFrame) -> DataFrame:
    """P13 (the gas ratio has an explicit zero guard; all use NULL for /0)."""
    return df.withColumns({
        "capacity_renewable": safe_div("renewable_generation", "total_capability"),
        "capacity_dispatchable": safe_div("dispatchable_generation", "total_capability"),
        "capacity_gas": safe_div("gas_total", F.nullif(F.col("gas_cap"), F.lit(0.0))),
    })


def reserve_margin(df: DataFrame) -> DataFrame:
    """Net load, resilience buffer, reserve margin."""
    return df.withColumns({
        "net_load": F.col("load") - F.col("renewable_generation"),
        "resilience_buffer": F.col("total_capability") - F.col("load"),
    }).withColumn("reserve_margin", safe_div("resilience_buffer", "load"))


def system_features(df: DataFrame) -> DataFrame:
    return reserve_margin(capacity_ratios(demand_ratios(generation_mix(system_totals(df)))))
