"""Table readers with explicit schemas and the stand-in hourly/daily sources.

Every reader selects only the columns it needs, so Catalyst prunes the Parquet
scan (``ReadSchema``) and pushes filters (``PushedFilters``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions.columns import money, nan_to_null

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def require_columns(df: DataFrame, required) -> DataFrame:
    """Raise before any job runs if a required column is missing (metadata only)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def hour_floor(c) -> F.Column:
    """Floor to the hour, keeping the zone-less timestamp type."""
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str, columns=("ts", "event_type", "value", "user_id")) -> DataFrame:
    df = read_table(spark, sf_dir, "events", list(columns))
    if "value" in columns:
        df = df.withColumn("value", nan_to_null("value"))
    return df


def generation_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long generation source: one row per reading (time, fuel type, volume, unit id).

    The membership filter on the fuel type reaches the Parquet scan.
    """
    ev = events(spark, sf_dir)
    return (ev.filter(F.col("event_type").isin(list(P.FUEL_MAP)))
              .select(F.col("ts"), F.col("event_type").alias("fuel_type"),
                      F.col("value").alias("volume"), F.col("user_id").alias("unit_id")))


def price_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly wide price / load / intertie table (one row per hour)."""
    ev = events(spark, sf_dir, ("ts", "value", "user_id"))
    v = money("value")
    return (ev.groupBy(hour_floor("ts").alias("ts"))
              .agg(F.max("value").alias("price"),
                   F.sum(v).cast("double").alias("load"),
                   F.coalesce(F.sum(F.when(F.col("user_id") % 10 == 0, v)), F.lit(0)).cast("double").alias("imp"),
                   F.coalesce(F.sum(F.when(F.col("user_id") % 10 == 1, v)), F.lit(0)).cast("double").alias("exp")))


def daily_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily long table from orders: (ts, type, volume)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_orderpriority", "o_totalprice"])
    return o.select(F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
                    F.col("o_orderpriority").alias("type"),
                    nan_to_null("o_totalprice").alias("volume"))


def daily_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily table D: one row per day with price, load and one column per type."""
    d = daily_long(spark, sf_dir)
    v = money("volume")
    aggs = [F.max("volume").alias("price"), F.sum(v).cast("double").alias("load")]
    for i, p in enumerate(P.PRIORITIES, start=1):
        aggs.append(F.coalesce(F.sum(F.when(F.col("type") == p, v)), F.lit(0)).cast("double").alias(f"type{i}_total"))
    return d.groupBy("ts").agg(*aggs)
