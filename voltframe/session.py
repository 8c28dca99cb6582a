"""Spark session and shared-storage helpers.

The library never creates machine-local scratch space on a cluster: stage
tables go to the folder named by ``spark.checkpoint.dir`` (read from the
session).  Without that setting a local master gets a fresh temporary folder;
any other master is an error.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small shuffle outputs by size (advisory 64MB), not by core count
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts are decided on MEASURED sizes only: no static (estimate-based)
    # broadcast; AQE converts a join after its shuffle stage reports <= 32MB.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "voltframe",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster pass ``master=None``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_sql_defaults(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the library relies on to an existing
    session (UTC, AQE, measured-size broadcasts); shuffle partitions are left
    to the caller."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and "arrow" not in k:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a temporary one only if unset."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="voltframe-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a derived stage table (hourly, daily, engineered, predictions) as
    Parquet under the shared checkpoint folder and read it back.

    Downstream branches of one plan then scan this small table instead of
    re-deriving it from the raw input (which Catalyst cannot always dedupe
    across differently shaped branches), lineage is cut, a lost executor
    re-reads files instead of recomputing from the raw scan, and AQE sees
    exact file sizes for its join choices.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # known schema: no footer inference


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", most: int = 100_000) -> DataFrame:
    """Join with a side of one row a group.  It is written and counted first; up
    to ``most`` rows it is broadcast, so that a group with a large share of
    ``big`` does not meet in one task, else the join is left to the optimizer."""
    small = materialize(small, "small")
    return big.join(F.broadcast(small) if small.count() <= most else small, on, how)
