"""A backfill that is written back, and can be killed at any point.

A run computes the keys that the table lacks, writes the partitions that they
touch (old and new rows together) to a staging folder, and then replaces exactly
these partitions of the table (dynamic partition overwrite).  A marker is written
last.  The next run first publishes again what was staged in full but not
marked; a staging folder without Spark's own success file is left alone, and its
keys are simply still missing.  Nothing but the touched partitions is rewritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "part"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _runs(spark: SparkSession, path: str) -> list[str]:
    if not _exists(spark, f"{path}/_staged"):
        return []
    fs, p = _fs(spark, f"{path}/_staged")
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The published rows; none where nothing has been published yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_parts(df: DataFrame, path: str) -> None:
    """Replaces the partitions that ``df`` has rows of, and no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def recover(spark: SparkSession, path: str) -> int:
    """Publishes runs that were staged in full but not marked; their number."""
    done = 0
    for run in _runs(spark, path):
        staged = f"{path}/_staged/{run}"
        if _exists(spark, f"{staged}/_SUCCESS") and not _exists(spark, f"{path}/_published/{run}/_SUCCESS"):
            _publish(spark, path, run)
            done += 1
    return done


def _publish(spark: SparkSession, path: str, run: str) -> None:
    write_parts(spark.read.parquet(f"{path}/_staged/{run}"), path)
    spark.range(1).select(F.lit(run).alias("run")).write.mode("overwrite").parquet(f"{path}/_published/{run}")


def run_backfill(spark: SparkSession, path: str, schema: StructType, requested: DataFrame, key: str, part: Column,
                 compute: Callable[[DataFrame], DataFrame], max_new: int | None = None, before_publish: Callable[[str], None] | None = None) -> int:
    """Adds the rows of the ``requested`` keys that the table lacks; their number.

    ``compute`` maps pending keys to rows; ``part`` names a row's partition as a
    string; ``max_new`` caps a run at the first keys, and the next run goes on.
    ``before_publish`` is called between staging and publishing."""
    recover(spark, path)
    full = StructType(list(schema.fields)).add(PART, "string")
    old = read_table(spark, path, full)
    pending = requested.select(key).distinct().join(old.select(key), key, "left_anti")
    if max_new is not None:
        pending = pending.orderBy(key).limit(max_new)
    new = compute(pending).select(*schema.names).withColumn(PART, part)
    run = uuid.uuid4().hex
    staged = f"{path}/_staged/{run}"
    # rows of touched partitions that are already there stay as they are
    touched = old.join(new.select(PART).distinct(), PART, "left_semi").select(*schema.names, PART)
    touched.unionByName(new).write.partitionBy(PART).parquet(staged)
    added = spark.read.schema(full).parquet(staged).join(old.select(key), key, "left_anti").count()
    if before_publish is not None:
        before_publish(run)
    if added:
        _publish(spark, path, run)
    return added
