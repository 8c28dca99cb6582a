"""Structured Streaming counterparts of three batch operators.

* ST1 ``hourly_totals_stream``: tumbling 1-hour windows per type with a
  watermark (late rows up to a bound), ``update`` mode into an idempotent
  per-batch sink; the latest row per window equals the batch aggregate A01.
* ST1 finalised, ``finalised_hours_stream``: the same windows in ``append`` mode:
  each is written once, when the watermark passes its end, and leaves the state.
* ST2 ``dedupe_stream``: each batch drops repeats of its own, timely rows whose key
  came within the bound, and late rows whose key the target holds, so a row that
  is new stays however late it comes (equals A30 / distinct events).
* ST3 ``incremental_daily``: file source + checkpoint + ``foreachBatch``; a
  second run over the same checkpoint only reads files that arrived since.

All state and outputs live under the shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted driver or lost executor resumes.
``withWatermark`` needs TIMESTAMP, so the zone-less event time is cast first.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import money
from ..session import scratch_path
from ..sources import tables

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def new_run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"stream_{name}_{uuid.uuid4().hex[:10]}")


def stage_event_files(spark: SparkSession, sf_dir: str, path: str, day_filter=None, mode: str = "append") -> str:
    """Write the events table as one directory of files per day (the stream's input)."""
    ev = tables.read_table(spark, sf_dir, "events")
    ev = ev.withColumn("day", F.to_date("ts"))
    if day_filter is not None:
        ev = ev.filter(day_filter)
    ev.write.mode(mode).partitionBy("day").parquet(path)
    return path


def _source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(EVENT_SCHEMA + ", day DATE").format("parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def _finish(q, timeout_s: int | None) -> None:
    """Wait for an availableNow run; a bound on the time is the caller's choice."""
    done = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() or True
    if not done:
        q.stop()
        raise TimeoutError(f"streaming query {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()


def _batch_sink(out: str):
    """Idempotent foreachBatch sink: a replayed batch overwrites its own folder."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))
    return write


def hourly_totals_stream(spark: SparkSession, src: str, run_dir: str, delay: str = "2 hours",
                         timeout_s: int | None = None) -> DataFrame:
    """ST1: per (hour window, type) sums with a watermark; returns the final table."""
    s = _source(spark, src)
    s = s.withColumn("ets", F.col("ts").cast("timestamp")).withWatermark("ets", delay)
    agg = (s.groupBy(F.window("ets", "1 hour").alias("w"), F.col("event_type"))
             .agg(F.sum(money("value")).cast("double").alias("volume"), F.count(F.lit(1)).alias("readings")))
    out = os.path.join(run_dir, "out")
    q = (agg.writeStream.outputMode("update").foreachBatch(_batch_sink(out))
            .option("checkpointLocation", os.path.join(run_dir, "ckpt")).trigger(availableNow=True).start())
    _finish(q, timeout_s)
    res = spark.read.parquet(out)
    w = Window.partitionBy("w", "event_type").orderBy(F.col("batch_id").desc())
    latest = res.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return latest.select(F.col("w.start").cast("timestamp_ntz").alias("ts"), "event_type", "volume", "readings")


#: state store on local disk with changelogs in the checkpoint folder: state may exceed a worker's memory
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


class settings:
    """Session settings for the time of a block; those of before come back."""

    def __init__(self, spark: SparkSession, values: dict[str, str]):
        self.spark, self.values = spark, values

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.values}
        for k, v in self.values.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def finalised_hours_stream(spark: SparkSession, src: str, run_dir: str, delay: str = "2 hours", max_files: int | None = None,
                           timeout_s: int | None = None) -> tuple[DataFrame, dict]:
    """ST1: windows that the watermark has passed, each written once by the
    exactly-once file sink, and figures of the run: the most windows in the state
    at once, and late groups of rows (a window and type within a batch) left out."""
    s = _source(spark, src, max_files).withColumn("ets", F.col("ts").cast("timestamp")).withWatermark("ets", delay)
    agg = (s.groupBy(F.window("ets", "1 hour").alias("w"), F.col("event_type"))
             .agg(F.sum(money("value")).cast("double").alias("volume"), F.count(F.lit(1)).alias("readings")))
    rows = agg.select(F.col("w.start").cast("timestamp_ntz").alias("ts"), "event_type", "volume", "readings")
    out = os.path.join(run_dir, "final")
    with settings(spark, ROCKSDB):
        q = (rows.writeStream.outputMode("append").format("parquet").option("path", out)
                 .option("checkpointLocation", os.path.join(run_dir, "ckpt-final")).trigger(availableNow=True).start())
        _finish(q, timeout_s)
    state = [op for p in q.recentProgress for op in p["stateOperators"]]
    figures = {"most_windows": max((op["numRowsTotal"] for op in state), default=0), "late_groups": sum(op["numRowsDroppedByWatermark"] for op in state)}
    return spark.read.schema(rows.schema).parquet(out), figures


def dedupe_stream(spark: SparkSession, src: str, run_dir: str, bound: str = "INTERVAL 1 DAY", max_files: int | None = None,
                  timeout_s: int | None = None) -> DataFrame:
    """ST2: every event once, late ones included.

    Keys live beside the target, a folder a batch.  A row is timely if it is at most
    ``bound`` behind the newest row of earlier batches: it is compared with the keys
    that came within the bound, and with no row of the target.  Only late rows are
    compared with the target, on their own days (a re-delivered row keeps its
    time).  So what a batch reads depends on the bound and on its late rows, not on
    the number of batches before it.  A replayed batch overwrites its own folders,
    which it does not compare with."""
    out, keys, marks = (os.path.join(run_dir, name) for name in ("out", "keys", "marks"))
    target = EVENT_SCHEMA + ", batch INT, day DATE"

    def write(df: DataFrame, batch_id: int) -> None:
        new = df.dropDuplicates(["day", "event_id"])
        if batch_id > 0:
            seen = spark.read.schema("newest TIMESTAMP_NTZ, batch INT").parquet(marks).filter(F.col("batch") < batch_id)
            mark = seen.agg((F.max("newest") - F.expr(bound)).alias("mark")).first()["mark"]
            late = F.lit(False) if mark is None else F.coalesce(F.col("ts") < F.lit(mark), F.lit(True))
            recent = [r["batch"] for r in seen.filter(F.lit(True) if mark is None else F.col("newest") >= F.lit(mark)).select("batch").collect()]
            near = spark.read.schema("event_id BIGINT, ts TIMESTAMP_NTZ, day DATE, batch INT").parquet(keys).filter(F.col("batch").isin(recent))
            timely = new.filter(~late).join(near.select("day", "event_id"), ["day", "event_id"], "left_anti")
            behind = new.filter(late)
            days = [r["day"] for r in behind.select("day").distinct().collect()]
            old = spark.read.schema(target).parquet(out).filter((F.col("batch") < batch_id) & F.col("day").isin(days))
            new = timely.unionByName(behind.join(old.select("day", "event_id"), ["day", "event_id"], "left_anti"))
        new.write.mode("overwrite").partitionBy("day").parquet(os.path.join(out, f"batch={batch_id}"))
        done = spark.read.schema(EVENT_SCHEMA + ", day DATE").parquet(os.path.join(out, f"batch={batch_id}"))
        done.select("event_id", "ts", "day").write.mode("overwrite").parquet(os.path.join(keys, f"batch={batch_id}"))
        done.agg(F.max("ts").alias("newest")).write.mode("overwrite").parquet(os.path.join(marks, f"batch={batch_id}"))

    q = (_source(spark, src, max_files).writeStream.foreachBatch(write)
         .option("checkpointLocation", os.path.join(run_dir, "ckpt")).trigger(availableNow=True).start())
    _finish(q, timeout_s)
    return spark.read.schema(target).parquet(out).drop("batch")


def incremental_daily(spark: SparkSession, src: str, run_dir: str, timeout_s: int | None = None) -> int:
    """ST3: one availableNow run; only files not in the checkpoint are read.
    Each batch appends daily totals; returns the number of batches run."""
    s = _source(spark, src)
    daily = s.select(F.to_date("ts").alias("day"), "value")
    out = os.path.join(run_dir, "out")

    def write(df: DataFrame, batch_id: int) -> None:
        agg = df.groupBy("day").agg(F.sum(money("value")).alias("total"), F.count(F.lit(1)).alias("readings"))
        agg.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    q = (daily.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(run_dir, "ckpt"))
              .trigger(availableNow=True).start())
    _finish(q, timeout_s)
    progress = q.recentProgress
    return len([p for p in progress if p.get("numInputRows", 0) > 0])


def incremental_result(spark: SparkSession, run_dir: str) -> DataFrame:
    """Merge the appended batch outputs: a day seen in several batches is summed."""
    res = spark.read.parquet(os.path.join(run_dir, "out"))
    return res.groupBy("day").agg(F.sum("total").cast("double").alias("total"), F.sum("readings").alias("readings"))
