"""Operator 5: shards along a Hilbert curve.

Several metadata dimensions are quantised to ``2^BITS`` cells (cuts at
approximate quantiles; of whole strings, at cumulative shares of their counted
values in byte order), a row's cells give its index on the Hilbert curve, rows are sorted by
(index, id), and the sorted sequence is cut into runs.  Law ``rows``: the counts
of two shards differ by one at most.  A shard covers a compact part of the
metadata space, so the least and greatest values of ``manifest`` prune shards on
any of the dimensions.

Scale: the texts are only read for their measures; the narrow rows are written
to the shared folder, sorted by range (ties end with the id, so a hot cell
splits), and their position is (rows of earlier partitions) + (position in the
partition); only the row count of each partition goes through one task.

Defined results: a null counts as the least value of its dimension; null and
empty texts have no bytes and checksum 0; repeated rows get slots of their own;
fewer rows than shards leave the last shards empty; an empty table gives no
rows; other columns pass through untouched if asked for in ``keep``.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import materialize

BITS = 8
#: relative error of the quantile cuts
ACCURACY = 4096
LEAST = -(1 << 63)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``cells`` (n x dimensions, below
    2^bits): Skilling's transpose, then the bits of all dimensions interleaved."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for d in range(dims):
            turned = (x[:, d] & q) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            x[:, d] ^= swap
        q >>= 1
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[:, dims - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip[:, None]
    out = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[:, d] >> b) & 1)
    return out


def ordinal(docs: DataFrame, name: str) -> Column:
    """A dimension as a value that keeps its order (null: least): bytes of a string, else an integer."""
    if isinstance(docs.schema[name].dataType, StringType):
        return F.coalesce(F.col(name), F.lit("")).cast("binary")
    return F.coalesce(F.col(name).cast("long"), F.lit(LEAST))


def string_cuts(wide: DataFrame, name: str, cells: int) -> list[bytes]:
    """Ascending least values of the cells; a value belongs to the cell where its rows begin in the order of all."""
    counts = materialize(wide.groupBy(F.col(name).alias("v")).agg(F.count("*").alias("n")), "strings")
    parts = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(counts.repartitionByRange(parts, "v").sortWithinPartitions("v").withColumn("part", F.spark_partition_id()), "string-order")
    totals = sorted(placed.groupBy("part").agg(F.sum("n")).collect())        # one row a partition of the sort
    if not totals:
        return []
    sums = np.cumsum([n for _, n in totals]).tolist()
    before = wide.sparkSession.createDataFrame([(p, s - n) for (p, n), s in zip(totals, sums)], "p int, before long")
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    seen = placed.withColumn("upto", upto).join(F.broadcast(before), F.col("part") == F.col("p"))
    cell = seen.select("v", F.floor((F.col("before") + F.col("upto")) * cells / F.lit(sums[-1])).alias("cell"))
    return sorted(bytes(r.v) for r in cell.groupBy("cell").agg(F.min("v").alias("v")).collect())


def curve_index(docs: DataFrame, dimensions: list[str], bits: int = BITS) -> tuple[DataFrame, list[str]]:
    """``docs`` with ``__hilbert``; cuts are one small aggregate over the table."""
    if len(dimensions) * bits > 62:
        raise ValueError("dimensions * bits must stay below 63")
    names = [f"__dim{k}" for k in range(len(dimensions))]
    wide = docs.select("*", *[ordinal(docs, d).alias(n) for d, n in zip(dimensions, names)])
    points = [k / (1 << bits) for k in range(1, 1 << bits)]
    strings = [isinstance(docs.schema[d].dataType, StringType) for d in dimensions]
    row = wide.agg(F.count("*"), *[F.percentile_approx(n, points, ACCURACY).alias(n) for n, s in zip(names, strings) if not s]).first()
    cuts = [string_cuts(wide, n, 1 << bits)[1:] if s else np.unique(np.array(row[n] or [], np.int64)) for n, s in zip(names, strings)]

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        cells = np.column_stack([v.map(lambda x, c=c: bisect_right(c, bytes(x))).to_numpy(np.int64) if s else np.searchsorted(c, v.to_numpy(), "right")
                                 for c, v, s in zip(cuts, columns, strings)])
        return pd.Series(hilbert(cells, bits))

    return wide.withColumn("__hilbert", index(*names)), names


def shard(docs: DataFrame, dimensions: list[str], shards: int, keep: list[str], id_col: str = "doc_id", bits: int = BITS) -> DataFrame:
    """``keep`` columns, ``law``, ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    needed = list(dict.fromkeys([*keep, *dimensions, id_col]))
    narrow = materialize(docs.select(*needed), "shard-rows")
    indexed, extra = curve_index(narrow, dimensions, bits)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # repeated rows are equal in every column, so any order of theirs is the same order
    order = ["__hilbert", id_col, *[c for c in needed if c != id_col]]
    placed = (indexed.drop(*extra).repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("__at", F.monotonically_increasing_id()))
    placed = materialize(placed, "shard-order").withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy(F.col("__part").alias("p")).agg(F.count("*").alias("n"))
    # one row a partition of the sort: bounded by its number of partitions
    before = sizes.select("p", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                          F.sum("n").over(Window.partitionBy()).alias("total"))
    ranked = placed.join(F.broadcast(before), F.col("__part") == F.col("p")).withColumn("__rank", F.col("before") + F.col("__at").bitwiseAND((1 << 33) - 1))
    number = F.expr(f"cast(__rank * {shards} div total as int)")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (ranked.withColumn("shard", number).withColumn("slot", (F.col("__rank") - first).cast("long"))
            .select(*keep, F.lit("rows").alias("law"), "shard", "slot"))


def manifest(sharded: DataFrame, dimensions: list[str]) -> DataFrame:
    """Rows, least and greatest value of each dimension: what prunes shards."""
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), *[f(d).alias(f"{n}_{d}") for d in dimensions for n, f in (("min", F.min), ("max", F.max))])


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
