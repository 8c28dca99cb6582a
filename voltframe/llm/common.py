"""Helpers shared by the training-data operators.

A *word* is a maximal run of characters other than space and the ASCII
controls 0x09-0x0D; ``bytes.split()`` cuts at exactly those six bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from voltframe.session import materialize  # noqa: F401  (used by the operators)

#: words that a worker remembers before it starts its memory anew
WORD_MEMORY = 1 << 19


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words_col(text: Column) -> Column:
    """Array of the words of ``text`` (null text: empty array), JVM side."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\u000b\f\r", "     ")
    return F.array_remove(F.split(spaced, " "), "")


def one_per_id(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows without an id are no documents and go; of rows that share an id the
    one with the smallest text stays (a null text is smallest).

    The test for repeats reads the id column alone; texts are only shuffled
    when a repeat exists.
    """
    docs = docs.filter(F.col(key).isNotNull())
    if docs.groupBy(key).count().filter("count > 1").isEmpty():
        return docs
    rest = [c for c in docs.columns if c not in (key, "text")]
    row = F.struct("text", *rest)
    return docs.groupBy(key).agg(F.min(row).alias("__row")).select(key, "__row.*").select(*docs.columns)


def row_keyed(docs: DataFrame, key: str = "__row", ordered: tuple[str, ...] = ()) -> tuple[DataFrame, bool]:
    """``docs`` with a long ``key`` of its own for each row, and whether that is the doc_id.

    Where no doc_id is null or repeated, it is the doc_id; else rows are numbered
    in a written table, by the columns ``ordered`` (nulls last) if any are given.
    """
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        ids = docs.select("doc_id")
        if ids.filter("doc_id is null").isEmpty() and ids.groupBy("doc_id").count().filter("count > 1").isEmpty():
            return docs.withColumn(key, F.col("doc_id").cast("long")), True
    if ordered:
        order = [F.col(c).asc_nulls_last() for c in ordered]
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        docs = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), False


class WordHashes(dict):
    """bytes -> 64-bit hash, remembered up to ``WORD_MEMORY`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMORY:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64), element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
