"""Corpus pipeline: the stages that turn documents into training tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents:

1. quality rules: documents that fail the base rule or a threshold go;
2. line dedup: boilerplate lines of a source go from its documents;
3. MinHash near-dedup (five-word shingles, similarity 0.8): of each group the
   document with the least id stays, and documents without words stay;
4. benchmark decontamination: documents that contain a test item go;
5. BPE encoding and decoding: ids and their decoded text.

Every row is a document of its own, also where its doc_id is null or stands on
other rows: stages 1, 3 and 4 take rows out by ``common.row_keyed``, never by a
shared id.  In stage 3 rows are ordered by doc_id (null: last), then text.  All
columns may be null.  Columns beside those of documents pass through stages 1-4.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm import bpe, decontam, lines, minhash, quality
from voltframe.llm.common import row_keyed
from voltframe.session import ensure_checkpoint_dir, scratch_path

#: words of a shingle in the near-duplicate stage
SHINGLE = 5
#: ids that are broadcast at most
MAX_BROADCAST_IDS = 1_000_000


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` without a ``__row`` among those of ``keys``."""
    keys = keys.select(F.col("__row").alias("__gone"))
    keys = F.broadcast(keys) if keys.count() <= MAX_BROADCAST_IDS else keys
    return docs.join(keys, F.col("__row") == F.col("__gone"), "left_anti").drop("__row")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, _ = row_keyed(docs)
    judged = quality.judge(docs.select("__row", "lang", "source", "text"))
    return _without(docs, judged.filter(~F.col("kept")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, _ = row_keyed(docs, ordered=("doc_id", "text"))
    groups = minhash.near_groups(docs.select(F.col("__row").alias("doc_id"), "text"), width=SHINGLE)
    return _without(docs, groups.filter(~F.col("kept")).select(F.col("doc_id").alias("__row")))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit integers), decoded."""
    from voltframe.llm.queries import word_bpe_path

    out = bpe.encode_documents(docs, word_bpe_path())
    return out.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", token_stage),
]

#: links between near copies and alignments have no practical SQL form; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder."""
    import uuid

    ensure_checkpoint_dir(spark)
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = os.path.join(base, str(k))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
