"""Operator 7: removal of passages that repeat anywhere in the corpus.

Every window of ``WINDOW`` words gets a Rabin-Karp hash (prefix sums modulo
2^64 over 64-bit word hashes, with an odd base whose powers have inverses).
The hashes are dealt out and counted in Spark; a window whose words also start
earlier is removed, and removed windows merge into maximal intervals.

How the hashes travel: windows that share the least hash of their ``GRAM``-word
parts stand in runs, and equal windows have equal least parts; so a run is sent
as (least part, doc_id, start, length) and six bytes of each window hash, to
the bucket of its least part.  Before that each task keeps one copy, the first,
of every window it meets in a batch of ``BATCH_WORDS`` words, so a passage in a
third of all documents costs a bucket one entry a batch.  Different windows may
share a least part without limit (unique words around a frequent phrase), so a
first pass counts the windows to be sent for each cell of least parts; those of
a heavy cell are dealt by their own hash, where equal windows still meet.  Two
windows count as equal if 48 bits of their hashes and 64 bits of the least parts
are equal.

Scale: the number of buckets follows the characters of the corpus and no cell
adds more than a mean bucket to one, so a bucket stays at some ten MB; the heavy
cells, no more than there are buckets, are broadcast.  Intervals are at most a
few a document.  The texts are read twice and shuffled once, to meet their
intervals.

Defined results: null and empty texts have no words and no removals; texts
shorter than a window lose nothing; of equal windows the first by (doc_id,
start) stays, overlapping repeats within a text included; rows without doc_id
(last) and rows that share one (by text) are documents of their own, as in
``common.row_keyed``; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, materialize, mix, row_keyed

WINDOW, GRAM = 20, 6
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: words that a task hashes at once, and characters of the corpus for each bucket
BATCH_WORDS, BUCKET_CHARS = 1_000_000, 12_000_000
BUCKETS_PER_PARTITION = 3
#: cells of least parts for each bucket, and windows that make a cell heavy at least
CELLS_PER_BUCKET, HEAVY = 8, 10_000
RUNS = "bucket int, local boolean, docs binary, starts binary, sizes binary, least binary, hashes binary"


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def window_hashes(words: np.ndarray, size: int, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Hash of each ``size`` consecutive words of one long sequence."""
    n = len(words)
    if n < size:
        return np.zeros(0, np.uint64)
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=upto[1:], dtype=np.uint64)
    return mix((upto[size:] - upto[:-size]) * down[: n - size + 1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x, have = np.minimum(x[:-step], x[step:]), have + step
    return x


def intervals(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merged word intervals of rows sorted by (doc, start) with ascending ends."""
    if not len(docs):
        return docs, starts, ends
    new = np.r_[True, (docs[1:] != docs[:-1]) | (starts[1:] > ends[:-1])]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(docs) - 1]
    return docs[new], starts[new], ends[last]


class Hasher:
    """Runs of the windows of a batch of documents."""

    def __init__(self, buckets: int, window: int, heavy: np.ndarray | None = None):
        self.buckets, self.window, self.gram = buckets, window, min(GRAM, window)
        self.heavy = np.zeros(0, np.int64) if heavy is None else heavy
        self.known, self.up, self.down = WordHashes(), np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def cells(self, least: np.ndarray) -> np.ndarray:
        """Cell of each least part."""
        return (mix(least ^ INVERSE) % np.uint64(CELLS_PER_BUCKET * self.buckets)).astype(np.int64)

    def windows(self, ids: list[int], words: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Ids ascending; hash, least part, document and start of each window; which are copies of earlier ones."""
        by_id = np.argsort(np.array(ids, np.int64), kind="stable")
        ids = np.array(ids, np.int64)[by_id]
        sizes = np.array([len(words[k]) for k in by_id], np.int64)
        flat = np.concatenate([words[k] for k in by_id])
        if len(flat) > len(self.up):
            self.up, self.down = powers(BASE, len(flat)), powers(INVERSE, len(flat))
        full = window_hashes(flat, self.window, self.up, self.down)
        least = sliding_min(window_hashes(flat, self.gram, self.up, self.down), self.window - self.gram + 1)
        doc = np.repeat(np.arange(len(ids)), sizes)[: len(full)]
        begin = np.r_[0, np.cumsum(sizes)[:-1]]
        at = np.flatnonzero(np.arange(len(full)) - begin[doc] <= sizes[doc] - self.window)
        full, least, doc = full[at], least[at], doc[at]
        start = at - begin[doc]
        order = np.argsort(full, kind="stable")
        again = np.zeros(len(full), bool)
        again[order[1:]] = (full[order[1:]] == full[order[:-1]]) & (least[order[1:]] == least[order[:-1]])
        return ids, full, least, doc, start, again

    def counts(self, ids: list[int], words: list[np.ndarray]) -> pa.RecordBatch:
        """Windows that ``rows`` sends for each cell."""
        _, _, least, _, _, again = self.windows(ids, words)
        cell, n = np.unique(self.cells(least[~again]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n.astype(np.int64))], ["cell", "n"])

    def rows(self, ids: list[int], words: list[np.ndarray]) -> pa.RecordBatch:
        ids, full, least, doc, start, again = self.windows(ids, words)
        gone = intervals(doc[again], start[again], start[again] + self.window)
        out = [(int(ids[0] % self.buckets) if len(ids) else 0, True, ids[gone[0]].tobytes(), gone[1].astype("<u4").tobytes(), (gone[2] - gone[1]).astype("<u4").tobytes(), b"", b"")] if len(gone[0]) else []
        kept = np.flatnonzero(~again)
        full, least, doc, start = full[kept], least[kept], doc[kept], start[kept]
        if len(kept):
            new = np.r_[True, (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)]
            if len(self.heavy):
                alone = np.isin(self.cells(least), self.heavy)
                new |= alone
            first = np.flatnonzero(new)
            length = np.diff(np.r_[first, len(full)])
            dealt = np.where(alone[first], mix(least[first] ^ full[first]), least[first]) if len(self.heavy) else least[first]
            bucket = (mix(dealt ^ BASE) % np.uint64(self.buckets)).astype(np.int64)
            turn = np.argsort(bucket, kind="stable")
            first, length, bucket = first[turn], length[turn], bucket[turn]
            take = np.repeat(first - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(len(full))
            six = full[take].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            cut = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
            ends = np.r_[0, np.cumsum(length)]
            for a, b in zip(cut[:-1], cut[1:]):
                f = first[a:b]
                out.append((int(bucket[a]), False, ids[doc[f]].tobytes(), start[f].astype("<u4").tobytes(), length[a:b].astype("<u4").tobytes(), least[f].tobytes(), six[ends[a]:ends[b]].tobytes()))
        kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)], ["bucket", "local", "docs", "starts", "sizes", "least", "hashes"])


def _joined(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def repeats(table: pa.Table, window: int) -> pa.Table:
    """Intervals of the later copies among the runs of one bucket, and those its tasks found."""
    local = table.filter(table.column("local"))
    sent = table.filter(pa.compute.invert(table.column("local")))
    docs, starts, sizes = (_joined(sent, c, k) for c, k in (("docs", "<i8"), ("starts", "<u4"), ("sizes", "<u4")))
    least, six = _joined(sent, "least", "<u8"), _joined(sent, "hashes", np.uint8).reshape(-1, 6)
    first = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    order = np.lexsort((starts, docs))
    docs, starts, sizes, least, first = docs[order], starts[order].astype(np.int64), sizes[order].astype(np.int64), least[order], first[order]
    step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :6] = six
    hashes = wide.view("<u8").ravel()[np.repeat(first, sizes) + step]
    run = np.repeat(np.arange(len(docs)), sizes)
    del wide, six
    key = mix(hashes ^ least[run])
    by = np.argsort(key, kind="stable")
    later = by[1:][(key[by[1:]] == key[by[:-1]]) & (hashes[by[1:]] == hashes[by[:-1]]) & (least[run[by[1:]]] == least[run[by[:-1]]])]
    later.sort()
    at = starts[run[later]] + step[later]
    found = intervals(docs[run[later]], at, at + window)
    mine = [_joined(local, c, k).astype(np.int64) for c, k in (("docs", "<i8"), ("starts", "<u4"), ("sizes", "<u4"))]
    return pa.table({"doc_id": np.r_[found[0], mine[0]], "first": np.r_[found[1], mine[1]], "past": np.r_[found[2], mine[1] + mine[2]]})


def repeated_spans(docs: DataFrame, window: int = WINDOW, least_heavy: int = HEAVY) -> DataFrame:
    """``doc_id`` and ``spans`` (array of word intervals first, past; sorted, they
    may overlap) of the documents that repeat earlier windows; one row a doc_id expected."""
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), chars // BUCKET_CHARS)

    def batched(batches: Iterator[pa.RecordBatch], hasher: Hasher, each) -> Iterator[pa.RecordBatch]:
        ids, words, held = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = (text.as_py() or "").encode().split()
                if len(found) >= window:
                    ids.append(i)
                    words.append(hasher.known.of(found))
                    held += len(found)
                    if held >= BATCH_WORDS:
                        yield each(ids, words)
                        ids, words, held = [], [], 0
        if ids:
            yield each(ids, words)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(buckets, window)
        yield from batched(batches, hasher, hasher.counts)

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    cells = materialize(narrow.mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")), "cells")
    most = max(least_heavy, (cells.agg(F.sum("n")).first()[0] or 0) // buckets)
    shipped = spark.sparkContext.broadcast(np.array([r.cell for r in cells.filter(F.col("n") > most).collect()], np.int64))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(buckets, window, shipped.value)
        yield from batched(batches, hasher, hasher.rows)

    sent = narrow.mapInArrow(runs, RUNS)
    found = sent.groupBy("bucket").applyInArrow(lambda t: repeats(t, window), "doc_id long, first long, past long")
    return found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("first", "past"))).alias("spans"))


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by one space)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 500) for k in range(0, batch.num_rows, 500)):
                total, removed, kept = [], [], []
                for text, gone in zip(part.column(1), part.column(2)):
                    words = (text.as_py() or "").encode().split()
                    left, done = [], 0
                    for s in gone.as_py() or ():
                        left += words[done:max(done, s["first"])]
                        done = max(done, s["past"])
                    left += words[done:]
                    total.append(len(words))
                    removed.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    joined = docs.select(F.col("doc_id").cast("long"), "text").join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    docs, plain = row_keyed(docs.select("doc_id", "text"), ordered=("doc_id", "text"))
    names, docs = docs.select(F.col("__row").alias("__a"), F.col("doc_id").alias("__name")), docs.select(F.col("__row").alias("doc_id"), "text")
    out = cut(docs, repeated_spans(docs, window))
    if plain:
        return out
    return out.join(names, F.col("doc_id") == F.col("__a")).select(F.col("__name").alias("doc_id"), "n_words", "n_removed", "kept")
