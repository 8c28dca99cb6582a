"""Operator 1: benchmark decontamination.

Seeds are the word pairs of the test items.  An alignment that scores a share s of
the whole item holds at least T = (2s - 1) * length - 1 pairs of the item: each of
its R runs of equal words but the first costs one edit, so 2 * matches - (R - 1)
>= 2 * s * length, and the runs hold matches - R pairs.  A first pass counts every
pair over the whole corpus.  Of T pairs one is not among the T - 1 most frequent
ones of the item; the others are its rare seeds, and no leak lacks them all.  A
second pass joins passages and items on rare seeds; where at least T pairs of the
item stand in the window around them, the Smith-Waterman alignment of the window
with the item scores verbatim, edited and partly rewritten copies alike.  So the
seeds and the count lose no alignment, however often an item has leaked.

Words are compared in lower case without punctuation at either end; words of
punctuation only are left out of positions.

Scale: both passes are maps over the texts; only counts per seed and the found
leaks are shuffled, so neither a hot source nor a hot passage meets in one task.
The items are broadcast in blocks of about ``BLOCK_WORDS`` words, one pair of
passes a block, whatever the size of the benchmark.

Defined results: null and empty texts or items match nothing, nor do items of
fewer than two words; a document has one row for each item it leaks (its
best alignment; the first of equal ones); rows with a null doc_id are reported
with it; repeated rows give one row for each doc_id and item; other columns are
not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_keyed, words_col

MATCH, MISMATCH, GAP = 2, -1, -1
#: least score, as a share of the score of the whole item
SIMILARITY = 0.6
BLOCK_WORDS = 1_000_000
LOT_DOCS = 400
MEMORY = 1 << 19
FOUND = "doc_id long, item_id long, first long, past long, score long, similarity double"
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_ASCII_EDGES = bytes(c for c in range(128) if not chr(c).isalnum())


def normal(word: str) -> str:
    """Lower case, without what is neither letter nor digit at either end."""
    word = word.lower()
    return word if word[:1].isalnum() and word[-1:].isalnum() else _EDGES.sub("", word)


class Vocabulary(dict):
    """Raw word -> id of its normal form: 0 if no item has it, -1 for punctuation only."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}

    def __missing__(self, raw: bytes) -> int:
        word = raw.strip(_ASCII_EDGES).lower() if raw.isascii() else normal(raw.decode()).encode()
        out = self.ids.get(word, 0) if word else -1
        if len(raw) <= 64:
            if len(self) >= MEMORY:
                self.clear()
            self[raw] = out
        return out

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().split()
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return ids[ids >= 0]


class Items:
    """Seeds of a block of test items."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        self.vocabulary = Vocabulary()
        ids = self.vocabulary.ids
        self.item_ids, self.words = [], []
        for item, text in rows:
            words = [w.encode() for raw in (text or "").encode().split() if (w := normal(raw.decode()))]
            if len(words) > 1:
                self.item_ids.append(item)
                self.words.append(np.array([ids.setdefault(w, len(ids) + 1) for w in words], np.int64))
        self.base = np.int64(len(ids) + 1)
        grams = [(key, k, at) for k, w in enumerate(self.words) for at, key in enumerate(self.keys(w).tolist())]
        grams.sort()
        self.key, self.item, self.at = (np.array([g[c] for g in grams], np.int64) for c in range(3))
        self.seeds, self.begin = np.unique(self.key, return_index=True)
        self.end = np.r_[self.begin[1:], len(self.key)]
        self.rare = np.ones(len(self.key), bool)
        self.name = uuid.uuid4().hex

    def keys(self, words: np.ndarray) -> np.ndarray:
        return words[:-1] * self.base + words[1:]

    def hits(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of seeds in a sequence (0: a word of no item), and which seeds."""
        if len(flat) < 2 or not len(self.seeds):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero((flat[:-1] > 0) & (flat[1:] > 0))
        key = flat[at] * self.base + flat[at + 1]
        slot = np.minimum(np.searchsorted(self.seeds, key), len(self.seeds) - 1)
        real = self.seeds[slot] == key
        return at[real], slot[real]

    def keep_rare(self, counts: np.ndarray, similarity: float) -> None:
        """Marks as rare all but the T - 1 most frequent seeds of each item."""
        length = np.array([len(w) for w in self.words], np.int64)
        self.least = np.maximum(1, np.ceil((2 * similarity - 1) * length - 1 - 1e-9)).astype(np.int64)
        if len(self.key):
            often = counts[np.searchsorted(self.seeds, self.key)]
            order = np.lexsort((self.at, -often, self.item))
            first = np.searchsorted(self.item[order], self.item[order])
            self.rare[order] = np.arange(len(order)) - first >= self.least[self.item[order]] - 1


def align(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of ``item`` against each row of ``windows``, and where it ends."""
    ramp = np.arange(windows.shape[1] + 1, dtype=np.int32) * -GAP
    before = np.zeros((len(windows), windows.shape[1] + 1), np.int32)
    best, end = np.zeros(len(windows), np.int32), np.zeros(len(windows), np.int64)
    for word in item:
        now = np.zeros_like(before)
        step = before[:, :-1] + np.where(windows == word, MATCH, MISMATCH)
        now[:, 1:] = np.maximum(np.maximum(step, before[:, 1:] + GAP), 0)
        now = np.maximum.accumulate(now + ramp, axis=1) - ramp
        at = now.argmax(1)
        score = now[np.arange(len(now)), at]
        better = score > best
        best[better], end[better] = score[better], at[better]
        before = now
    return best, end


#: name of a block of items -> what this worker remembers of its words, kept from the first pass to the second
_REMEMBERED: dict[str, Vocabulary] = {}


def lot_words(items: Items, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of a lot of texts, a 0 after each, and where each begins."""
    if items.name not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[items.name] = items.vocabulary
    words = [_REMEMBERED[items.name].of(t) for t in texts]
    sizes = np.array([len(w) + 1 for w in words])
    begin = np.r_[0, np.cumsum(sizes)]
    flat = np.zeros(begin[-1], np.int64)
    for w, at in zip(words, begin):
        flat[at:at + len(w)] = w
    return flat, begin


def leaks(items: Items, ids: list[int | None], texts: list[str | None], similarity: float) -> Iterator[tuple]:
    """Rows of FOUND for a lot of documents."""
    flat, begin = lot_words(items, texts)
    at, slot = items.hits(flat)
    if not len(at):
        return
    many = items.end[slot] - items.begin[slot]
    entry = np.repeat(items.begin[slot] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
    at = np.repeat(at, many)
    doc, item = np.searchsorted(begin, at, "right") - 1, items.item[entry]
    place = (doc * len(items.words) + item) * (len(flat) + 1)
    every = np.sort(place + at)                             # all hits by document, item and position
    rare = items.rare[entry]
    at, doc, item, place, diagonal = at[rare], doc[rare], item[rare], place[rare], (at - items.at[entry])[rare]
    if not len(at):
        return
    order = np.lexsort((diagonal, item, doc))
    doc, item, place, diagonal = doc[order], item[order], place[order], diagonal[order]
    length = np.array([len(w) for w in items.words])[item]
    pad = length - length // 5                              # an alignment has at most 0.8 edits a word of its item
    new = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > np.maximum(4, length[1:] // 4))]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(new)] - 1
    low = np.maximum(begin[doc[first]], diagonal[first] - pad[first])
    high = np.minimum(begin[doc[first] + 1] - 1, diagonal[last] + length[first] + pad[first])
    pairs = np.searchsorted(every, place[first] + high) - np.searchsorted(every, place[first] + low)
    windows: dict[int, list[tuple[int, int, int]]] = {}
    for a in np.flatnonzero(pairs >= items.least[item[first]]).tolist():
        windows.setdefault(int(item[first[a]]), []).append((int(doc[first[a]]), int(low[a]), int(high[a])))
    for k, found in windows.items():
        found.sort(key=lambda w: w[2] - w[1])
        for s in range(0, len(found), 256):
            lot = found[s:s + 256]
            wide = max(h - l for _, l, h in lot)
            grid = np.zeros((len(lot), wide), np.int64)
            for r, (_, low, high) in enumerate(lot):
                grid[r, :high - low] = flat[low:high]
            score, end = align(items.words[k], grid)
            good = np.flatnonzero(score >= similarity * MATCH * len(items.words[k]))
            if len(good):
                _, back = align(items.words[k][::-1], grid[good][:, ::-1])
                for r, b in zip(good.tolist(), back.tolist()):
                    d, low, _ = lot[r]
                    yield (ids[d], items.item_ids[k], low + wide - b - int(begin[d]), low + int(end[r]) - int(begin[d]), int(score[r]), float(score[r]) / (MATCH * len(items.words[k])))


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document and test item that it contains: ``FOUND``."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.size(words_col(F.col("text"))))).first()[0] or 0
    blocks = int(size // block_words) + 1
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    out = None
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().orderBy("item_id", "text")
        held = Items([tuple(r) for r in mine.collect()])
        shipped = spark.sparkContext.broadcast(held)
        counts = np.zeros(len(held.seeds), np.int64)
        for slot, n in narrow.select("text").mapInArrow(_counter(shipped), "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():
            counts[slot] = n
        held.keep_rare(counts, similarity)
        found = narrow.mapInArrow(_finder(spark.sparkContext.broadcast(held), similarity), FOUND)
        out = found if out is None else out.union(found)
    row = F.struct("score", (-F.col("first")).alias("late"), "first", "past", "similarity")
    best = out.groupBy("doc_id", "item_id").agg(F.max(row).alias("best"))
    return best.select("doc_id", "item_id", "best.first", "best.past", "best.score", "best.similarity")


def _counter(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shipped.value
        total = np.zeros(len(items.seeds), np.int64)
        for batch in batches:
            for part in (batch.slice(k, LOT_DOCS) for k in range(0, batch.num_rows, LOT_DOCS)):
                _, slot = items.hits(lot_words(items, part.column(0).to_pylist())[0])
                total += np.bincount(slot, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["slot", "n"])
    return run


def _finder(shipped, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shipped.value
        for batch in batches:
            for part in (batch.slice(k, LOT_DOCS) for k in range(0, batch.num_rows, LOT_DOCS)):
                rows = list(leaks(items, part.column(0).to_pylist(), part.column(1).to_pylist(), similarity))
                cols = list(zip(*rows)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [*[pa.int64()] * 5, pa.float64()])], ["doc_id", "item_id", "first", "past", "score", "similarity"])
    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame, max_broadcast: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows that contain a test item (row by row, also where ids are null or repeated)."""
    docs, _ = row_keyed(docs, "__at")
    gone = materialize(find_leaks(docs.select(F.col("__at").alias("doc_id"), "text"), benchmark).select("doc_id").distinct(), "leaks")
    gone = gone.withColumnRenamed("doc_id", "__leak")
    return docs.join(F.broadcast(gone) if gone.count() <= max_broadcast else gone, F.col("__at") == F.col("__leak"), "left_anti").drop("__at")
