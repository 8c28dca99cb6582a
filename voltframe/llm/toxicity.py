"""Operator 9: toxicity severity by cumulative-link ordinal regression.

P(grade > k) = sigmoid(score - cut_k) for k = 0 .. K-2: one weight vector serves
all ordered cuts, and the expected severity is the sum of these probabilities.
The score is a sum of weights over the distinct words of a text, hashed to
``2^HASH_BITS`` slots.  A slot's weight is a scale times a trained factor: the
scale says by how many standard errors, over one, the slot's training rows are
above or below the common share of toxic rows, and is 0 for slots of one row, so
the many words that say nothing cannot add up.  The factors are L2-penalised and
trained by full-batch gradient steps (Adam) on the penalised likelihood.

The labels say toxic or not and good or poor quality; grades are 0 (not toxic),
1 (toxic, good quality otherwise) and 2 (toxic and poor).  Where a grade has no
examples its cut runs to the far end and its probability to 0.

A text counts as toxic where its score passes the first cut moved by a margin,
which makes the fewest errors on training rows that are held out in turn.

Training takes a bounded sample: ``MAX_TRAIN`` labelled rows, the least by a
hash of their id (all rows where there are fewer).  Scoring reads whole texts in
map tasks with the broadcast weights (fixed size), without a shuffle.

Defined results: null and empty texts have score 0; labels without a document
or with a null id or label are not trained on; without any labelled row every
severity is 0; repeated rows are scored alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_BITS, MAX_TRAIN = 18, 8000
STEPS, RATE, PENALTY, FOLDS = 150, 0.1, 3e-3, 5
MEMORY = 1 << 19
EDGES = b".,;:!?\"'()[]{}<>|*#$%&-_/\\"


class Slots(dict):
    """Raw word -> slot (lower case, no punctuation at the ends), bounded memory."""

    def __missing__(self, raw: bytes) -> int:
        slot = xxhash.xxh3_64_intdigest(raw.decode().lower().encode().strip(EDGES)) & ((1 << HASH_BITS) - 1)
        if len(raw) <= 64:
            if len(self) >= MEMORY:
                self.clear()
            self[raw] = slot
        return slot


def features(text: str | None, slots: Slots) -> np.ndarray:
    return np.unique(np.array([slots[w] for w in set((text or "").encode().split())], np.int64))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def slot_scales(rows: list[np.ndarray], grades: np.ndarray) -> np.ndarray:
    """How far, in standard errors over one, the share of grades above 0 among each
    slot's rows is from the share among all; 0 for slots of fewer than two rows."""
    dim = 1 << HASH_BITS
    if not len(rows):
        return np.zeros(dim)
    seen = np.bincount(np.concatenate(rows).astype(np.int64), minlength=dim)
    marked = np.bincount(np.concatenate([r[:0] if not g else r for r, g in zip(rows, grades)]).astype(np.int64), minlength=dim)
    share = (grades > 0).mean()
    error = np.sqrt(seen * share * (1 - share) + 0.5)
    return np.where(seen > 1, np.maximum(np.abs(marked - seen * share) / error - 1, 0), 0)


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY,
        scales: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights (scale times factor) and ascending cuts that maximise the likelihood with penalised factors."""
    dim = 1 << HASH_BITS
    if not len(rows):
        return np.zeros(dim), np.full(n_grades - 1, 40.0)
    scales = np.ones(dim) if scales is None else scales
    owner, slot = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows).astype(np.int64)
    owner, slot = owner[scales[slot] > 0], slot[scales[slot] > 0]
    value = scales[slot]
    share = np.array([(grades > k).mean() for k in range(n_grades - 1)]).clip(1e-4, 1 - 1e-4)
    first = np.log((1 - share) / share)
    # cuts are the first one and positive gaps, so they stay in order
    theta = np.concatenate([np.zeros(dim), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v, n = np.zeros_like(theta), np.zeros_like(theta), len(rows)
    for step in range(1, steps + 1):
        w, gaps = theta[:dim], np.exp(theta[dim + 1:])
        cuts = theta[dim] + np.r_[0, np.cumsum(gaps)]
        score = np.bincount(owner, w[slot] * value, n)
        above = sigmoid(score[:, None] - np.r_[-np.inf, cuts, np.inf][None, :])      # P(grade > k-1), k = 0 .. K
        hi, lo = above[np.arange(n), grades], above[np.arange(n), grades + 1]
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        d_score = -(d_hi - d_lo) / n
        d_cut = np.array([(d_hi[grades == k + 1].sum() - d_lo[grades == k].sum()) for k in range(n_grades - 1)]) / n
        tail = np.cumsum(d_cut[::-1])[::-1]
        grad = np.concatenate([np.bincount(slot, d_score[owner] * value, dim) + penalty * w, tail[:1], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:dim] * scales, theta[dim] + np.r_[0, np.cumsum(np.exp(theta[dim + 1:]))]


def margin(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, folds: int = FOLDS) -> float:
    """By how much to move the first cut: the middle of the range that makes the
    fewest errors on rows scored by fits without their fold (folds by grade)."""
    if len(set(grades.tolist())) < 2 or len(rows) < 2 * folds:
        return 0.0
    order = sorted(range(len(rows)), key=lambda k: (grades[k], rows[k].tobytes()))
    fold = np.empty(len(rows), int)
    fold[order] = np.arange(len(rows)) % folds
    gaps = np.zeros(len(rows))
    for f in range(folds):
        known = [r for r, k in zip(rows, fold) if k != f]
        weights, cuts = fit(known, grades[fold != f], n_grades, scales=slot_scales(known, grades[fold != f]))
        for k in np.flatnonzero(fold == f):
            gaps[k] = weights[rows[k]].sum() - cuts[0]
    order = np.argsort(gaps, kind="stable")
    gaps, toxic = gaps[order], grades[order] > 0
    errors = np.r_[(~toxic).sum(), (~toxic).sum() + np.cumsum(np.where(toxic, 1, -1))]      # the k lowest count as clean
    best = np.flatnonzero(errors == errors.min())
    k = int(best[len(best) // 2])
    return float((gaps[max(k - 1, 0)] + gaps[min(k, len(gaps) - 1)]) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and grades of the bounded sample (at most ``most`` rows reach the driver, as the slots that scoring reads)."""
    marked = (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots()
        for batch in batches:
            found = [features(t.as_py(), slots).astype("<i8").tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["toxic", "quality", "slots"])

    found = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").select(F.col("toxic").cast("long"), F.col("quality").cast("long"), "text")
    rows, grades = [], []
    for r in found.mapInArrow(run, "toxic long, quality long, slots binary").toLocalIterator():
        rows.append(np.frombuffer(r.slots, "<i8"))
        grades.append(0 if not r.toxic else 1 if r.quality != 0 else 2)
    return rows, np.array(grades, np.int64)


def severity(docs: DataFrame, weights: np.ndarray, cuts: np.ndarray, id_col: str = "doc_id", text_col: str = "text", moved: float = 0.0) -> DataFrame:
    """id, score, p_above (array), severity (expected grade), grade (most cuts passed), toxic (first cut, ``moved``, passed)."""
    shipped = docs.sparkSession.sparkContext.broadcast((weights, cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, c = shipped.value
        slots = Slots()
        for batch in batches:
            score = np.array([w[features(t.as_py(), slots)].sum() if t.is_valid else 0.0 for t in batch.column(1)], np.float64)
            above = sigmoid(score[:, None] - c[None, :])
            grade = (above > 0.5).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(list(above), pa.list_(pa.float64())), pa.array(above.sum(1)),
                                              pa.array(grade.astype(np.int32)), pa.array(score > c[0] + moved)], ["id", "score", "p_above", "severity", "grade", "toxic"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, score double, p_above array<double>, severity double, grade int, toxic boolean")
    return out.withColumnRenamed("id", id_col)


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    rows, grades = training_rows(docs, labels, most)
    return severity(docs, *fit(rows, grades, 3, scales=slot_scales(rows, grades)), moved=margin(rows, grades, 3))
