"""Operator 13: source divergence audit.

``bytes.translate`` with one table lowers A-Z and blanks every other ASCII byte,
``bytes.split`` gives the terms and a Counter for each document their
frequencies.  A worker adds these up by (lang, source, term) before anything is
shuffled; from there on the counts are sparse rows.  A term of a language is
kept where enough of its documents hold it.  Each source has a smoothed share of
each kept term, in billionths and rounded down; two sources differ by the sum of
the differences of their shares, and a source is marked by the terms of which it
has more than its language.

Shares of absent terms are one number a source, so only terms that are present
are joined.  Pairs of sources are summed in blocks of terms by tiles of sources:
no task holds more than a block of cells and a tile of sums, and no pair is
emitted for each term.

Defined results: a null text, lang or source is ''; documents without terms
still make their group occur; a language without kept terms has differences of
0 and no terms; a source alone in its language has no pairs; ties are in order
of the UTF-8 bytes; repeated rows count as often as they occur; ids are not
read; an empty table gives an empty table; other columns are not read, so their
names cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.session import join_small

from . import common

#: documents of a language that must hold a term for it to be kept
MIN_DOCS = 30
SCALE, PRIOR = 1_000_000_000, 5
#: terms listed for each source
TOP_TERMS = 50
#: counted terms that a worker adds up before it hands them on
HELD_TERMS = 400_000
#: cells of a block of terms, sources of a tile, terms of a dense step
BLOCK_CELLS, TILE, STEP = 250_000, 256, 1024

#: one table for bytes.translate: letters lowered, other ASCII blanked, the rest as it is
TERM_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256))


def term_counts(text: bytes) -> Counter:
    return Counter(text.translate(TERM_BYTES).split())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple, tuple[dict, Counter]] = {}
    held = 0

    def handed_on():
        names = ["lang", "source", "term", "n", "docs"]
        for (lang, source), (counts, docs) in groups.items():
            size = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang), size + 1), pa.repeat(pa.scalar(source), size + 1),
                 pa.array([None, *counts], pa.binary()).cast(pa.string()), pa.array([0, *counts.values()], pa.int64()),
                 pa.array([0, *map(docs.__getitem__, counts)], pa.int64())], names)
        groups.clear()

    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            if (key := (lang, source)) not in groups:
                groups[key] = ({}, Counter())
                held += 1
            counts, docs = groups[key]
            found = term_counts(text.as_py() or b"")
            held -= len(counts)
            seen = counts.get
            for term, n in found.items():
                counts[term] = seen(term, 0) + n
            docs.update(found.keys())
            held += len(counts)
            if held > HELD_TERMS:
                yield from handed_on()
                held = 0
    yield from handed_on()


def source_terms(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences), ``docs``; a row with a
    null term says that the group occurs.  A written table."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], F.col("text"))
    counted = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return common.materialize(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "source-terms")


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * kept)); 0 where nothing is kept."""
    exact = lambda c: c.cast("decimal(19,0)")
    above = (exact(n) + F.lit(PRIOR)) * F.lit(SCALE).cast("decimal(10,0)")
    below = exact(total) + F.lit(PRIOR) * exact(kept)
    parts = F.struct(above.alias("above"), F.when(kept > 0, below).alias("below"))
    return F.coalesce(1 + F.call_function("div", parts["above"], parts["below"]), F.lit(0)).cast("long")


class Audit:
    """Kept terms, groups and shares of a table of documents."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        cells = source_terms(docs)
        terms = cells.filter(F.col("term").isNotNull())
        kept = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= min_docs)
        kept = common.materialize(kept.drop("docs"), "kept-terms")
        mine = common.materialize(terms.drop("docs").join(kept, ["lang", "term"]), "kept-cells")
        langs = kept.groupBy("lang").agg(F.count("term").alias("kept"), F.sum("lang_n").alias("lang_total"))
        sizes = mine.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("term").alias("cells"))
        groups = cells.filter(F.col("term").isNull()).select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.na.fill(0).withColumn("base", share(F.lit(0), F.col("total"), F.col("kept")))
        self.groups = common.materialize(groups, "groups")
        known = self.groups.select("lang", "source", "total", "kept", "lang_total")
        shares = join_small(mine, known, ["lang", "source"])
        self.cells = shares.select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
                                   share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))

    def marked_terms(self, most: int = TOP_TERMS) -> DataFrame:
        """Terms of which a source has more than its language, the largest excess first."""
        above = self.cells.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        return ranked(above).filter(F.col("rank") <= most)

    def source_pairs(self) -> DataFrame:
        """Every other source of each source's language, by the sum of differences."""
        plan = self.groups.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.sum("cells") / BLOCK_CELLS)).cast("int").alias("blocks"),
                                               F.ceil(F.count("source") / TILE).cast("int").alias("tiles"))
        known = join_small(self.groups.select("lang", "source", "base", "kept"), plan, "lang")
        known = known.withColumn("tile", F.pmod(F.xxhash64("source"), "tiles").cast("int"))
        known = common.materialize(known, "tiles")
        every = F.sequence(F.lit(0), F.col("blocks") - 1)
        bases = known.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("base").alias("p"), "kept", "tile", "tiles", F.explode(every).alias("block"))
        cells = join_small(self.cells.drop("q"), known.drop("base"), ["lang", "source"])
        cells = cells.select("lang", "source", "term", "p", "kept", "tile", "tiles", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"))
        rows = bases.unionByName(cells).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        rows = rows.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
        sums = rows.select("lang", "block", "low", "high", "source", "term", "p", "kept", "tile").groupBy("lang", "block", "low", "high").applyInPandas(
            _pair_sums, "lang string, source string, other string, value long")
        sums = sums.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
        both = F.explode(F.array(F.struct(F.col("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
        return ranked(sums.select("lang", both.alias("pair"), "value").select("lang", "pair.source", "pair.item", "value"))


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def _pair_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Differences of the sources of two tiles over one block of terms.  Terms that
    no source of the two tiles has are counted once, in block 0, by the base shares."""
    lang, block, low, high = key
    known = rows[rows.term.isna()]
    names, base, tile, kept = known.source.to_numpy(), known.p.to_numpy(np.int64), known.tile.to_numpy(), int(known.kept.iloc[0])
    left, right = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
    cells = rows[rows.term.notna()]
    column = pd.Series(np.arange(len(names)), names).reindex(cells.source).to_numpy()
    line, terms = pd.factorize(cells.term)
    order = np.argsort(line, kind="stable")
    line, column, p = line[order], column[order], cells.p.to_numpy(np.int64)[order]
    absent = (kept if block == 0 else 0) - len(terms)
    sums = absent * np.abs(base[left, None] - base[right])
    for first in range(0, len(terms), STEP):
        a, b = np.searchsorted(line, (first, first + STEP))
        dense = np.tile(base, (min(STEP, len(terms) - first), 1))
        dense[line[a:b] - first, column[a:b]] = p[a:b]
        mine, theirs = dense[:, left], dense[:, right]
        for k in range(len(left)):
            sums[k] += np.abs(mine[:, k:k + 1] - theirs).sum(0)
    i, j = np.triu_indices(len(left), 1) if low == high else (x.ravel() for x in np.indices(sums.shape))
    return pd.DataFrame({"lang": lang, "source": names[left][i], "other": names[right][j], "value": sums[i, j]})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, most: int = TOP_TERMS) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank``."""
    found = Audit(docs, min_docs)
    parts = {"pair": found.source_pairs(), "term": found.marked_terms(most)}
    pairs, terms = (rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, rows in parts.items())
    return pairs.unionByName(terms)
