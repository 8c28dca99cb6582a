"""Operator 6: near-duplicate groups by fast similarity sketching.

A document's set is its distinct ``width``-word shingles (64-bit hashes of
lower-cased words).  The sketch has ``t`` coordinates filled in rounds: in round
i every element is hashed to a bin and offers i + (its hash as a fraction); a
bin keeps the least offer, and after t rounds a last round for each bin offers
every element to it, so every coordinate fills (Dahlgaard, Knudsen and Thorup
2017, whose bounds hold for the sum over coordinates).  Later rounds never
change a filled bin, so rounds stop when all bins are full.

``bands`` groups of ``rows`` coordinates make bucket keys; a pair at the
threshold of 0.8 misses all 48 buckets of 6 with probability 5e-7.

Documents with equal sets form a class; class representatives meet in buckets,
and links are confirmed on the full sets:
1. every member of a bucket against the bucket's pivot p (the member that meets
   most others), then, unless linked to it, against the member nearest to p;
2. components of these links; buckets whose members now share a component are
   done, so a large group of near copies costs its size and not its square;
3. in the other buckets the pairs between components that a bound on their
   overlap cannot exclude: with s(a) the shingles of a that occur in any other
   set of an open bucket and c(a) those in p, two sets share at most
   min(c(a), c(b)) + min(s(a) - c(a), s(b) - c(b)), and a link needs
   80 * (n(a) + n(b)) / 180.  Of sets near p that share no shingle beyond p the
   overlap is at most min(c(a), c(b)); those that share one meet on it.

Scale: texts are read by map tasks and never collected; the ids of candidates
are broadcast only below ``MAX_BROADCAST_IDS``, else joined; each step's table
is written to the shared folder, so a lost executor repeats one step.

Defined results: null or empty text: empty set, linked with nothing; fewer
words than a shingle: the whole sequence is one shingle; rows without doc_id
and rows that share one are documents of their own (``common.row_keyed``), a
null id last, and a group of rows without ids has a null component_id; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.session import join_small

from .common import WordHashes, materialize, mix, row_keyed

WIDTH, PERCENT = 2, 80
BANDS, ROWS = 48, 6
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
LOW = np.uint64(0xFFFFFFFF)
MAX_BROADCAST_IDS = 1_000_000
#: similarity to the pivot from which a set is told apart by what it adds to the pivot
NEAR_PERCENT = 60
#: texts sketched at once, and the shingles after which a smaller lot is closed
LOT_DOCS, LOT_SHINGLES = 500, 400_000


def seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a sequence of word hashes."""
    n = len(words)
    if n == 0:
        return words
    size = min(width, n)
    factors = seeds(size, 77) | np.uint64(1)
    total = np.full(n - size + 1, np.uint64(size * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
    for k in range(size):
        total += words[k:n - size + 1 + k] * factors[k]
        total = mix(total)
    return np.unique(total)


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """A row of ``t`` coordinates for each non-empty set: round * 2^32 + 32 hash bits."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    out = np.full(n * t, EMPTY)
    x, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    round_seeds = seeds(2 * t, 5)
    open_rows = np.arange(n)
    for i in range(t):
        h = mix(x ^ round_seeds[i])
        bins = ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        np.minimum.at(out, owner * t + bins.astype(np.int64), np.uint64(i << 32) | (h & LOW))
        still = (out.reshape(n, t)[open_rows] == EMPTY).any(1)
        open_rows = open_rows[still]
        if not len(open_rows):
            break
        if not still.all():
            is_open = np.zeros(n, bool)
            is_open[open_rows] = True
            left = is_open[owner]
            x, owner = x[left], owner[left]
    grid = out.reshape(n, t)
    for k in open_rows:
        for b in np.flatnonzero(grid[k] == EMPTY):
            grid[k, b] = np.uint64((t + b) << 32) | (mix(sets[k] ^ round_seeds[t + b]) & LOW).min()
    return grid


def band_keys(grid: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.tile(seeds(bands, 9), (len(grid), 1))
    for r in range(rows):
        keys = mix(keys ^ grid[:, r::rows][:, :bands]) * np.uint64(0x9E3779B97F4A7C15)
    return mix(keys).view(np.int64)


def sketched(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n (size of the set), same (128-bit hash of the set), keys (of the bands)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, sets, held = [], [], 0
            for k, (i, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                ids.append(i)
                sets.append(shingles(known.of((text.as_py() or "").encode().lower().split()), width))
                held += len(sets[-1])
                if len(ids) >= LOT_DOCS or held >= LOT_SHINGLES or k + 1 == batch.num_rows:
                    full = [s for s in sets if len(s)]
                    keys = iter(band_keys(sketch(full, bands * rows), bands, rows) if full else ())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))], ["doc_id", "n", "same", "keys"])
                    ids, sets, held = [], [], 0

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, same binary, keys array<bigint>")


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """doc_id and shingles (binary, sorted 64-bit hashes) of the documents in ``ids`` (column rep)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for part in (batch.slice(k, LOT_DOCS) for k in range(0, batch.num_rows, LOT_DOCS)):
                sets = [shingles(known.of((t.as_py() or "").encode().lower().split()), width).astype("<u8").tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    wanted = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, F.col("doc_id") == F.col("rep"), "left_semi")
    return chosen.mapInArrow(run, "doc_id long, shingles binary")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``common`` (shared shingles), ``na`` and ``nb``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 500) for k in range(0, batch.num_rows, 500)):
                shared, na, nb = [], [], []
                for x, y in zip(part.column(2), part.column(3)):
                    x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                    both = np.concatenate([x, y])
                    both.sort()
                    shared.append(int((both[1:] == both[:-1]).sum()))
                    na.append(len(x))
                    nb.append(len(y))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(v, pa.int64()) for v in (shared, na, nb)]], ["a", "b", "common", "na", "nb"])

    one = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
    two = one.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
    return two.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, common long, na long, nb long")


def linked(tested: DataFrame, percent: int) -> DataFrame:
    return tested.filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(rep, comp): the least vertex that each linked vertex reaches; vertices without links are left out.

    Labels fall to the least label of the neighbours and then to the label of the
    label, until none falls; each round's labels are written to the shared folder."""
    edges = materialize(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = edges.groupBy(F.col("a").alias("rep")).agg(F.min("b").alias("near")).select("rep", F.least("rep", "near").alias("comp"))
    labels = materialize(labels, "labels")
    while True:
        to = labels.select(F.col("rep").alias("b"), F.col("comp").alias("other"))
        best = edges.join(to, "b").groupBy(F.col("a").alias("rep")).agg(F.min("other").alias("other"))
        low = labels.join(best, "rep").select("rep", F.col("comp").alias("was"), F.least("comp", "other").alias("low"))
        up = labels.select(F.col("rep").alias("low"), F.col("comp").alias("up"))
        new = materialize(low.join(up, "low").select("rep", "was", F.least("low", "up").alias("comp")), "labels")
        labels = new.select("rep", "comp")
        if new.filter("comp < was").isEmpty():
            return labels


def links_of(docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Components (rep, comp) of the confirmed links among ``members`` (key, rep, n, size) of shared buckets."""
    may = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))
    ok = 100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))
    # the pivot is the member that meets most others in all its buckets: the middle of its group
    met = members.groupBy("rep").agg(F.sum("size").alias("met"))
    pivots = (members.join(met, "rep").groupBy("key").agg(F.max(F.struct("met", (-F.col("rep")).alias("late"), "n")).alias("p"))
              .select("key", (-F.col("p.late")).alias("a"), F.col("p.n").alias("pn")))
    pivots = materialize(pivots, "pivots")
    stars = materialize(members.join(pivots, "key").filter(F.col("rep") != F.col("a")).filter(may(F.col("n"), F.col("pn"))).select("key", "a", F.col("rep").alias("b"), "n"), "stars")
    sets = materialize(full_sets(docs, members.select("rep").distinct(), width), "sets")
    tested = materialize(overlaps(stars.select("a", "b").distinct(), sets), "tested")
    known = tested.select("a", "b", "common", F.floor(1000000 * F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("near"), ok.alias("ok"))
    stars = materialize(stars.join(known, ["a", "b"]), "stars2")
    second = stars.groupBy("key").agg(F.max(F.struct("near", F.col("b").alias("c"), F.col("n").alias("cn"))).alias("p")).select("key", "p.c", "p.cn")
    more = (stars.filter(~F.col("ok")).join(second, "key").filter(F.col("b") != F.col("c")).filter(may(F.col("n"), F.col("cn")))
            .select(F.least("b", "c").alias("a"), F.greatest("b", "c").alias("b")).distinct())
    more = materialize(overlaps(more.join(tested.select("a", "b"), ["a", "b"], "left_anti"), sets), "tested2")
    tested = tested.union(more)
    links = linked(tested, percent)
    labels = components(links)

    now = members.join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    mixed = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c")).filter("lo < hi and c > 2")
    to_pivot = stars.select("key", "a", F.col("b").alias("rep"), "common").union(pivots.select("key", "a", "a", "pn"))
    to_pivot = to_pivot.join(pivots.select("key", "pn"), "key")
    left = now.join(mixed.select("key"), "key", "left_semi").join(to_pivot, ["key", "rep"], "left")
    near = F.coalesce(100 * F.col("common") >= NEAR_PERCENT * (F.col("n") + F.col("pn") - F.col("common")), F.lit(False))
    left = materialize(left.select("key", "rep", "n", "comp", "a", "common", near.alias("near")), "open")
    open_sets = sets.join(left.select("rep").distinct(), F.col("doc_id") == F.col("rep"), "left_semi")
    shared = materialize(_shared_sizes(open_sets), "shared")
    sized = left.join(shared, left["rep"] == shared["doc_id"]).drop("doc_id")
    two = lambda t, *on: (t.toDF(*[c if c in on else f"{c}1" for c in t.columns]), t.toDF(*[c if c in on else f"{c}2" for c in t.columns]))
    apart = [F.col("rep1") < F.col("rep2"), F.col("comp1") != F.col("comp2"), may(F.col("n1"), F.col("n2"))]
    enough = lambda most: (100 + percent) * most >= percent * (F.col("n1") + F.col("n2"))
    through = F.least("common1", "common2") + F.least(F.col("s1") - F.col("common1"), F.col("s2") - F.col("common2"))
    most = (F.when(F.col("near1") & F.col("near2"), F.least("common1", "common2"))
            .otherwise(F.least(F.col("s1"), F.col("s2"), F.coalesce(through, F.col("s1")))))
    x, y = two(sized, "key")
    rest = x.join(y, [x["key"] == y["key"], *apart, enough(most)]).select(F.col("rep1").alias("a"), F.col("rep2").alias("b"))
    x, y = two(_added(sized.filter("near").select("a", "rep", "n", "comp", "common", "s").distinct(), sets), "a", "h")
    rest = rest.union(x.join(y, [x["a"] == y["a"], x["h"] == y["h"], *apart, enough(through)]).select(F.col("rep1").alias("a"), F.col("rep2").alias("b"))).distinct()
    rest = rest.join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    last = materialize(linked(overlaps(rest, sets), percent), "links3")
    if last.isEmpty():
        return labels
    return components(links.union(last))


def _added(near: DataFrame, sets: DataFrame) -> DataFrame:
    """``near`` (a, rep, comp, ...) by each shingle h of rep that the pivot a lacks
    and that members of another component near the pivot have too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 500) for k in range(0, batch.num_rows, 500)):
                pivots, reps, comps, found = [], [], [], []
                for a, rep, comp, x, y in zip(*(c.to_pylist() for c in part.columns[:3]), part.column(3), part.column(4)):
                    more = np.setdiff1d(np.frombuffer(y.as_buffer(), "<i8"), np.frombuffer(x.as_buffer(), "<i8"), assume_unique=True)
                    found.append(more)
                    pivots += [a] * len(more)
                    reps += [rep] * len(more)
                    comps += [comp] * len(more)
                yield pa.RecordBatch.from_arrays([*[pa.array(v, pa.int64()) for v in (pivots, reps, comps)], pa.array(np.concatenate(found))], ["a", "rep", "comp", "h"])

    one = near.select("a", "rep", "comp").join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
    both = one.join(sets.select(F.col("doc_id").alias("rep"), F.col("shingles").alias("sb")), "rep")
    each = materialize(both.select("a", "rep", "comp", "sa", "sb").mapInArrow(run, "a long, rep long, comp long, h long"), "added")
    split = each.groupBy("a", "h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("a", "h")
    return each.drop("comp").join(split, ["a", "h"], "left_semi").join(near, ["a", "rep"])


def _shared_sizes(sets: DataFrame) -> DataFrame:
    """s: how many shingles of each set occur in another of ``sets``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in zip(batch.column(0), batch.column(1)):
                hashes = np.frombuffer(raw.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), i.as_py())), pa.array(hashes)], ["doc_id", "h"])

    each = sets.select("doc_id", "shingles").mapInArrow(run, "doc_id long, h long")
    alone = each.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("c")).filter("c = 1").groupBy("doc_id").agg(F.count("*").alias("alone"))
    sizes = sets.select("doc_id", (F.octet_length("shingles") / 8).cast("long").alias("n"))
    return sizes.join(alone, "doc_id", "left").select("doc_id", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("s"))


def near_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each document."""
    docs, plain = row_keyed(docs.select("doc_id", "text"), ordered=("doc_id", "text"))
    names, docs = docs.select(F.col("__row").alias("__a"), F.col("doc_id").alias("__name")), docs.select(F.col("__row").alias("doc_id"), "text")
    groups = _groups(docs, width, percent, bands, rows)
    if plain:
        return groups
    # a component is named by the id of its first row; those rows are joined by their own keys, so a large group meets nowhere
    groups = materialize(groups, "groups")
    heads = groups.filter("kept").select("component_id").join(names, F.col("component_id") == F.col("__a")).select(F.col("component_id").alias("__head"), F.col("__name").alias("__head_name"))
    named = groups.join(names, F.col("doc_id") == F.col("__a"))
    return (join_small(named, heads, F.col("component_id") == F.col("__head"), "left", MAX_BROADCAST_IDS)
            .select(F.col("__name").alias("doc_id"), "n_shingles", F.col("__head_name").alias("component_id"), "kept"))


def _groups(docs: DataFrame, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``near_groups`` of documents with one long doc_id each."""
    all_sets = materialize(sketched(docs, width, bands, rows), "sketches")
    classes = materialize(all_sets.filter("n > 0").groupBy("same").agg(F.min("doc_id").alias("rep")), "classes")
    reps = all_sets.join(classes, F.col("doc_id") == F.col("rep"), "left_semi")
    keyed = reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("rep"), "n")
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = materialize(keyed.join(shared, "key").select("key", "rep", "n", "size"), "members")
    labels = links_of(docs, members, width, percent)
    out = all_sets.select("doc_id", "n", "same").join(classes, "same", "left").join(labels, "rep", "left")
    component = F.coalesce("comp", "rep", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
