"""Operator 1 against the alignment of every document with every item."""

import random

import numpy as np

from voltframe.llm import decontam

KINDS = ("copy", "inserted", "replaced", "dropped", "mixed", "fourth", "far")


def edited(rng, words, kind):
    new = lambda: f"n{rng.randrange(10 ** 6)}"
    out = []
    for k, w in enumerate(words):
        if kind == "inserted":
            out += [w, new()] if k % 2 else [w]
        elif kind == "replaced":
            out.append(new() if rng.random() < 0.2 else w)
        elif kind == "dropped":
            out += [] if rng.random() < 0.2 else [w]
        elif kind == "mixed":
            r = rng.random()
            out += [] if r < 0.07 else [new()] if r < 0.14 else [w, new()] if r < 0.3 else [w]
        elif kind == "fourth":
            out.append(f"changed{k}" if k % 4 == 3 else w)
        elif kind == "far":
            out.append(new() if rng.random() < 0.5 else w)
        else:
            out.append(w)
    return out


def case(seed=11):
    rng = random.Random(seed)
    common = [f"c{k}" for k in range(30)]
    items = [(100 + k, [rng.choice(common) if rng.random() < 0.3 else f"i{k}_{j}" for j in range(n)]) for k, n in enumerate((1, 2, 3, 4, 6, 6, 8, 8, 12, 12, 16, 20, 20, 40, 59))]
    docs, at = [], 0
    fill = lambda n: [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(500)}" for _ in range(n)]
    for _, words in items:
        for kind in KINDS:
            for _ in range(2):
                docs.append((at, fill(rng.randrange(30)) + edited(rng, words, kind) + fill(rng.randrange(30))))
                at += 1
    long = items[-2][1]
    docs += [(at + k, fill(10) + edited(rng, long, "fourth") + fill(10)) for k in range(100)]      # one edit in many documents beside the full copies
    return [(i, " ".join(w)) for i, w in items], [(i, " ".join(w)) for i, w in docs]


def by_all_alignments(items, docs):
    known, found = {}, {}
    ids = lambda text: np.array([known.setdefault(w, len(known) + 1) for w in text.split()], np.int64)
    coded = [(i, ids(t)) for i, t in items]
    for d, text in docs:
        words = ids(text)
        for i, item in coded:
            together = {*zip(words, words[1:])} & {*zip(item, item[1:])}
            if len(item) > 5 and len(words) or together:    # short items: copies that keep two neighbours
                score = int(decontam.align(item, words[None])[0][0])
                if score >= decontam.SIMILARITY * decontam.MATCH * len(item):
                    found[d, i] = score
    return found


def test_every_alignment_is_found(spark):
    items, docs = case()
    want = by_all_alignments(items, docs)
    got = decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): r.score for r in got.collect()} == want
    per_kind = {kind: 0 for kind in KINDS}
    for (d, _) in want:
        if d < len(docs) - 100:
            per_kind[KINDS[d // 2 % len(KINDS)]] += 1
    assert all(per_kind[k] >= 8 for k in KINDS if k != "far"), per_kind
    assert sum(d >= len(docs) - 100 for d, _ in want) >= 100


def test_blocks_of_items_change_nothing(spark):
    items, docs = case(12)
    table, bench = spark.createDataFrame(docs[:60], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(tuple, decontam.find_leaks(table, bench, block_words=n).collect())) for n in (10 ** 6, 60))
    assert one == many and one
