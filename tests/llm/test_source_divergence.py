"""Operator 13 against SQL and against plain sums."""

import random
from collections import Counter, defaultdict

import pytest

from voltframe.llm import divergence, queries

COLUMNS = ["doc_id", "text", "lang", "source", "item", "rank"]
SCHEMA = "doc_id long, text string, lang string, source string, item string, rank int"


def corpus(seed=6, n=260):
    rng = random.Random(seed)
    words = ["The", "the", "straße", "Ünder", "ünder", "l'eau", "x1y", "日本", "@home", "[a]", "{z}", "\x7fend", "Été"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "fr", None, ""]), rng.choice([None, "hot", "hot", "a", "b", "é"])
        text = rng.choice([None, "", " . 12"]) if rng.random() < 0.1 else " ".join(words[int(len(words) * rng.random() ** 2)] for _ in range(rng.randrange(30)))
        rows.append((i, text, lang, source, "x", 1))
    rows += [(900, "...", "de", "only", "x", 1), (901, None, "de", "other", "x", 1), (902, "word " * 50, "it", "alone", "x", 1)]
    return rows + rows[:20]


def test_table_blanks_ascii_and_lowers_letters():
    assert divergence.term_counts("Ab-aB ÀB\x7fé1ñ Z_z".encode()) == {"ab".encode(): 2, "Àb".encode(): 1, "é".encode(): 1, "ñ".encode(): 1, b"z": 2}


@pytest.mark.parametrize("tile, block, held", [(256, 250_000, 400_000), (2, 7, 5)])
def test_audit_equals_sql(spark, monkeypatch, same_as_sql, tile, block, held):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", block)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rows = corpus()
    same_as_sql(divergence.audit(spark.createDataFrame(rows, SCHEMA)), queries.SQL_DIVERGENCE, documents=(rows, COLUMNS))


def test_audit_equals_plain_sums(spark):
    rows, floor = corpus(8, 120), 5
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        key = (lang or "", source or "")
        groups.add(key)
        found = divergence.term_counts((text or "").encode())
        counts[key].update(found)
        docs[key[0]].update(found.keys())
    share = lambda n, total, v: 1 + 1_000_000_000 * (n + 5) // (total + 5 * v)
    want = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= floor]
        p = {s: {t: share(counts[lang, s][t], sum(counts[lang, s][k] for k in kept), len(kept)) for t in kept} for g, s in groups if g == lang}
        want |= {(lang, source, other, sum(abs(p[source][t] - p[other][t]) for t in kept)) for other in p if other != source}
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA), min_docs=floor, most=3).collect()
    assert {(r.lang, r.source, r.item, r.value) for r in got if r.part == "pair"} == want
    assert max(r["rank"] for r in got if r.part == "term") <= 3


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F
    n, total, kept = 123_456_789_012_345, 987_654_321_098_765, 4_321_987
    row = spark.createDataFrame([(n, total, kept)], "n long, total long, kept long")
    assert row.select(divergence.share(F.col("n"), F.col("total"), F.col("kept"))).first()[0] == 1 + 10 ** 9 * (n + 5) // (total + 5 * kept)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
