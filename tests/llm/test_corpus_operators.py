"""Operators across documents: near and substring dedup, decontamination, sharding, chat, pipeline."""

import hashlib
import itertools
import random
import zlib

import llm_fixtures as fx
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from voltframe.llm import chat, common, decontam, minhash, queries, sharding, substrings


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "b", "x"), (1, "a", "y"), (None, "c", "z"), (2, None, "w"), (2, "q", "v")], "doc_id long, text string, n string")
    assert sorted((r.doc_id, r.text or "", r.n) for r in common.one_per_id(docs).collect()) == [(1, "a", "y"), (2, "", "w")]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(1, 1 << 62, n).astype(np.uint64)) for n in (1, 2, 3, 10, 100, 2000)]
    grid = minhash.sketch(sets, 288)
    assert (grid != minhash.EMPTY).all()
    for a, b in itertools.combinations(range(len(sets)), 2):      # a row depends on its own set alone
        assert (minhash.sketch([sets[a], sets[b]], 288) == grid[[a, b]]).all()
    x = np.unique(rng.integers(1, 1 << 62, 3000).astype(np.uint64))
    two = minhash.sketch([x[:2700], x[300:]], 2000)
    assert abs((two[0] == two[1]).mean() - 0.8) < 0.04


def check_near(spark, docs, rows, **how):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(docs, **how).collect()}
    assert got == fx.plain_near(rows, how.get("width", 2))


def test_near_groups(spark, docs, no_docs, rows):
    check_near(spark, docs, rows)
    check_near(spark, docs, rows, width=5)
    assert minhash.near_groups(no_docs).count() == 0


def test_near_group_of_loose_copies(spark):
    """Copies around and below the threshold, whose links chain through others."""
    rng = random.Random(8)
    base = fx.prose(rng, 120, 5000).split()
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(14)):
            words[rng.randrange(len(words))] = f"q{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    check_near(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_substrings(spark, docs, no_docs, rows, monkeypatch):
    def result(d, **how):
        out = substrings.remove_repeats(d, **how).collect()
        return {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in out}

    assert result(docs) == fx.plain_substrings(rows)
    assert result(docs.repartition(9), window=4) == fx.plain_substrings(rows, 4)
    assert substrings.remove_repeats(no_docs).count() == 0


def test_window_hashes_depend_on_words_alone():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    long = np.concatenate([rng.integers(0, 1 << 62, 70).astype(np.uint64), words])
    up, down = substrings.powers(substrings.BASE, 400), substrings.powers(substrings.INVERSE, 400)
    a, b = (substrings.window_hashes(w, 20, up, down) for w in (words, long))
    assert (a == b[70:]).all() and len(np.unique(a)) == len(a)
    assert (substrings.sliding_min(a, 15) == [a[k:k + 15].min() for k in range(len(a) - 14)]).all()


def test_windows_of_a_frequent_phrase_are_dealt_by_their_own_hash(spark):
    """Different windows that share their least part leave its bucket; equal ones still meet."""
    rng = random.Random(4)
    size, words = 997, common.WordHashes()
    up, down = substrings.powers(substrings.BASE, 6), substrings.powers(substrings.INVERSE, 6)
    part = lambda t: substrings.window_hashes(words.of([f"p{t}x{k}".encode() for k in range(6)]), 6, up, down)[0]
    best = min(range(3000), key=part)                       # a phrase whose hash is least in all windows that hold it
    phrase = [f"p{best}x{k}" for k in range(6)]
    texts = [[f"u{i}x{k}" for k in range(19)] + phrase + [f"v{i}x{k}" for k in range(19)] for i in range(300)]
    lot = [words.of([w.encode() for w in t]) for t in texts]
    least = lambda h: [len(r["hashes"]) // 6 for r in h.rows(list(range(300)), lot).to_pylist() if not r["local"]]
    plain = substrings.Hasher(size, 20)
    held = {r["cell"]: r["n"] for r in plain.counts(list(range(300)), lot).to_pylist()}
    assert sum(held.values()) == 300 * 25 == sum(least(plain))
    heavy = np.array([c for c, n in held.items() if n > 100])
    dealt = least(substrings.Hasher(size, 20, heavy))
    assert sum(dealt) == 300 * 25 and max(least(plain)) > 4000 and max(dealt) < 100
    rows = [(i, " ".join(texts[rng.randrange(40)] if i % 3 else texts[i])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    spans = substrings.repeated_spans(docs, least_heavy=20)
    got = {r.doc_id: r.n_removed for r in substrings.cut(docs, spans).collect()}
    assert got == {i: x[1] for i, x in fx.plain_substrings(rows).items()}


def plain_align(item, window):
    best = 0
    table = [[0] * (len(window) + 1) for _ in range(len(item) + 1)]
    for i, j in itertools.product(range(1, len(item) + 1), range(1, len(window) + 1)):
        step = decontam.MATCH if item[i - 1] == window[j - 1] else decontam.MISMATCH
        table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] + decontam.GAP, table[i][j - 1] + decontam.GAP)
        best = max(best, table[i][j])
    return best


def test_alignment_equals_plain_table():
    rng = np.random.default_rng(3)
    for _ in range(40):
        item, windows = rng.integers(1, 5, 9), rng.integers(1, 5, (4, 14))
        score, end = decontam.align(item, windows)
        assert score.tolist() == [plain_align(item, w) for w in windows]
        assert (end <= 14).all()


def test_leaks(spark, docs, no_docs):
    rng = random.Random(6)
    items = [(k, fx.prose(rng, 30, 3000)) for k in range(8)] + [(50, "too short"), (51, ""), (52, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    edited = lambda t, share: " ".join(w if rng.random() > share else "changed" for w in t.split())
    rows = [(k, fx.prose(rng, 80, 3000)) for k in range(60)]
    rows += [(100 + k, f"{fx.prose(rng, 50, 3000)}\n{items[k][1].upper().replace(' ', ', ')}! {fx.prose(rng, 9, 3000)}") for k in range(8)]
    rows += [(200 + k, f"{fx.prose(rng, 50, 3000)} {edited(items[k][1], 0.12)}") for k in range(8)]
    rows += [(300 + k, items[0][1]) for k in range(200)] + [(600, items[1][1] + " " + items[2][1]), (601, None), (602, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontam.find_leaks(table, bench).collect())
    want = [(100 + k, k) for k in range(8)] + [(200 + k, k) for k in range(8)] + [(300 + k, 0) for k in range(200)] + [(600, 1), (600, 2)]
    assert got == want
    assert sorted((r.doc_id, r.item_id) for r in decontam.find_leaks(table, bench, block_words=60).collect()) == want
    left = decontam.without_leaks(table, bench)
    assert sorted(r.doc_id for r in left.collect()) == [*range(60), 601, 602]
    assert decontam.find_leaks(docs, bench).count() == 0
    assert decontam.find_leaks(no_docs, bench).count() == 0
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0
    spans = {(r.doc_id, r.item_id): (r.first, r.past) for r in decontam.find_leaks(table, bench).collect()}
    assert spans[600, 1] == (0, 30) and spans[600, 2] == (30, 60)


def test_documents_with_frequent_seeds_only(spark):
    """A lot whose only hits are seeds far more frequent than the item's median seed."""
    item = "of the and " + " ".join(f"rare{k}" for k in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(k, "of the and so on") for k in range(50)] + [(99, item)], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()] == [(99, 1)]
    assert decontam.find_leaks(docs.filter("doc_id < 99"), bench).count() == 0


def test_leaks_as_edited_copies_only(spark):
    """Items of which the corpus has one copy, or many equal ones, with each 4th or 5th word changed: most seeds do not occur."""
    rng = random.Random(12)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(30))) for k in range(4)]
    cut = lambda t, each: " ".join("changed" if j % each == each - 1 else w for j, w in enumerate(t.split()))
    copies = [(0, 4, 1), (1, 5, 1), (2, 4, 40), (3, 5, 40)]
    rows = [(100 * item + k, f"{fx.prose(rng, 30)} {cut(items[item][1], each)} {fx.prose(rng, 9)}", item) for item, each, n in copies for k in range(n)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(999, fx.prose(rng, 60))], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect())
    assert got == sorted((i, item) for i, _, item in rows)


def test_hilbert_curve_steps_to_neighbours():
    for bits, dims in ((3, 2), (2, 3), (2, 4)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        index = sharding.hilbert(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_shards(spark, docs, no_docs, rows):
    dims = ["source", "lang", "n_chars", "doc_id"]
    table = docs.union(docs.limit(5)).union(docs.filter("doc_id = 1"))
    out = sharding.shard(table, dims, 7, ["doc_id", "kept", "rank"])
    got = out.toPandas()
    sizes = got.groupby("shard").size()
    assert len(got) == table.count() and len(sizes) == 7 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard").slot)
    few = sharding.shard(docs.limit(3), dims, 7, ["doc_id"]).toPandas()
    assert len(few) == 3 and few.groupby("shard").size().max() == 1
    assert sharding.shard(no_docs, dims, 7, ["doc_id"]).count() == 0
    spans = sharding.manifest(sharding.shard(docs, dims, 7, ["n_chars", "source"]), ["n_chars", "source"])
    assert spans.agg(F.sum("rows")).first()[0] == len(rows)


def test_strings_with_a_common_prefix_have_cells_of_their_own(spark):
    rows = [(i, None if i % 9 == 8 else f"https://host{i % 9}/é") for i in range(180)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    wide, names = sharding.curve_index(docs, ["source"])
    index = {}
    for r in wide.collect():
        index.setdefault(r.source or "", set()).add(r["__hilbert"])
    order = [index[k] for k in sorted(index)]
    assert all(len(x) == 1 for x in order) and sorted(map(min, order)) == list(map(min, order)) and len(set(map(min, order))) == 9


def test_op5_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op5_hilbert_shards(spark, sf).collect():
        assert (r["size"], r["text_crc32"]) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))


def test_escapes_are_reversible(spark):
    rng = random.Random(2)
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "|text|>", "|end|>", "|role|>", "a", "\n", "$1", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t"))).withColumn("u", chat.unescape(F.col("e")))
    for r in frame.collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("</s>", "<s>", "[INST]", "[/INST]", chat.ROLE, chat.TEXT, chat.END))


def test_reply_trees(spark):
    say = lambda n: ("assistant" if n % 2 else "user", f"m{n} <|end|>\\")
    tree = [("t", 1, None, 0.0), ("t", 2, 1, 1.0), ("t", 3, 1, 5.0), ("t", 4, 2, 9.0), ("t", 5, 3, 1.0), ("t", 6, 3, 1.0),
            ("loop", 1, 2, 0.0), ("loop", 2, 1, 0.0), ("loop", 3, 2, 0.0), ("orphan", 7, 99, 1.0), (None, 1, None, None), (None, 2, 1, 2.0)]
    rows = [(a, b, c, *say(b), s) for a, b, c, s in tree] + [("t", 1, None, *say(1), 0.0), ("nulls", 1, None, None, None, 0.0)]
    deep = [("deep", k, k - 1 if k else None, *say(k), 0.0) for k in range(70)]
    messages = spark.createDataFrame(rows + deep, "tree string, node long, parent long, role string, text string, score double")
    done = chat.format_trees(messages, top=2).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    got = {(r.tree, r["rank"]): r for r in done.collect()}
    way = lambda k: [int(t.text[1:].split(" ")[0]) for t in got[k].turns]
    assert set(got) == {("t", 1), ("t", 2), ("orphan", 1), (None, 1), ("nulls", 1), ("deep", 1)}
    assert way(("t", 1)) == [1, 2, 4] and way(("t", 2)) == [1, 3, 5]            # 10, then 6: the smaller leaf of two
    assert way((None, 1)) == [1, 2] and way(("orphan", 1)) == [7] and way(("deep", 1)) == list(range(70))
    assert [t.text for t in got["t", 2].turns] == [say(n)[1] for n in (1, 3, 5)]
    assert got["deep", 1].loss == [say(n)[1] for n in range(1, 70, 2)]
    assert [(t.role, t.text) for t in got["nulls", 1].turns] == [("", "")]
    assert chat.format_trees(messages.limit(0)).count() == 0


def test_op3_equals_sql(spark, same_as_sql):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same_as_sql(queries.op3_chat_format(spark, sf), queries.SQL_CHAT, conversations=(rows, ["conv_id", "turn", "role", "text"]))


def test_pipeline_equals_plain_version(spark, tmp_path):
    """All stages against plain versions, on the awkward table without repeated or null ids."""
    import duckdb
    import pandas as pd

    rows = fx.awkward_rows(11)
    items = [(k, fx.prose(random.Random(100 + k), 25, 3000)) for k in range(3)]
    rows += [(1000 + k, f"intro {fx.prose(random.Random(k), 30, 3000)} {items[k][1]}", "en", "s1", 9, "", "", 0) for k in range(3)]
    spark.createDataFrame(rows, fx.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=[f.name for f in fx.SCHEMA]).astype(object))
    kept = {i for i, k in con.execute(f"SELECT doc_id, kept FROM ({queries.SQL_QUALITY})").fetchall() if k}
    rest = [r for r in rows if r[0] in kept]
    stripped = fx.plain_lines(rest)
    rest = [(r[0], stripped[r[0]], *r[2:]) for r in rest]
    near = fx.plain_near(rest, width=5)
    rest = [r for r in rest if near[r[0]][1] == r[0]]
    rest = [r for r in rest if not any(t in (r[1] or "") for _, t in items)]
    lib = Tokenizer.from_file(queries.word_bpe_path())
    want = {r[0]: lib.encode(r[1] or "", add_special_tokens=False).ids for r in rest}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert 0 < len(got) < len(rows) and got == want


def test_rows_with_null_or_repeated_ids_stay(spark, tmp_path):
    """Stages 1, 3 and 4, op6 and op7 judge rows, not ids."""
    rng = random.Random(21)
    text = [fx.prose(rng, 40, 9000) for _ in range(6)]
    item = " ".join(f"i{k}" for k in range(25))
    rows = [(None, "short"), (None, text[0]), (None, text[1]), (1, "short"), (1, text[2]), (1, None), (2, text[3]), (2, text[4]),
            (None, f"{text[5]} {item}"), (2, f"{item} {text[5]}"), (3, text[0]), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], "doc_id long, text string, lang string, source string")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    show = lambda d: sorted(((r.doc_id or 0, r.text or "") for r in d.collect()))
    real = [(i or 0, t or "") for i, t in rows]
    near_copy = (0, f"{text[5]} {item}")                    # of the row that has the same words in other order, and an id
    assert show(corpus_pipeline.quality_stage(spark, docs, "")) == sorted(x for x in real if len(x[1]) > 9)
    assert show(corpus_pipeline.near_stage(spark, docs, "")) == sorted(set(real) - {(0, text[0]), (0, "short"), near_copy})
    assert show(corpus_pipeline.benchmark_stage(spark, docs, str(tmp_path))) == sorted(x for x in real if item not in x[1])
    near = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in minhash.near_groups(docs).collect())
    assert len(near) == len(rows) and (0, 39, 3, False) in near and (3, 39, 3, True) in near and (0, 1, 1, False) in near
    cuts = sorted((r.doc_id or 0, r.n_removed) for r in substrings.remove_repeats(docs).collect())
    assert cuts == sorted((i, len(t.split()) if (i, t) in ((0, text[0]), near_copy) else 0) for i, t in real)


def test_pipeline_stages_take_an_empty_table(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == no_docs.columns and docs.count() == 0
