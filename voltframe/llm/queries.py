"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe, chat, common, decontam, divergence, lines, minhash, quality, repair, sharding, substrings, tokenfiles, toxicity, unigram

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; digests of the operator's output."""
    out = bpe.encode_documents(common.documents(spark, sf_dir), word_bpe_path())
    return out.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def quality_limits():
    """Name and SQL of each threshold of a level (an alias of its quartiles)."""
    for r, (low, high) in quality.RATES.items():
        yield f"{r}_high", lambda q, r=r, high=high: f"({q}.{r}_3 + 3 * ({q}.{r}_3 - {q}.{r}_1) + {high})"
        if low is not None:
            yield f"{r}_low", lambda q, r=r, low=low: f"greatest({q}.{r}_1 - 3 * ({q}.{r}_3 - {q}.{r}_1) - {low}, 0)"


SQL_QUALITY = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
 win AS (SELECT doc_id, i, w[i:i+4] AS five FROM d, unnest(generate_series(1, len(w) - 4)) AS g(i)),
 twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS c FROM win) WHERE c > 1),
 rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest([0, 1, 2, 3, 4]) AS o(k) GROUP BY doc_id),
 m AS (SELECT d.doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(rep.n, 0) AS n_repeat_words,
         len(list_filter(list_zip(w, w[2:]), lambda p: p[1] = p[2])) AS n_stutters
       FROM d LEFT JOIN rep USING (doc_id)),
 f AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
 r AS (SELECT *, least(20000, 10000 * n_symbols // greatest(word_chars, 1)) AS symbol_rate,
         least(20000, 10000 * n_dup_lines // greatest(len(lines), 1)) AS dup_line_rate,
         least(20000, 10000 * n_repeat_words // greatest(n_words, 1)) AS repeat_rate,
         least(20000, 10000 * n_stutters // greatest(n_words, 1)) AS stutter_rate,
         least(20000, 100 * word_chars // greatest(n_words, 1)) AS word_length FROM f),
 lv AS (SELECT 2 AS lvl, lang AS gl, source AS gs, * FROM r WHERE NOT base_failed
        UNION ALL SELECT 1, lang, NULL, * FROM r WHERE NOT base_failed
        UNION ALL SELECT 0, NULL, NULL, * FROM r WHERE NOT base_failed),
 q AS (SELECT lvl, gl, gs, count(*) AS docs, {quartiles} FROM lv GROUP BY lvl, gl, gs),
 j AS (SELECT r.*, {picked}
       FROM r LEFT JOIN q a ON a.lvl = 2 AND a.gl IS NOT DISTINCT FROM r.lang AND a.gs IS NOT DISTINCT FROM r.source
              LEFT JOIN q b ON b.lvl = 1 AND b.gl IS NOT DISTINCT FROM r.lang
              LEFT JOIN q c ON c.lvl = 0)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce({passes}, false) AS kept
FROM j
""".format(
    quartiles=", ".join(f"quantile_disc({r}, 0.25) AS {r}_1, quantile_disc({r}, 0.75) AS {r}_3" for r in quality.RATES),
    picked=", ".join(f"(a.docs * {at('a')} + {quality.PRIOR} * ((b.docs * {at('b')} + {quality.PRIOR} * {at('c')}) // (b.docs + {quality.PRIOR}))) // (a.docs + {quality.PRIOR}) AS {name}" for name, at in quality_limits()),
    passes=" AND ".join([f"{r} <= {r}_high" for r in quality.RATES] + [f"{r} >= {r}_low" for r, (low, _) in quality.RATES.items() if low is not None]),
)


@register("op8_quality_rules", SQL_QUALITY)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.judge(common.documents(spark, sf_dir).select("doc_id", "lang", "source", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL_LINES = r"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS l FROM documents),
 p AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
 x AS (SELECT DISTINCT doc_id, source, trim(u, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS k FROM d, unnest(l) AS t(u)),
 b AS (SELECT x.source, k FROM x JOIN p ON x.source IS NOT DISTINCT FROM p.source WHERE k <> ''
       GROUP BY x.source, k HAVING count(*) > 1 AND 100 * count(*) > 10 * any_value(total)),
 y AS (SELECT doc_id, source, i, l[i] AS u, trim(l[i], chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS k
       FROM d, unnest(generate_series(1, len(l))) AS g(i)),
 z AS (SELECT y.*, b.k IS NOT NULL AS hit FROM y LEFT JOIN b ON y.source IS NOT DISTINCT FROM b.source AND y.k = b.k),
 s AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hit) AS n_dropped,
         coalesce(string_agg(u, chr(10) ORDER BY i) FILTER (NOT hit), '') AS kept FROM z GROUP BY doc_id)
SELECT documents.doc_id, documents.source, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
       sha256(s.kept) AS kept_sha256
FROM documents LEFT JOIN s USING (doc_id)
"""


@register("op2_line_dedup", SQL_LINES)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    docs = common.documents(spark, sf_dir).select("doc_id", "source", "text")
    out = lines.drop_boilerplate(docs, counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "source", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@register("op7_substring_dedup")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 20-word windows that start earlier elsewhere."""
    out = substrings.remove_repeats(common.documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register("op6_minhash")
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_groups(common.documents(spark, sf_dir))


@register("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it contains, with the alignment."""
    return decontam.find_leaks(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SHARDS = 24
DIMENSIONS = ["source", "lang", "n_chars", "doc_id"]


@register("op5_hilbert_shards")
def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot along the Hilbert curve of its metadata."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = common.documents(spark, sf_dir).select("doc_id", "lang", "source", "n_chars", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = sharding.shard(docs, DIMENSIONS, SHARDS, ["doc_id", "size", "text_crc32", "lang", "source", "n_chars"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"

SQL_CHAT = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
 e AS (SELECT *, regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]|\|[A-Za-z0-9_]{1,32}\|>))', '\1\\\2\3', 'g') AS er,
         regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|\|[A-Za-z0-9_]{1,32}\|>))', '\1\\\2\3', 'g') AS et FROM m),
 g AS (SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(er) + length(et) + 23) AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM g
"""


def conversation_trees(rows: DataFrame) -> DataFrame:
    """Conversations as reply trees: each turn replies to the one before it."""
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return (rows.select(F.col("conv_id").alias("tree"), at.alias("node"), "role", "text", F.lit(0.0).alias("score"))
            .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)))


@register("op3_chat_format", SQL_CHAT)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and digests of what is read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    done = chat.format_trees(conversation_trees(rows.union(own)))
    back = done.select(F.col("tree").alias("conv_id"), "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                       F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@register("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the unigram model of the piece vocabulary."""
    import public_tokenizers

    return unigram.count_tokens(common.documents(spark, sf_dir), unigram.read_pieces(public_tokenizers.path("piece_bpe_32k.model")))


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, by a model of the labelled ones."""
    out = toxicity.score_toxicity(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "score", F.get("p_above", F.lit(0)).alias("p_toxic"), F.get("p_above", F.lit(1)).alias("p_severe"), "severity", "grade", "toxic")


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _repair_sql() -> str:
    """The edits by a recursion over turns with the four states of the role grammar
    (nothing yet, system, open pair, closed pair) in place of stacks."""
    far = 1_000_000_000
    add = lambda way, cost, letter: f"struct_pack(c := {way}.c + {cost}, a := {way}.a || {letter})"
    least = lambda *ways: f"list_sort([{', '.join(ways)}])[1]"
    given = lambda way, role: add(way, f"(CASE WHEN go THEN {far} WHEN ini = '{role}' THEN extra ELSE extra + 1 END)",
                                  f"CASE WHEN ini = '{role}' THEN 'K' ELSE 'R' END")
    kept = lambda way, role: add(way, f"(CASE WHEN go OR ini <> '{role}' THEN {far} ELSE extra END)", "'K'")
    step = [add("s0", 2, "'D'"), least(add("s1", 2, "'D'"), kept("s0", "s")),
            least(add("s2", 2, "'D'"), *(given(s, "u") for s in ("s0", "s1", "s3"))), least(add("s3", 2, "'D'"), given("s2", "a"))]
    opened = least("t2", *(add(t, 5, "'I'") for t in ("t0", "t1", "t3")))
    return rf"""
WITH RECURSIVE
 src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
 fate AS (SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(place, ''), lambda ch: ord(ch)::UBIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
               lambda x, z: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) % 20 AS f FROM src),
 hurt AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text
          FROM fate, unnest(generate_series(1, CASE WHEN f = 3 THEN 2 ELSE 1 END)) WHERE f <> 0),
 convs AS (SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM conversations)),
 t0 AS (SELECT k, turn, role, text, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text) AS i
        FROM hurt JOIN convs ON hurt.conv_id IS NOT DISTINCT FROM convs.conv_id),
 t1 AS (SELECT *, left(role, 1) AS ini, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
          row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS again FROM t0),
 t AS (SELECT *, CASE WHEN said = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         said = '' OR again AS go, CASE WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS extra,
         coalesce(lag(ini) OVER (PARTITION BY k ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS off FROM t1),
 seen AS (SELECT k, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
            count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (off) AS illegal
          FROM t GROUP BY k),
 walk AS (SELECT k, 0 AS i, struct_pack(c := 0, a := '') AS s0, struct_pack(c := {far}, a := '') AS s1,
            struct_pack(c := 5, a := 'I') AS s2, struct_pack(c := 10, a := 'II') AS s3 FROM seen
          UNION ALL
          SELECT k, i, t0, t1, t2, {least("t3", add("t2", 5, "'I'"))}
          FROM (SELECT k, i, t0, t1, {opened} AS t2, t3
                FROM (SELECT w.k, t.i, {", ".join(f"{e} AS t{j}" for j, e in enumerate(step))}
                      FROM walk w JOIN t ON t.k = w.k AND t.i = w.i + 1))),
 best AS (SELECT w.k, list_sort([s0, s3])[1] AS b FROM walk w JOIN seen ON seen.k = w.k AND seen.n = w.i),
 letters AS (SELECT k, j, b.a[j] AS e, count(*) FILTER (b.a[j] <> 'I') OVER (PARTITION BY k ORDER BY j) AS i
             FROM best, unnest(generate_series(1, length(b.a))) AS g(j)),
 done AS (SELECT l.k, l.j, l.e, t.role, t.ini, CASE WHEN e = 'I' THEN '' ELSE t.text END AS text,
            row_number() OVER (PARTITION BY l.k ORDER BY l.j) AS p, first_value(e || ini) OVER (PARTITION BY l.k ORDER BY l.j) = 'Ks' AS sys
          FROM letters l LEFT JOIN t ON t.k = l.k AND t.i = l.i WHERE e <> 'D'),
 said AS (SELECT k, string_agg(CASE WHEN e = 'K' THEN role WHEN (p + CASE WHEN sys THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || text, chr(10) ORDER BY p) AS body FROM done GROUP BY k)
SELECT conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
       CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM convs LEFT JOIN seen ON convs.k = seen.k LEFT JOIN best ON convs.k = best.k LEFT JOIN said ON convs.k = said.k
"""


SQL_REPAIR = _repair_sql()
#: digest of nothing
NO_TEXT = hashlib.sha256().hexdigest()


@register("op11_conversation_repair", SQL_REPAIR)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by a fixed rule: its faults, its cheapest
    edits, and the digest of its repaired turns."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    edits, repaired = repair.repair_conversations(repair.damage(rows))
    sums = repair.digests(repaired).withColumnRenamed("conv_id", "summed")
    both = edits.join(sums, F.col("conv_id").eqNullSafe(F.col("summed")), "left").withColumnRenamed("conv_id", "own")
    every = rows.select("conv_id").distinct().join(both, F.col("conv_id").eqNullSafe(F.col("own")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(NO_TEXT)).alias("repaired_sha256"))


SQL_DIVERGENCE = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS k,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
 w AS (SELECT lang, source, k, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
 kept AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
 lt AS (SELECT lang, count(*) AS v, sum(ln) AS nl FROM kept GROUP BY lang),
 c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
 g AS (SELECT DISTINCT lang, source FROM d),
 gt AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
 p AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(n, 0) + 5) // (total::HUGEINT + 5 * v) AS p,
         1 + 1000000000::HUGEINT * (ln + 5) // (nl::HUGEINT + 5 * v) AS q
       FROM gt g JOIN kept USING (lang) JOIN lt USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
 pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
           FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS f
                      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
             ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
 terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
 every AS (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 50
"""


@register("op13_source_divergence", SQL_DIVERGENCE)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ, and by which terms."""
    return divergence.audit(common.documents(spark, sf_dir))


END_ID = 2


@register("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, as read back from the written token files."""
    import public_tokenizers

    manifest = tokenfiles.write_tokens(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return tokenfiles.read_tokens(manifest).select(
        "doc_id", "start", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
