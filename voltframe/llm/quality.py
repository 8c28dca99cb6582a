"""Operator 8: quality rules with adaptive thresholds (DataFrame functions only).

Per document a few integer measures; per language and source a mergeable
quantile sketch of each rate; thresholds are quartiles moved outwards, and the
documents are joined with the thresholds of their group.

The sketch is a histogram with cells of one ten-thousandth (exact within a
cell, at most ``TOP`` + 1 cells a group and rate); sketches merge by adding
counts, so sources add up to languages and languages to everything, whatever
the order of tasks.  A group's thresholds are blended with those of its language,
and these with those of everything, by the number of documents: n of a group weigh
against ``PRIOR`` of the level above, so no group size switches from one to the
other.

Scale: one pass over the texts writes the narrow measures to the shared folder;
counts are combined before each shuffle, so a hot source costs no more than its
cells; the join carries no text.

Defined results: null text counts as empty (base rule fails, not kept); null
language and null source are groups of their own; repeated rows are judged
alike; ties at a threshold pass; an empty table gives no rows; other columns
are returned as they are, but those named like a measure or verdict give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, words_col

SYMBOLS = "#*$%&|<>"
#: base rule
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: largest rate cell (rates above it share the last cell)
TOP = 20000
#: rate: (slack below the lower quartile or None, slack above the upper one), in cells
RATES = {"symbol_rate": (None, 200), "dup_line_rate": (None, 3500), "repeat_rate": (None, 1500), "stutter_rate": (None, 800), "word_length": (150, 150)}
#: quartile distances added to a quartile
REACH = 3
#: documents that the thresholds of the level above count for
PRIOR = 20


def _rate(part: Column, whole: Column, scale: int = 10000) -> Column:
    return F.least(F.lit(TOP), F.floor(F.lit(scale) * part / F.greatest(whole, F.lit(1)))).cast("int")


def _repeats(windows: Column) -> Column:
    """Start positions of the windows that occur twice or more, ascending."""
    order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), order)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the integer measures of each text."""
    w, h = F.col("__words"), F.col("__windows")
    keep = [c for c in docs.columns if c != text]
    one = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).withColumn("__words", words_col(F.col("__text")))
    lines = F.filter(F.split("__text", "\n"), lambda x: F.length(F.translate(x, " \t\u000b\f\r", "")) > 0)
    hashed = F.transform(F.sequence(F.lit(0), F.size(w) - F.lit(WINDOW)), lambda i: F.xxhash64(*[F.get(w, i + F.lit(k)) for k in range(WINDOW)]))
    two = one.select(
        *keep,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(F.col("__text"), " \t\n\u000b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate(F.col("__text"), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("__lines"),
        F.size(F.filter(w, lambda x, i: x == F.get(w, i + F.lit(1)))).cast("long").alias("n_stutters"),
        F.when(F.size(w) >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>")).alias("__windows"),
    )
    three = two.select("*", _repeats(h).alias("__order"))
    order = F.col("__order")
    same = lambda x, j: x["h"] == F.get(order, j)["h"]
    twice = F.filter(order, lambda x, j: F.coalesce(F.when(j > 0, same(x, j - F.lit(1))), F.lit(False)) | F.coalesce(same(x, j + F.lit(1)), F.lit(False)))
    four = three.withColumn("__starts", F.when(order.isNotNull(), F.sort_array(F.transform(twice, lambda x: x["i"]))))
    starts = F.col("__starts")
    covered = F.aggregate(F.transform(starts, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + F.lit(1)) - s, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    return four.select(
        *keep, "n_words", "word_chars", "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"), "n_stutters",
    )


def with_rates(measured: DataFrame) -> DataFrame:
    n = F.col("n_words")
    return measured.select(
        "*",
        ((n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)).alias("base_failed"),
        _rate(F.col("n_symbols"), F.col("word_chars")).alias("symbol_rate"),
        _rate(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_rate"),
        _rate(F.col("n_repeat_words"), n).alias("repeat_rate"),
        _rate(F.col("n_stutters"), n).alias("stutter_rate"),
        _rate(F.col("word_chars"), n, 100).alias("word_length"),
    )


def sketches(rated: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Histogram cells per level (0 everything, 1 language, 2 language and source)."""
    long = rated.filter(~F.col("base_failed")).select(
        F.col(lang).alias("g_lang"), F.col(source).alias("g_source"),
        F.explode(F.create_map(*[x for r in RATES for x in (F.lit(r), F.col(r))])).alias("rate", "cell"))
    by_source = long.groupBy("g_lang", "g_source", "rate", "cell").agg(F.count("*").alias("n")).withColumn("level", F.lit(2))
    by_lang = by_source.groupBy("g_lang", "rate", "cell").agg(F.sum("n").alias("n")).withColumns({"level": F.lit(1), "g_source": F.lit(None).cast("string")})
    whole = by_lang.groupBy("rate", "cell").agg(F.sum("n").alias("n")).withColumns({"level": F.lit(0), "g_lang": F.lit(None).cast("string"), "g_source": F.lit(None).cast("string")})
    return by_source.unionByName(by_lang).unionByName(whole)


def thresholds(cells: DataFrame, reach: int = REACH) -> DataFrame:
    """Lowest and highest passing cell of each rate, one row per level and group."""
    group = ["level", "g_lang", "g_source", "rate"]
    upto = Window.partitionBy(*group).orderBy("cell")
    seen = cells.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy(*group))})
    q = lambda p: F.min(F.when(100 * F.col("upto") >= p * F.col("all"), F.col("cell")))
    quartiles = seen.groupBy(*group).agg(F.max("all").alias("docs"), q(25).alias("q1"), q(75).alias("q3"))
    spread = F.lit(reach) * (F.col("q3") - F.col("q1"))
    out = quartiles.groupBy("level", "g_lang", "g_source").agg(
        F.max("docs").alias("docs"),
        *[F.max(F.when(F.col("rate") == r, F.greatest(F.col("q1") - spread - F.lit(low), F.lit(0)))).alias(f"{r}_low") for r, (low, _) in RATES.items() if low is not None],
        *[F.max(F.when(F.col("rate") == r, F.col("q3") + spread + F.lit(high))).alias(f"{r}_high") for r, (_, high) in RATES.items()],
    )
    return out


def group_thresholds(limits: DataFrame, prior: int = PRIOR) -> DataFrame:
    """For each language and source its thresholds, blended with those of the levels above."""
    names = [c for c in limits.columns if c.endswith(("_low", "_high"))]
    level = lambda k, *keys: limits.filter(F.col("level") == k).select(*keys, F.struct("docs", *names).alias(f"at{k}"))
    top = level(0).scalar()                                 # one row, or none where no document passes the base rule
    langs = level(1, F.col("g_lang").alias("l"))
    both = level(2, "g_lang", "g_source").join(langs, F.col("g_lang").eqNullSafe(F.col("l"))).withColumn("at0", top)

    def blended(name: str) -> Column:
        weigh = lambda k, above: F.call_function("div", F.col(f"at{k}")["docs"] * F.col(f"at{k}")[name] + prior * above, F.col(f"at{k}")["docs"] + prior)
        return weigh(2, weigh(1, F.col("at0")[name])).alias(name)

    return both.select("g_lang", "g_source", *map(blended, names))


#: what ``judge`` adds to the columns of its table
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutters", "base_failed", *RATES, "kept")


def judge(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", prior: int = PRIOR, reach: int = REACH) -> DataFrame:
    """The other columns of ``docs`` with its measures, ``base_failed`` and ``kept``."""
    own = [c for c in docs.columns if c != text and c not in ADDED]
    packed = docs.select(F.struct(*own).alias("doc"), F.col(lang).alias("d_lang"), F.col(source).alias("d_source"), F.col(text).alias("text"))
    rated = materialize(with_rates(measures(packed)), "quality")
    limits = group_thresholds(thresholds(sketches(rated, "d_lang", "d_source"), reach), prior)
    joined = rated.join(limits, F.col("d_lang").eqNullSafe(F.col("g_lang")) & F.col("d_source").eqNullSafe(F.col("g_source")), "left")
    passes = F.lit(True)
    for r, (low, _) in RATES.items():
        passes = passes & (F.col(r) <= F.col(f"{r}_high"))
        if low is not None:
            passes = passes & (F.col(r) >= F.col(f"{r}_low"))
    judged = joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(passes, F.lit(False)))
    return judged.select(*[F.col("doc")[c].alias(c) for c in own], *ADDED)
