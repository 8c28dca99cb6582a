"""Operator 2: line dedup by site-relative frequency.

Pages of a host that contain a line are divided by the pages of that host; a
line on more than ``max_percent`` of them is boilerplate of the host and is
dropped from its pages.  The ratio alone decides, on hosts of any size; a line on
one page only is no repetition.

Lines are compared without ASCII white space at either end, by their MD5; blank
lines are never boilerplate.  A host has at most (mean lines a page) * 100 /
``max_percent`` boilerplate lines, so one array a host is bounded.

Scale: only hashes are shuffled, each once a page, and counts are combined
before the shuffle, so a hot host or line costs one row a task.  The arrays are
broadcast where the counted size allows it, else joined on host and a salt, so
that the pages of a hot host spread over ``SALTS`` tasks.

Defined results: null text stays null (its page counts for the host); empty
text stays empty; a text of boilerplate only becomes empty; null host is a host
of its own; repeated rows are pages of their own; a line exactly at the ratio
stays; extra columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

MAX_PERCENT = 10
SALTS = 32
#: hashes of 16 bytes that are broadcast at most
MAX_BROADCAST_LINES = 500_000
BLANK = " \t\u000b\f\r"


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(BLANK)).cast("binary")))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_percent: int = MAX_PERCENT) -> DataFrame:
    """``b_host``, ``b_lines`` (array of line hashes), ``b_n``: one row a host that has boilerplate."""
    keys = F.array_distinct(F.transform(F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != ""), _key))
    pages = docs.groupBy(F.col(host).alias("h")).agg(F.count("*").alias("total"))
    counts = (docs.select(F.col(host).alias("b_host"), F.explode(keys).alias("line"))
              .groupBy("b_host", "line").agg(F.count("*").alias("pages")).filter("pages > 1"))
    often = counts.join(pages, F.col("b_host").eqNullSafe(F.col("h"))).filter(100 * F.col("pages") > max_percent * F.col("total"))
    return often.groupBy("b_host").agg(F.sort_array(F.collect_list("line")).alias("b_lines"), F.count("*").alias("b_n"))


def strip(docs: DataFrame, found: DataFrame, host: str = "source", text: str = "text", id_col: str = "doc_id",
          counts: tuple[str, str] | None = None, max_broadcast: int = MAX_BROADCAST_LINES) -> DataFrame:
    """``docs`` without the lines in ``found``; ``counts`` names columns for lines before and dropped."""
    page = docs.select(F.struct(*docs.columns).alias("page"))
    own, body = F.col("page")[host], F.col("page")[text]
    small = (found.agg(F.sum("b_n")).first()[0] or 0) <= max_broadcast
    if small:
        joined = page.join(F.broadcast(found), own.eqNullSafe(F.col("b_host")), "left")
    else:
        salted = found.withColumn("b_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        row = F.pmod(F.xxhash64(F.col("page")[id_col], F.length(body)), F.lit(SALTS)).cast("int")
        joined = page.withColumn("salt", row).join(salted, own.eqNullSafe(F.col("b_host")) & (F.col("salt") == F.col("b_salt")), "left")
    # the page's own boilerplate, by one pass over both sets; then each line looks among these few
    joined = joined.withColumn("lines", F.split(body, "\n"))
    joined = joined.withColumn("hits", F.when(F.col("b_lines").isNotNull(), F.array_intersect(F.transform("lines", _key), "b_lines")))
    after = F.filter("lines", lambda x: (F.btrim(x, F.lit(BLANK)) == "") | ~F.array_contains(F.col("hits"), _key(x)))
    rest = joined.withColumn("rest", F.when(F.size("hits") > 0, after))
    out = [F.col("page")[c].alias(c) if c != text else F.when(F.col("rest").isNull(), body).otherwise(F.array_join("rest", "\n")).alias(text) for c in docs.columns]
    if counts:
        out += [F.when(body.isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias(counts[0]),
                F.when(F.col("rest").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size("rest")).cast("long").alias(counts[1])]
    return rest.select(*out)


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", id_col: str = "doc_id", max_percent: int = MAX_PERCENT,
                     counts: tuple[str, str] | None = None) -> DataFrame:
    found = materialize(boilerplate(docs, host, text, max_percent), "boilerplate")
    return strip(docs, found, host, text, id_col, counts)
