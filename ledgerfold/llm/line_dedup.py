"""Line dedup by site-relative frequency (operator 10).

Per host: the number of pages that hold a line, over the number of the host's
pages. Lines beyond a ratio are boilerplate of that site and are dropped from every page.
Pages with the same set of lines count as one page, so copies don't turn content into
boilerplate.

Counts cover all pages. (host, line, page text) rows are narrow hashes,
combined map-side; a host that holds a third of all pages is spread over its
lines. A host has at most lines per page / ratio boilerplate lines, so
their hashes go back to its pages as one short array, and page texts are never grouped.

Defined cases: a null host is the host ''; a null text is no page and stays
null; blank lines are neither counted nor dropped; lines are compared without the blanks at
their ends; repeated rows are handled each; lines are told apart by 64-bit hashes; a page all of whose
lines are boilerplate is left with its blank lines or an empty text. Extra columns stay; names that begin with ``__`` are
reserved (``__lines``, ``__dropped`` and ``__text`` are the result, ``__host``, ``__boilerplate``, ``__hit``,
``__kept``, ``__shorter`` and ``__changed`` are used on the way), and a table that has one raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import written

#: A line is boilerplate on more than this share of a host's pages, and on at least LEAST_PAGES of them (once is no repetition).
RATIO, LEAST_PAGES = 0.02, 2


def _hashes(text: Column) -> Column:
    """Hash of each line; null for blank lines."""
    return F.transform(F.split(text, "\n", -1), lambda x: F.when(F.trim(x) != "", F.xxhash64(F.trim(x))))


def _host(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """``host, lines``: the hashes of each host's boilerplate lines."""
    pages = docs.select(_host(host).alias("host"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL")
    pages = pages.select("host", F.filter(F.array_distinct(_hashes(F.col("t"))), lambda x: x.isNotNull()).alias("lines"))
    pages = pages.withColumn("page", F.xxhash64(F.array_sort("lines")))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    held = pages.select("host", "page", F.explode("lines").alias("line")).distinct()
    often = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    # few rows are left of a line's count; the totals have one row per host
    common = often.join(totals, "host").where(F.col("n") > F.col("pages") * F.lit(float(ratio)))
    return common.groupBy("host").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def drop_lines(docs: DataFrame, lines: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with ``__lines``, ``__dropped`` (counts) and ``__text`` (without boilerplate lines)."""
    if reserved := sorted({"__lines", "__dropped", "__text", "__host", "__boilerplate", "__hit", "__kept", "__shorter", "__changed"} & {*docs.columns}):
        raise ValueError(f"reserved column names: {reserved}")
    t = F.col(text).cast("string")
    found = docs.withColumn("__host", _host(host)).join(lines.select(F.col("host").alias("__host"), F.col("lines").alias("__boilerplate")), "__host", "left")
    found = found.withColumn("__hit", F.when(t.isNotNull() & F.col("__boilerplate").isNotNull(), F.array_intersect(_hashes(t), F.col("__boilerplate"))).otherwise(F.array().cast("array<bigint>")))
    found = found.withColumn("__hit", F.filter("__hit", lambda x: x.isNotNull()))
    is_hit = lambda x: (F.trim(x) != "") & F.array_contains(F.col("__hit"), F.xxhash64(F.trim(x)))
    kept = F.when(F.size("__hit") > 0, F.filter(F.split(t, "\n", -1), lambda x: ~is_hit(x)))
    found = found.withColumn("__kept", kept).withColumn("__shorter", F.array_join("__kept", "\n"))
    found = found.withColumn("__changed", F.col("__shorter").isNotNull())
    n_lines = F.when(t.isNull(), 0).otherwise(F.size(F.split(t, "\n", -1)))
    return found.select(
        *[found[c] for c in docs.columns],
        n_lines.cast("long").alias("__lines"),
        F.when(F.col("__changed"), n_lines - F.size("__kept")).otherwise(0).cast("long").alias("__dropped"),
        F.when(F.col("__changed"), F.col("__shorter")).otherwise(t).alias("__text"),
    )


def line_dedup(docs: DataFrame, host: str = "source", text: str = "text", **limits) -> DataFrame:
    # a small table's size is known once it is written, so that page texts need no shuffle
    return drop_lines(docs, written(boilerplate(docs, host, text, **limits)), host, text)
