"""Token counts: exact length histogram with suffix sums (operator 6).

Documents are aggregated by their encoded length; sums over all longer lengths
then answer totals, quantiles and truncated totals for every context limit
without touching the documents again.

Defined cases: a null or empty text has length 0; repeated rows count once
each; an empty table gives an empty histogram. Only the text column is read,
so nulls or extra columns elsewhere have no effect.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm import bpe
from ledgerfold.llm.common import settled, text_blocks

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def token_lengths(docs: DataFrame, text: str = "text", vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """One row per document: its encoded length. The files must be at the same path on every executor."""
    vocabulary, ranks = vocabulary or bpe.vocabulary_path(VOCABULARY), ranks or bpe.vocabulary_path(RANKS)

    def run(batches):
        for block in text_blocks(batches):
            n = bpe.encoder(vocabulary, ranks).lengths(block.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n_tokens"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame, span: int = 1024) -> DataFrame:
    """Per distinct length: counts at, up to and beyond it, and what a limit at that length keeps.

    Lengths are summed map-side first, so copies cost nothing. Running sums go in
    two levels: within ranges of ``span`` lengths in parallel, then over the
    ranges' totals (longest document / span rows). ``settled`` keeps the
    histogram, whose size is bounded by the longest document, for both.
    """
    counted = settled(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))
    counted = counted.withColumn("part", F.floor(F.col("n_tokens") / span)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    inside = Window.partitionBy("part").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = counted.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t")).select(
        "part",
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("d").over(everything).alias("docs_total"),
        F.sum("t").over(everything).alias("tokens_total"),
    )
    up_docs = F.col("docs_before") + F.sum("n_docs").over(inside)
    up_tokens = F.col("tokens_before") + F.sum("tokens").over(inside)
    rows = counted.join(parts, "part").select("n_tokens", "n_docs", up_docs.alias("docs_up_to"), up_tokens.alias("tokens_up_to"), "docs_total", "tokens_total")
    return rows.select(
        "n_tokens",
        "n_docs",
        "docs_up_to",
        "tokens_up_to",
        (F.col("docs_total") - F.col("docs_up_to")).alias("docs_longer"),
        (F.col("tokens_total") - F.col("tokens_up_to")).alias("tokens_longer"),
        (F.col("tokens_up_to") + F.col("n_tokens") * (F.col("docs_total") - F.col("docs_up_to"))).alias("tokens_kept_at_limit"),
        "docs_total",
        "tokens_total",
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents within it, tokens kept when longer ones are cut, tokens lost."""
    picks = []
    for limit in limits:
        inside = F.col("n_tokens") <= limit
        kept = F.coalesce(F.max(F.when(inside, F.col("tokens_up_to"))), F.lit(0)) + limit * F.coalesce(F.sum(F.when(~inside, F.col("n_docs"))), F.lit(0))
        picks.append(F.struct(F.lit(limit).cast("long").alias("context"), F.coalesce(F.max(F.when(inside, F.col("docs_up_to"))), F.lit(0)).alias("docs_within"), kept.alias("tokens_kept"), (F.coalesce(F.max("tokens_total"), F.lit(0)) - kept).alias("tokens_cut")))
    return histogram.agg(F.array(*picks).alias("all")).select(F.inline("all"))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """For each share: the least length that at least that share of all documents don't exceed."""
    picks = [F.struct(F.lit(float(q)).alias("share"), F.min(F.when(F.col("docs_up_to") >= F.lit(float(q)) * F.col("docs_total"), F.col("n_tokens"))).alias("n_tokens")) for q in shares]
    return histogram.agg(F.array(*picks).alias("all")).select(F.inline("all"))


def token_histogram(docs: DataFrame, text: str = "text") -> DataFrame:
    return length_histogram(token_lengths(docs, text))
