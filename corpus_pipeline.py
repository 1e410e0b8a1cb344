"""Corpus pipeline: toxicity, line dedup, near duplicates, decontamination, packing.

Each stage takes what the one before it kept, as a Parquet table in the shared
folder, and its decisions take effect; all but the last return the columns of
``documents``. A lost executor costs at most the running stage's lost tasks;
finished stages are files.

Defined cases: rows with null texts pass all filters and are packed as empty
documents; rows with null ids are never taken for duplicates; of repeated ids one row stays
(that with the least text hash); extra columns are carried along to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from ledgerfold.llm.common import checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents (but for every fifth, as op3 does) and drop what the classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels, learns=F.crc32(F.col("id").cast("string")) % 5 != 0)
    return toxicity.clean(docs, model)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop boilerplate lines of each source; every document stays."""
    found = line_dedup.line_dedup(docs)
    changed = F.col("__dropped") > 0
    columns = {"text": F.col("__text").alias("text"), "n_chars": F.when(changed, F.char_length("__text")).otherwise(F.col("n_chars")).cast(dict(docs.dtypes).get("n_chars", "long")).alias("n_chars")}
    return found.select(*[columns.get(c, F.col(c)) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest id."""
    gone = near_dedup.near_duplicates(docs).where(~F.col("kept")).select("doc_id")
    kept = docs.join(gone, "doc_id", "left_anti")
    several = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n"), F.min(F.xxhash64("text")).alias("__least")).where("__n > 1 AND doc_id IS NOT NULL").select("doc_id", "__least")
    once = kept.join(several, "doc_id", "left_anti")
    first = kept.join(several, "doc_id").where(F.xxhash64("text") == F.col("__least")).dropDuplicates(["doc_id"])
    return once.select(*docs.columns).unionByName(first.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: Byte-pair encoding has no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
