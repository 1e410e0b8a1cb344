"""Helpers shared by the text operators: reliable lineage cuts, text blocks, row identity."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once inside a Python task; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder (tests); on any
    other master that folder would not be shared, so it is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the shared folder; survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: like ``settled``, and the optimizer knows its size."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose text is at most ``size`` bytes (or one row)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64))
        at = 0
        while at < n:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def among_lowest(column: Column, wanted: int, total: Column) -> Column:
    """Whether a row is likely among the ``wanted`` of ``total`` rows with the lowest hash of a column.

    About three times as many rows pass (all, where there are few), spread over all tasks, so
    that the exact choice among them costs the same on any input.
    """
    share = F.least(F.lit(1.0), F.lit(3.0 * wanted + 100) / total)
    return F.xxhash64(column) <= F.lit(-(2.0**63)) + share * F.lit(2.0**64)
