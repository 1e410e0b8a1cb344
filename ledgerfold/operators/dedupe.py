"""First/last-wins collapses.

"First" is an explicit ordinal carried from the scan (status rank, window,
entry, day), never arrival order: Spark has none. The collapse is an
aggregate, so duplicate copies are combined map-side before the shuffle —
a key holding a third of all rows costs one partial aggregate per task, not
one giant task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ORDER = ("status_rank", "window_idx", "page_id", "entry_idx", "day_idx")


def _ordering(df: DataFrame, order: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order if not isinstance(c, str) or c in df.columns]
    if not cols:
        raise ValueError("first/last-wins needs at least one ordering column")
    return F.struct(*cols)


def _collapse(df: DataFrame, keys: Sequence[str], order, pick) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(pick(packed, _ordering(df, order)).alias("_row")).select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in rest]
    )


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = DEFAULT_ORDER) -> DataFrame:
    """One row per key, the one with the smallest ordinal."""
    return _collapse(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the one with the greatest ordinal."""
    return _collapse(df, keys, order, F.max_by)


def dedupe_day_records(days: DataFrame, order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """A1 for ledger day records: identity = (employee, date, hash).

    Equal hashes imply equal (employee, date) up to a 64-bit collision, so
    keying on all three equals keying on the hash and keeps colliding
    records of different employees apart.
    """
    return first_wins(days, ["employee_xref", "pto_date", "record_hash"], order)


def dedupe_day_rows(rows: DataFrame, order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """A1 for day-table rows: one row per ``RecordHash``, first wins."""
    return first_wins(rows, ["RecordHash"], order)
