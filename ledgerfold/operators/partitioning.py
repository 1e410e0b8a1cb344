"""Where derived columns are evaluated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_materialized(df: DataFrame, cols: dict) -> DataFrame:
    """Add ``cols`` as outputs of a one-row generator.

    Catalyst pushes filters through projections (substituting the
    expressions) and through repartitions, so a predicate on a derived column
    would be evaluated below the spread — on the scan's single task — and
    again above it. Generator outputs are plain attributes: predicates on
    them stay above the generator and the expressions are evaluated once.
    """
    packed = F.struct(*[e.alias(n) for n, e in cols.items()])
    return df.select("*", F.inline(F.array(packed)))
