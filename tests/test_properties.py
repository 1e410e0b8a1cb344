"""Property tests: half-even hours vs Python decimals, split totals, hot copies."""

from __future__ import annotations

from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerfold.functions.identity import norm_hours
from ledgerfold.operators import dedupe, expand


def python_hours(v):
    """The source system's rule: decimal text of the value, quantized half-even."""
    q = Decimal(str(v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN)
    return None if q < 0 or q >= Decimal("10000") else q


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 99999).map(lambda n: n / 1000), st.floats(0, 9999, allow_nan=False),
                          st.integers(-5000, 5000).map(lambda n: n / 8)), min_size=50, max_size=200))
def test_hours_match_python_decimal(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "h double")
    got = [r[0] for r in df.select(norm_hours("h")).collect()]
    assert got == [python_hours(float(v)) for v in values]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(1, 30)), min_size=20, max_size=60))
def test_split_keeps_two_decimal_totals(spark, cases):
    rows = [(i, "E1", "2026-01-01T00:00:00", f"2026-01-{d:02d}T00:00:00", c / 100, "r", "VAC", "APPROVED")
            for i, (c, d) in enumerate(cases)]
    schema = ("entry_idx long, employee_key string, TimeStart string, TimeEnd string, NetHours double, "
              "ReasonName string, PayAdjustmentCodeName string, Status string")
    days = expand.ledger_days(spark.createDataFrame(rows, schema), expand_multi_day=True)
    sums = {r[0]: r[1] for r in days.groupBy("entry_idx").agg(F.sum("hours_requested")).collect()}
    for i, (c, d) in enumerate(cases):
        per = (Decimal(c) / 100 / d).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN)
        if d > 1 and Decimal(c) / 100 - per * (d - 1) < 0:
            assert i not in sums  # negative remainder: the whole request is rejected
        else:
            assert sums[i] == Decimal(c) / 100


def test_hot_identity_with_many_copies(spark):
    """A third of all rows are copies of one request: first wins, nothing else lost."""
    hot = [(i, "E1", "2026-02-02T00:00:00", None, 8.0, "r", "VAC", "APPROVED") for i in range(3000)]
    cold = [(10000 + i, f"C{i}", "2026-02-02T00:00:00", None, 8.0, "r", "VAC", "APPROVED") for i in range(6000)]
    schema = ("entry_idx long, employee_key string, TimeStart string, TimeEnd string, NetHours double, "
              "ReasonName string, PayAdjustmentCodeName string, Status string")
    df = spark.createDataFrame(list(reversed(hot)) + cold, schema).repartition(7)
    d = dedupe.dedupe_day_records(expand.ledger_days(df), order=("entry_idx", "day_idx"))
    assert d.count() == 6001
    assert d.filter(F.col("employee_xref") == "E1").first()["entry_idx"] == 0
