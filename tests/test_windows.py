"""Request windows (S6-S9), the manifest (S5) and status priority in the day flow (Q3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerfold.operators import dedupe, expand
from ledgerfold.sources import windows
from tests.test_expand import TAG


def test_chunk_windows_share_edges_and_cut_last(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1), dt.datetime(2026, 5, 1))], "a timestamp, b timestamp")
    w = df.select(F.inline(windows.chunk_windows("a", "b", 30))).orderBy("window_idx").collect()
    assert len(w) == 4
    assert all(w[i]["hi"] == w[i + 1]["lo"] for i in range(3))
    assert w[-1]["hi"] == dt.datetime(2026, 5, 1)


def test_chunk_windows_empty_when_start_not_before_end(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1))], "a timestamp, b timestamp")
    assert df.select(F.inline(windows.chunk_windows("a", "b", 30))).count() == 0


def test_inclusive_windows(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 1), dt.date(2026, 3, 5))], "a date, b date")
    w = df.select(F.inline(windows.inclusive_windows("a", "b", 31))).orderBy("window_idx").collect()
    assert [(r["lo"], r["hi"]) for r in w] == [
        (dt.date(2026, 1, 1), dt.date(2026, 1, 31)),
        (dt.date(2026, 2, 1), dt.date(2026, 3, 3)),
        (dt.date(2026, 3, 4), dt.date(2026, 3, 5)),
    ]


def test_lookback_span_text(spark):
    lo, hi = windows.span_iso(F.to_timestamp(F.lit("2026-03-16 13:45:10")))
    r = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert r["lo"] == "2026-02-14T00:00:00.000Z" and r["hi"] == "2026-06-14T23:59:59.999Z"


def test_manifest_rows(spark):
    keys = spark.createDataFrame([("A",), ("B",)], "XRefCode string")
    m = windows.manifest(keys, "XRefCode", windows.run_windows(F.to_timestamp(F.lit("2026-03-16 00:00:00"))))
    assert m.count() == 2 * 2 * 4
    assert sorted({r["status"] for r in m.collect()}) == ["APPROVED", "CANCELED"]


def test_approved_wins_over_canceled_for_same_day(spark):
    rows = [("E1", "CANCELED", 1, 0, 7, "2026-03-16T00:00:00", "2026-03-17T00:00:00", 8.0, "Vacation", "VAC"),
            ("E1", "APPROVED", 0, 0, 9, "2026-03-16T00:00:00", "2026-03-17T00:00:00", 8.0, "Vacation", "VAC")]
    d = dedupe.dedupe_day_rows(expand.weekday_days(spark.createDataFrame(rows, TAG))).collect()
    assert len(d) == 1 and d[0]["Status"] == "Approved"
