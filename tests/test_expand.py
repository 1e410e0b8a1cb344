"""Request expansion (X1-X4, P13-P16, A1) on fixture-shaped requests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from ledgerfold.operators import dedupe, expand

DAY = T.StructType([T.StructField("Date", T.StringType()), T.StructField("NetHours", T.DoubleType())])
ENTRY = T.StructType(
    [
        T.StructField("entry_idx", T.LongType()),
        T.StructField("employee_key", T.StringType()),
        T.StructField("TimeStart", T.StringType()),
        T.StructField("TimeEnd", T.StringType()),
        T.StructField("NetHours", T.DoubleType()),
        T.StructField("ReasonName", T.StringType()),
        T.StructField("PayAdjustmentCodeName", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("DayList", T.ArrayType(DAY)),
    ]
)


def entries(spark, rows):
    return spark.createDataFrame(rows, ENTRY)


SINGLE = (0, "EMP-001", "2026-03-16T00:00:00", "2026-03-16T00:00:00", 8.0, "Vacation", "VAC", "APPROVED", None)
LISTED = (
    1, "EMP-001", "2026-04-06T00:00:00", "2026-04-08T00:00:00", 24.0, "Personal", "PERS", "APPROVED",
    [("2026-04-06", 8.0), ("2026-04-07", 8.0), ("2026-04-08", 8.0)],
)


def test_single_day_entry(spark):
    r = expand.ledger_days(entries(spark, [SINGLE])).collect()
    assert len(r) == 1
    assert r[0]["employee_xref"] == "EMP-001" and r[0]["pto_date"] == dt.date(2026, 3, 16)
    assert r[0]["approval_type_code"] == "VAC" and r[0]["hours_requested"] == Decimal("8.00")
    assert r[0]["status"] == "APPROVED" and r[0]["reason_name"] == "Vacation"


def test_daylist_one_row_per_day(spark):
    r = expand.ledger_days(entries(spark, [LISTED])).orderBy("day_idx").collect()
    assert [x["pto_date"] for x in r] == [dt.date(2026, 4, 6), dt.date(2026, 4, 7), dt.date(2026, 4, 8)]
    assert all(x["hours_requested"] == Decimal("8.00") and x["approval_type_code"] == "PERS" for x in r)
    assert len({x["record_hash"] for x in r}) == 3


def test_even_split_only_with_option(spark):
    e = (2, "E1", "2026-05-04T00:00:00", "2026-05-06T00:00:00", 12.0, "Sick", None, "APPROVED", None)
    one = expand.ledger_days(entries(spark, [e]), expand_multi_day=False).collect()
    assert len(one) == 1 and one[0]["hours_requested"] == Decimal("12.00")
    many = expand.ledger_days(entries(spark, [e]), expand_multi_day=True).orderBy("day_idx").collect()
    assert [x["hours_requested"] for x in many] == [Decimal("4.00")] * 3


def test_split_remainder_and_reversed_dates(spark):
    e = (3, "E1", "2026-05-06T00:00:00", "2026-05-04T00:00:00", 20.0, "Sick", None, "APPROVED", None)
    r = expand.ledger_days(entries(spark, [e]), expand_multi_day=True).orderBy("day_idx").collect()
    assert [x["pto_date"].day for x in r] == [4, 5, 6]
    assert [x["hours_requested"] for x in r] == [Decimal("6.67"), Decimal("6.67"), Decimal("6.66")]


def test_negative_remainder_rejects_whole_entry(spark):
    e = (4, "E1", "2026-05-01T00:00:00", "2026-05-09T00:00:00", 0.05, "Sick", None, "APPROVED", None)
    assert expand.ledger_days(entries(spark, [e]), expand_multi_day=True).count() == 0
    rej = expand.rejected_entries(entries(spark, [e]), expand_multi_day=True).collect()
    assert rej[0]["reject_reason"] == "bad_day"


def test_missing_type_code_is_skipped_not_fatal(spark):
    bad = (5, "E1", "2026-01-01T00:00:00", None, 8.0, None, None, "APPROVED", None)
    good = (6, "E1", "2026-01-02T00:00:00", None, 8.0, "Vacation", None, "APPROVED", None)
    r = expand.ledger_days(entries(spark, [bad, good])).collect()
    assert len(r) == 1 and r[0]["pto_date"] == dt.date(2026, 1, 2)
    rej = expand.rejected_entries(entries(spark, [bad, good])).collect()
    assert [x["reject_reason"] for x in rej] == ["no_type_code"]


def test_incomplete_daylist_falls_back(spark):
    e = (7, "E1", "2026-03-02T00:00:00", "2026-03-03T00:00:00", 16.0, "Vac", "VAC", "APPROVED",
         [("2026-03-02", 8.0), ("2026-03-03", None)])
    r = expand.ledger_days(entries(spark, [e])).collect()
    assert len(r) == 1 and r[0]["day_source"] == "single" and r[0]["hours_requested"] == Decimal("16.00")


def test_dedupe_keeps_first(spark):
    e1 = (8, "E1", "2026-02-02T00:00:00", None, 8.0, "Vacation", None, "APPROVED", None)
    e2 = (9, "E1", "2026-02-02T00:00:00", None, 8.0, "Vacation", None, "CANCELED", None)
    d = dedupe.dedupe_day_records(expand.ledger_days(entries(spark, [e2, e1])), order=("entry_idx", "day_idx"))
    r = d.collect()
    assert len(r) == 1 and r[0]["entry_idx"] == 8 and r[0]["status"] == "APPROVED"


# --- day-table flow (X3) ------------------------------------------------------
TAG = T.StructType(
    [
        T.StructField("_XRefCode", T.StringType()),
        T.StructField("_Status", T.StringType()),
        T.StructField("status_rank", T.IntegerType()),
        T.StructField("window_idx", T.IntegerType()),
        T.StructField("entry_idx", T.LongType()),
        T.StructField("TimeStart", T.StringType()),
        T.StructField("TimeEnd", T.StringType()),
        T.StructField("NetHours", T.DoubleType()),
        T.StructField("ReasonName", T.StringType()),
        T.StructField("PayAdjShortName", T.StringType()),
    ]
)


def tagged(spark, start, end, hours, status="APPROVED"):
    return spark.createDataFrame([("EMP-095", status, 0, 0, 0, start, end, hours, "Vacation", "VAC")], TAG)


def test_full_week_splits_evenly_across_weekdays(spark):
    r = expand.weekday_days(tagged(spark, "2026-03-16T00:00:00", "2026-03-19T00:00:00", 24.0)).orderBy("Date").collect()
    assert [str(x["Date"]) for x in r] == ["2026-03-16", "2026-03-17", "2026-03-18"]
    assert all(x["Hours"] == Decimal("8.00") and x["Status"] == "Approved" for x in r)


def test_partial_day_uses_net_hours(spark):
    r = expand.weekday_days(tagged(spark, "2026-09-14T09:00:00", "2026-09-14T14:00:00", 5.0)).collect()
    assert len(r) == 1 and str(r[0]["Date"]) == "2026-09-14" and r[0]["Hours"] == Decimal("5.00")


def test_hours_change_changes_hash(spark):
    from pyspark.sql import functions as F

    from ledgerfold.functions.identity import record_hash

    h8 = expand.weekday_days(tagged(spark, "2026-09-14T09:00:00", "2026-09-14T17:00:00", 8.0)).first()["RecordHash"]
    h5 = expand.weekday_days(tagged(spark, "2026-09-14T09:00:00", "2026-09-14T14:00:00", 5.0)).first()["RecordHash"]
    ref = spark.range(1).select(record_hash(F.lit("EMP-095"), F.lit("2026-09-14"), F.lit("VAC"), F.lit(5.0))).first()[0]
    assert h8 != h5 and h5 == ref


def test_weekend_only_gives_no_rows(spark):
    assert expand.weekday_days(tagged(spark, "2026-09-19T00:00:00", "2026-09-21T00:00:00", 16.0)).count() == 0


def test_missing_hours_is_eight_per_day(spark):
    r = expand.weekday_days(tagged(spark, "2026-09-14T00:00:00", "2026-09-15T00:00:00", None)).first()
    assert r["Hours"] == Decimal("8.00")


def test_uneven_split_does_not_keep_total(spark):
    r = expand.weekday_days(tagged(spark, "2026-03-16T00:00:00", "2026-03-19T00:00:00", 20.0)).collect()
    assert [x["Hours"] for x in r] == [Decimal("6.67")] * 3


# --- landed values that are there but can't be used -------------------------------
def _landed(spark, entries):
    import json

    from pyspark.sql import functions as F

    from ledgerfold.sources.requests import entries_from_pages

    rows = [(f"K{i}", i, json.dumps({"Data": [dict({"PayAdjustmentCodeName": "VAC", "TimeStart": "2031-03-03T00:00:00"}, **e)]})) for i, e in enumerate(entries)]
    p = spark.createDataFrame(rows, "employee_key string, page_id long, t string").select("employee_key", "page_id", F.lit("APPROVED").alias("query_status"), F.parse_json("t").alias("page"))
    return entries_from_pages(p)


def test_present_but_unusable_values(spark):
    """Text hours and a huge total reject the request; a key that is no list ends the search for one."""
    from ledgerfold.operators import expand

    day = {"Date": "2031-03-04", "NetHours": 4}
    cases = [
        {"NetHours": "abc"},
        {"NetHours": "7.5"},
        {"NetHours": 1e11, "TimeEnd": "2031-03-05T00:00:00"},
        {"NetHours": 8, "DayList": [{"Date": "2031-03-04", "NetHours": "abc"}]},
        {"NetHours": 8, "DayList": {"0": day}, "Days": [day]},
        {"NetHours": 8, "DayList": None, "Days": [day]},
        {"NetHours": 8, "DayList": "", "Days": [day]},
        {"NetHours": 8, "DayList": [day, 5]},
        {"NetHours": "", "Status": ""},
        {"NetHours": 8, "DayList": [{"Date": "2031-03-04", "NetHours": "4.125"}]},
    ]
    e = _landed(spark, cases)
    rejected = {r["employee_key"]: r["reject_reason"] for r in expand.rejected_entries(e, expand_multi_day=True).collect()}
    assert rejected == {"K0": "bad_day", "K2": "bad_day", "K3": "bad_day"}
    got = {r["employee_xref"]: (str(r["pto_date"]), str(r["hours_requested"]), r["status"]) for r in expand.ledger_days(e, expand_multi_day=True).collect()}
    single = ("2031-03-03", "8.00", "APPROVED")
    listed = ("2031-03-04", "4.00", "APPROVED")
    assert got == {"K1": ("2031-03-03", "7.50", "APPROVED"), "K4": single, "K5": listed, "K6": listed, "K7": single, "K8": ("2031-03-03", "0.00", "APPROVED"), "K9": ("2031-03-04", "4.12", "APPROVED")}


def test_queried_status_stands_in(spark):
    """An entry without its own status passes the status filter by the one it was queried with."""
    from ledgerfold.operators import expand
    from ledgerfold.plans.cycle import LedgerCycle, scope_requests

    e = _landed(spark, [{"NetHours": 1}, {"NetHours": 1, "Status": ""}, {"NetHours": 1, "Status": "PENDING"}])
    cfg = LedgerCycle(now="2031-03-01 00:00:00", run_id="r", statuses=("APPROVED", "CANCELED"))
    days = expand.ledger_days(scope_requests(e, cfg)).collect()
    assert {(r["employee_xref"], r["status"], r["status_rank"]) for r in days} == {("K0", "APPROVED", 0), ("K1", "APPROVED", 0)}


def test_unreadable_weekday_hours(spark):
    from ledgerfold.operators import expand

    rows = [("A", "APPROVED", "2031-03-03T00:00:00", "2031-03-05T00:00:00", h) for h in ("abc", "9", None, "")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "_XRefCode string, _Status string, TimeStart string, TimeEnd string, NetHours string, entry_idx long")
    df = df.selectExpr("*", "'VAC' AS PayAdjShortName", "0 AS status_rank")
    assert {r["entry_idx"]: r["reject_reason"] for r in expand.weekday_rejects(df).collect()} == {0: "bad_hours", 3: "bad_hours"}
    assert {(r["entry_idx"], str(r["Hours"])) for r in expand.weekday_days(df).collect()} == {(1, "4.50"), (2, "8.00")}


def test_a_weekend_is_looked_at_no_further(spark):
    """Without a weekday there is nothing to reject: key, type and hours may be blank."""
    rows = [("A", " "), (" ", "VAC"), (None, None), ("B", " ")]
    ends = ["2026-09-21T00:00:00"] * 3 + ["2026-09-22T00:00:00"]
    df = spark.createDataFrame([(k, "APPROVED", 0, 0, i, "2026-09-19T00:00:00", end, -1.0, None, t) for i, ((k, t), end) in enumerate(zip(rows, ends))], TAG)
    assert expand.weekday_days(df).count() == 0
    assert [(r["entry_idx"], r["reject_reason"]) for r in expand.weekday_rejects(df).collect()] == [(3, "bad_type_code")]


def test_list_days_are_read_once_per_request(spark):
    """A listed day's date and hours are read before the explode, which carries them and not the source list."""
    rows = [(1, "E1", "2031-01-02T00:00:00", "VAC", [("2031-01-02T08:00", 2.345), ("2031-01-03", 8.0)]), (2, "E2", "2031-01-02T00:00:00", "VAC", [("2031-01-02", -1.0)])]
    df = spark.createDataFrame(rows, "entry_idx bigint, employee_key string, TimeStart string, ReasonName string, DayList array<struct<Date:string,NetHours:double>>")
    d = expand.ledger_days(df, expand_multi_day=True)
    got = [(r["entry_idx"], r["day_idx"], str(r["pto_date"]), str(r["hours_requested"])) for r in d.orderBy("entry_idx", "day_idx").collect()]
    assert got == [(1, 0, "2031-01-02", "2.34"), (1, 1, "2031-01-03", "8.00")]
    after = d._jdf.queryExecution().optimizedPlan().toString().split("Generate explode", 1)[0]
    assert "_dl#" not in after and "NetHours" not in after


def test_identity_parts_are_normalised_once_a_request(spark):
    """employee and type are stripped and upper-cased before the explode, not again for each of its days."""
    cols = "entry_idx bigint, employee_key string, TimeStart string, TimeEnd string, ReasonName string, NetHours double"
    r = spark.createDataFrame([(1, " e1 ", "2031-01-01", "2031-01-03", " vac", 6.0), (2, "  ", "2031-01-01", None, "x", 1.0)], cols)
    days = expand.ledger_days(r, expand_multi_day=True)
    plan = days._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan and "regexp_replace" not in plan.split("Generate explode")[0]
    assert sorted((d["employee_xref"], str(d["pto_date"]), d["approval_type_code"]) for d in days.collect()) == [("E1", f"2031-01-0{i}", "VAC") for i in (1, 2, 3)]
