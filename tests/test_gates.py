"""Jobs retire nothing on input that isn't whole."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerfold.plans import jobs
from ledgerfold.plans.cycle import LedgerCycle, run_ledger_cycle
from ledgerfold.sources.pages import IncompleteInput
from ledgerfold.sources.requests import entries_from_pages
from ledgerfold.sources.tables import EMPLOYEE_SCHEMA


def name():
    return f"gate-{uuid.uuid4().hex}"


def landed(spark, pages):
    rows = [(key, i, f"u{i}", text) for i, (key, text) in enumerate(pages)]
    return spark.createDataFrame(rows, "employee_key string, page_id long, url string, t string").select("employee_key", "page_id", "url", F.try_parse_json("t").alias("page"))


def entry(day):
    return json.dumps({"Data": [{"TimeStart": f"{day}T00:00:00", "NetHours": 8, "PayAdjustmentCodeName": "VAC", "Status": "APPROVED"}]})


@pytest.mark.parametrize("bad", ['{"Data":[{"TimeSt', '{"Messages":["limit reached"]}', '{"Data":[],"Paging":{"Next":"u77"}}'])
def test_ledger_run_is_held_or_ended(spark, bad):
    table = jobs.ledger_table(spark, name())
    first = landed(spark, [("A", entry("2031-03-03")), ("B", entry("2031-03-04")), ("C", entry("2031-03-05"))])
    run_ledger_cycle(table, entries_from_pages(first), LedgerCycle(now="2031-03-01 00:00:00", run_id="1"), pages=first)
    second = landed(spark, [("A", entry("2031-03-03")), ("B", bad), ("C", '{"Data":[]}')])
    cfg = LedgerCycle(now="2031-03-02 00:00:00", run_id="2")
    with pytest.raises(IncompleteInput):
        run_ledger_cycle(table, entries_from_pages(second), cfg, pages=second)
    assert {(r["employee_xref"], r["ingest_run_id"]) for r in table.read().collect()} == {("A", "1"), ("B", "1"), ("C", "1")}
    run = run_ledger_cycle(table, entries_from_pages(second), cfg, pages=second, strict=False)
    assert {r["employee_xref"]: (r["is_active"], r["merge_action"]) for r in run.rows.collect()} == {"A": (True, "touch"), "B": (True, "keep"), "C": (False, "cancel")}


def test_day_table_keeps_days_of_unreadable_requests(spark):
    table, rejects = jobs.day_table(spark, name()), jobs.reject_table(spark, name())
    people = spark.createDataFrame([(k, "n", "d", 1, 1, "ACTIVE", None) for k in "ABC"], EMPLOYEE_SCHEMA)

    def requests(**ends):
        rows = [(i, k, "2031-03-03T00:00:00", end, "8") for i, (k, end) in enumerate(ends.items())]
        df = spark.createDataFrame(rows, "entry_idx long, employee_key string, TimeStart string, TimeEnd string, NetHours string")
        return df.selectExpr("*", "'APPROVED' AS Status", "'r' AS ReasonName", "'VAC' AS PayAdjShortName")

    whole = "2031-03-04T00:00:00"
    jobs.day_table_job(table, people, requests(A=whole, B=whole, C=whole), now="2031-03-01 06:00:00", pages=None)
    second = requests(A=whole, B="2031-03-0x")
    with pytest.raises(IncompleteInput):
        jobs.day_table_job(table, people, second, now="2031-03-02 06:00:00", pages=None)
    assert {r["Status"] for r in table.read().collect()} == {"Approved"}
    for _ in range(2):  # a run started again gives the same rows
        run = jobs.day_table_job(table, people, second, now="2031-03-02 06:00:00", pages=None, strict=False, rejects=rejects)
    assert {r["XRefCode"]: r["Status"] for r in run.rows.collect()} == {r["XRefCode"]: r["Status"] for r in table.read().collect()}
    assert {r["XRefCode"]: r["Status"] for r in run.rows.collect()} == {"A": "Approved", "B": "Approved", "C": "Canceled"}
    assert [(r["employee_key"], r["reject_reason"]) for r in rejects.read().collect()] == [("B", "bad_time_span")]


def test_one_row_per_key_with_two_details(spark):
    from ledgerfold.operators import roster

    keys = spark.createDataFrame([("emp-1",)], "XRefCode string")
    text = '{"XRefCode":"emp-1","DisplayName":"%s","WorkAssignments":{"Items":[{"Position":{"Department":{"XRefCode":"d"}}}]}}'
    rows = [(1, "emp-1", text % "old"), (2, "EMP-1 ", text % "new")]
    details = spark.createDataFrame(rows, "page_id long, XRefCode string, t string").select("page_id", "XRefCode", F.parse_json("t").alias("detail"))
    depts = spark.createDataFrame([("D", "d", 1, 2)], "dept_key string, department string, project_id int, task_id int")
    assert [r["employee_name"] for r in roster.employee_rows(keys, details, depts).collect()] == ["new"]
    assert roster.checked_keys(keys, details, depts, F.lit("2031-01-01").cast("date")).count() == 1


def test_jobs_return_what_they_observed(spark):
    """Counters come from the job's own writes; a cycle repeated with its stamp changes nothing and writes no month."""
    table = jobs.ledger_table(spark, name())
    first = landed(spark, [("A", entry("2031-03-03")), ("A ", entry("2031-03-03")), ("B", entry("2031-04-04"))])
    keys = spark.createDataFrame([("A",), ("b",), ("C",), ("a",)], "k string")
    cfg = LedgerCycle(now="2031-03-01 00:00:00", run_id="1")
    run = run_ledger_cycle(table, entries_from_pages(first), cfg, keys, pages=first)
    want = {"run_id": "1", "employees": 3, "fetched_entries": 3, "day_records": 2, "new": 2, "changed": 0, "unchanged": 0, "cancelled": 0, "superseded": 0, "inserted": 2, "reactivated": 0, "touched": 0, "cancelled_rows": 0}
    assert {k: v for k, v in run.metrics.items() if k != "duration_s"} == want and run.metrics["duration_s"] > 0
    again = run_ledger_cycle(table, entries_from_pages(first), cfg, keys, pages=first)
    assert (again.metrics["unchanged"], again.metrics["inserted"], again.metrics["touched"]) == (2, 0, 0)
    gone = run_ledger_cycle(table, entries_from_pages(first.where("page_id < 2")), LedgerCycle(now="2031-03-02 00:00:00", run_id="2"), pages=first.where("page_id < 2"))
    assert (gone.metrics["touched"], gone.metrics["cancelled_rows"], gone.metrics["fetched_entries"]) == (1, 1, 2)
    none = run_ledger_cycle(table, entries_from_pages(first.limit(0)), LedgerCycle(now="2031-03-03 00:00:00", run_id="3"), pages=first.limit(0))
    assert (none.metrics["fetched_entries"], none.metrics["cancelled_rows"]) == (0, 1)


def test_roster_pages_are_gated(spark):
    bad = landed(spark, [("A", '{"Message":"too many requests"}')])
    with pytest.raises(IncompleteInput):
        jobs.employee_table_job(jobs.employee_table(spark, name()), None, None, None, prefix="A", now="2031-03-01 00:00:00", pages=bad)


def test_a_cycle_settles_its_rows_only(spark, tmp_path):
    """Day records, identities and actions aren't written beside the rows."""
    import os
    import uuid

    from ledgerfold.session import shared_dir

    first = spark.createDataFrame(
        [(i, f"E{i % 3}", f"2031-0{1 + i % 4}-05T00:00:00", "VAC", "APPROVED", 8.0) for i in range(20)],
        "entry_idx bigint, employee_key string, TimeStart string, ReasonName string, Status string, NetHours double",
    )
    table = jobs.ledger_table(spark, f"ledger-{uuid.uuid4().hex[:8]}")
    at = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(at))
    run = run_ledger_cycle(table, first, LedgerCycle(now="2031-06-01 00:00:00", run_id="1"), pages=None)
    assert {name.rsplit("-", 1)[0] for name in set(os.listdir(at)) - before} == {"applied"}
    assert run.rows.count() == table.read().count() == 12
