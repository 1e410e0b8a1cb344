"""Landing-folder trigger: whole snapshots only, however their files arrive."""

from __future__ import annotations

import json
import os
import tempfile

import pytest

from ledgerfold.plans import jobs
from ledgerfold.streaming.landing import run_available


def entry(day, hours):
    return {"TimeStart": f"{day}T00:00:00", "TimeEnd": f"{day}T00:00:00", "NetHours": hours,
            "ReasonName": "Vacation", "PayAdjustmentCodeName": "VAC", "Status": "APPROVED"}


def page_lines(snapshot, pages, first=0):
    return [json.dumps({"snapshot_id": snapshot, "employee_key": key, "page_id": first + i, "page": {"Data": entries}}) for i, (key, entries) in enumerate(pages)]


def done(snapshot, n):
    return json.dumps({"snapshot_id": snapshot, "pages": n})


@pytest.fixture
def land(spark):
    landing = tempfile.mkdtemp(dir=spark.conf.get("spark.checkpoint.dir"), prefix="landing-")
    table = jobs.ledger_table(spark, f"{os.path.basename(landing)}-ledger")

    def put(name, lines, **how):
        with open(os.path.join(landing, name), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        run_available(spark, landing, table, f"{landing}-ckpt", **how)
        return table

    return put


def active(table):
    return {r["employee_xref"] for r in table.read().where("is_active").collect()}


def runs(table):
    return {r["ingest_run_id"] for r in table.read().collect()}


def test_two_snapshots_two_cycles(land):
    one = page_lines("s1", [("EMP-001", [entry("2026-03-16", 8), entry("2026-03-20", 8)])])
    assert runs(land("1.json", [*one, done("s1", 1)])) == {"stream-s1"}
    two = page_lines("s2", [("EMP-001", [entry("2026-03-16", 4), entry("2026-03-25", 8)])])
    table = land("2.json", [*two, done("s2", 1)])
    rows = sorted((str(r["pto_date"]), r["is_active"], r["ingest_run_id"]) for r in table.read().collect())
    assert rows == [("2026-03-16", False, "stream-s1"), ("2026-03-16", True, "stream-s2"), ("2026-03-20", False, "stream-s1"), ("2026-03-25", True, "stream-s2")]


def test_snapshot_in_several_files_is_one_cycle(land):
    a, b = page_lines("s1", [("A", [entry("2026-03-16", 8)])]), page_lines("s1", [("B", [entry("2026-03-17", 8)])], first=1)
    assert active(land("1.json", a)) == set()
    assert active(land("2.json", b)) == set()  # no completion line yet
    assert active(land("3.json", [done("s1", 2)])) == {"A", "B"}


def test_late_older_snapshot_is_not_applied(land):
    new = page_lines("2031-03-17", [("A", [entry("2031-03-20", 8)]), ("B", [entry("2031-03-21", 8)])])
    old = page_lines("2031-03-16", [("A", [entry("2031-03-20", 8)])])
    land("1.json", old)
    assert active(land("2.json", [*new, done("2031-03-17", 2)])) == {"A", "B"}
    table = land("3.json", [done("2031-03-16", 1)])
    assert active(table) == {"A", "B"} and runs(table) == {"stream-2031-03-17"}
    assert active(land("4.json", [*page_lines("2031-03-18", [("B", [entry("2031-03-21", 8)])]), done("2031-03-18", 1)])) == {"B"}


def test_of_two_pages_with_one_id_the_later_counts(land):
    land("1.json", page_lines("s1", [("A", [entry("2031-03-20", 8)])]))
    table = land("2.json", [*page_lines("s1", [("A", [entry("2031-03-22", 4)])]), done("s1", 1)])
    assert [(str(r["pto_date"]), str(r["hours_requested"])) for r in table.read().collect()] == [("2031-03-22", "4.00")]


def test_cut_line_holds_the_snapshot_back(land):
    lines = page_lines("s1", [("A", [entry("2026-03-16", 8)]), ("B", [entry("2026-03-17", 8)])])
    assert active(land("1.json", [*lines, done("s1", 2)])) == {"A", "B"}
    again = page_lines("s2", [("A", [entry("2026-03-16", 8)]), ("B", [entry("2026-03-17", 8)])])
    table = land("2.json", [again[0], again[1][:-20], done("s2", 2)])
    assert runs(table) == {"stream-s1"} and active(table) == {"A", "B"}


def test_refused_page_ends_or_holds(land):
    lines = page_lines("s1", [("A", [entry("2026-03-16", 8)]), ("B", [entry("2026-03-17", 8)]), ("C", [entry("2026-03-18", 8)])])
    land("1.json", [*lines, done("s1", 3)])
    refused = json.dumps({"snapshot_id": "s2", "employee_key": "B", "page_id": 1, "page": {"Message": "Too many requests"}})
    two = [page_lines("s2", [("A", [entry("2026-03-16", 8)])])[0], refused, json.dumps({"snapshot_id": "s2", "employee_key": "C", "page_id": 2, "page": {"Data": []}}), done("s2", 3)]
    table = land("2.json", two, strict=False)
    assert active(table) == {"A", "B"}  # C is gone, B is held
    with pytest.raises(Exception, match="incomplete"):
        land("3.json", [line.replace('"s2"', '"s3"') for line in two])
    assert active(table) == {"A", "B"}
