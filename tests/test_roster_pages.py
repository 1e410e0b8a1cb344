"""Roster pickers (P6-P12), mapping (S13/J1) and landed pages."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import roster
from ledgerfold.sources import mapping, pages


def details(spark, payloads):
    rows = [(p.get("XRefCode", f"E{i}"), json.dumps(p)) for i, p in enumerate(payloads)]
    return roster.parse_details(spark.createDataFrame(rows, "XRefCode string, payload string"))


def dept(spark, payload, as_of="2026-06-01"):
    d = roster.with_department_as_of(details(spark, [payload]), F.to_date(F.lit(as_of)))
    return d.first()["department_xref"]


def test_department_from_nested_assignment(spark):
    p = {"WorkAssignments": {"Items": [{"IsPrimary": True, "EffectiveStart": "2020-01-01",
                                        "Department": {"XRefCode": "DEPT_SERVICES"}}]}}
    assert dept(spark, p) == "DEPT_SERVICES"


def test_department_scalar_fallback(spark):
    assert dept(spark, {"DepartmentXRefCode": "dept_learning"}) == "DEPT_LEARNING"


def test_department_effective_on_date(spark):
    p = {"WorkAssignments": [
        {"EffectiveStart": "2019-01-01", "EffectiveEnd": "2024-12-31", "DepartmentXRefCode": "DEPT_CORPORATE"},
        {"EffectiveStart": "2025-01-01", "DepartmentXRefCode": "DEPT_SERVICES"},
    ]}
    assert dept(spark, p, "2023-06-01") == "DEPT_CORPORATE"
    assert dept(spark, p, "2026-06-01") == "DEPT_SERVICES"


def test_no_department_anywhere(spark):
    assert dept(spark, {"XRefCode": "E1", "FirstName": "Ada"}) is None


def test_status_latest_and_primary_department(spark):
    p = {"XRefCode": "E1", "EmploymentStatuses": {"Items": [
        {"EffectiveStart": "2020-01-01", "EmploymentStatus": {"XRefCode": "ACTIVE"}},
        {"EffectiveStart": "2022-01-01", "EmploymentStatus": {"XRefCode": "TERMINATED"}},
        {"EffectiveStart": "2022-01-01", "EmploymentStatus": {"XRefCode": "INACTIVE"}}]},
        "WorkAssignments": {"Items": [{"Position": {"Department": {"XRefCode": "D0"}}},
                                      {"IsPrimary": True, "Position": {"Department": {"XRefCode": "D1"}}}]}}
    r = details(spark, [p]).select(roster.employment_status(F.col("detail")).alias("s"),
                                   roster.primary_department(F.col("detail")).alias("d")).first()
    assert r["s"] == "TERMINATED" and r["d"] == "D1"


MAP_ROWS = [(" dept_learning ", 101, 901, 0), ("DEPT_SERVICES", 102, 902, 1),
            ("Dept_Simulation", 101, 901, 2)]


def test_map_resolution_and_scope(spark):
    rows = spark.createDataFrame(MAP_ROWS, "department string, project_id int, task_id int, ordinal int")
    m = mapping.load(rows)
    emp = spark.createDataFrame([("E1", "dept_services "), ("E2", "DEPT_CORPORATE"), ("E3", None)], "x string, d string")
    got = {r["x"]: (r["project_id"], r["task_id"]) for r in mapping.resolve(emp, "d", m).collect()}
    assert got == {"E1": (102, 902), "E2": (None, None), "E3": (None, None)}
    assert mapping.size(m).first()[0] == 3
    assert sorted(r[0] for r in mapping.project_ids(m).collect()) == [101, 102]


def test_map_rejects_missing_id_and_empty(spark):
    bad = spark.createDataFrame([("D1", 1, None, 0)], "department string, project_id int, task_id int, ordinal int")
    with pytest.raises(ValueError):
        mapping.load(bad)
    with pytest.raises(ValueError):
        mapping.load(bad.limit(0))


def test_map_later_duplicate_wins(spark):
    rows = spark.createDataFrame([("d1", 1, 1, 0), (" D1 ", 2, 2, 1)], "department string, project_id int, task_id int, ordinal int")
    assert mapping.load(rows).first()["project_id"] == 2


PAGES = [
    (0, "p/0", {"Data": [{"XRefCode": "EMP-001"}, {"XRefCode": "EMP-002"}], "Paging": {"Next": "p/1"}}),
    (1, "p/1", {"Data": [{"xrefcode": "lower"}, 5, {"XRefCode": "EMP-001"}], "Paging": {"Next": {"href": " p/2 "}}}),
    (2, "p/2", {"Data": [], "Paging": {"Next": ""}}),
    (3, "p/3", [{"XRefCode": "EMP-009"}]),
    (4, "p/4", {"Messages": ["fine", "Request limit has been reached"]}),
    (5, "p/5", {"Data": [{"XRefCode": "EMP-010"}], "Paging": {"Next": "p/99"}}),
]


def landed(spark):
    rows = [(i, u, json.dumps(p)) for i, u, p in PAGES]
    return pages.parse_pages(spark.createDataFrame(rows, "page_id long, url string, payload string"))


def test_unwrap_pages_and_keys(spark):
    rows = pages.unwrap_list(landed(spark))
    keys = [r["XRefCode"] for r in pages.employee_keys(rows).orderBy("page_id", "row_idx").collect()]
    assert keys == ["EMP-001", "EMP-002", "EMP-001", "EMP-009", "EMP-010"]


def test_denials_and_gaps(spark):
    d = pages.denials(landed(spark)).collect()
    assert [(r["page_id"], r["message"]) for r in d] == [(4, "Request limit has been reached")]
    g = pages.page_gaps(landed(spark)).collect()
    assert [(r["page_id"], r["next_url"]) for r in g] == [(5, "p/99")]


def test_roster_frame_prefix_dedupe_flatten(spark):
    rows = spark.createDataFrame(
        [(0, 0, "EMP1", "Ada", ("ORG", "o")), (0, 1, " emp2", "Al", ("ORG", "o")), (1, 0, "EMP1", "Dup", ("ORG", "o")),
         (1, 1, None, "NoKey", ("ORG", "o")), (1, 2, "X9", "Out", ("ORG", "o"))],
        "page_idx int, row_idx int, XRefCode string, FirstName string, HomeOrganization struct<XRefCode:string,ShortName:string>",
    )
    f = roster.roster_frame(rows, "EMP")
    assert f.columns == ["XRefCode", "FirstName", "HomeOrganization.ShortName", "HomeOrganization.XRefCode"]
    got = {r["XRefCode"]: r["FirstName"] for r in f.collect()}
    assert got == {"EMP1": "Ada", " emp2": "Al"}


def test_empty_roster_keeps_key_column(spark):
    rows = spark.createDataFrame([], "page_idx int, row_idx int, XRefCode string, FirstName string")
    f = roster.roster_frame(rows, "EMP")
    assert f.count() == 0 and f.columns[0] == "XRefCode"


def test_request_pages_to_typed_entries(spark):
    """S3 + H14: entries from a landed request page; the payload text has sorted keys."""
    from ledgerfold.sources.requests import entries_from_pages

    page = {"Data": [{"TimeStart": "2026-04-06T00:00:00", "NetHours": 24.0, "ReasonName": "Personal",
                      "Days": [{"WorkDate": "2026-04-06", "Hours": 8.0}, {"DateTime": "2026-04-07", "NetHours": 16.0}]},
                     "junk"]}
    df = pages.parse_pages(spark.createDataFrame([("E1", 0, json.dumps(page))], "employee_key string, page_id long, payload string"))
    e = entries_from_pages(df).collect()
    assert len(e) == 1
    assert [(d["Date"], float(d["NetHours"])) for d in e[0]["DayList"]] == [("2026-04-06", 8.0), ("2026-04-07", 16.0)]
    assert e[0]["source_payload"].startswith('{"Days":[')
