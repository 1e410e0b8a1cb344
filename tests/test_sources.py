"""Landed files read as VARIANT (S1) and catalog DDL helpers."""

from __future__ import annotations

import json
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerfold.sources import pages, tables


def test_read_landed_json_files(spark):
    folder = tempfile.mkdtemp(dir=spark.conf.get("spark.checkpoint.dir"), prefix="pages-")
    files = {
        "a.json": [{"page_id": 0, "url": "https://x/list?p=0", "page": {"Data": [{"XRefCode": "A"}, {"XRefCode": "B"}], "Paging": {"Next": "https://x/list?p=1"}}},
                   {"page_id": 1, "url": "https://x/list?p=1", "page": [{"XRefCode": "C"}, 3]}],
        "b.json": [{"page_id": 2, "url": "https://x/list?p=2", "page": {"Data": [], "Paging": {"Next": {"href": " https://x/list?p=9 "}}}}],
    }
    for name, docs in files.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("\n".join(json.dumps(d) for d in docs) + "\n")
    p = pages.read_pages(spark, folder)
    rows = pages.employee_keys(pages.unwrap_list(p)).orderBy("page_id", "row_idx").collect()
    assert [r["XRefCode"] for r in rows] == ["A", "B", "C"]
    assert [tuple(r) for r in pages.page_gaps(p).select("page_id", "next_url").collect()] == [(2, "https://x/list?p=9")]
    assert pages.denials(p).count() == 0
    assert pages.completeness(p).first().asDict() == {"n_pages": 3, "n_unreadable": 0, "n_denied": 0, "n_gaps": 1}
    with pytest.raises(pages.IncompleteInput):
        pages.require_complete(p)
    pages.require_complete(p.where("page_id < 2"))


def test_create_and_evolve_catalog_table(spark):
    loc = tempfile.mkdtemp(dir=spark.conf.get("spark.checkpoint.dir"), prefix="emp-table-")
    old_ddl = "XRefCode STRING NOT NULL, employee_name STRING, DepartmentXRefCode STRING, ProjectId INT, TaskId INT"
    spark.sql("DROP TABLE IF EXISTS lf_test_employees")
    spark.sql(tables.create_table_sql("lf_test_employees", old_ddl, location=loc))
    assert tables.evolve_table(spark, "lf_test_employees") == ["employment_status", "UpdatedDateTime"]
    assert spark.table("lf_test_employees").columns == tables.EMPLOYEE_SCHEMA.fieldNames()
    assert tables.evolve_table(spark, "lf_test_employees") == []
    spark.sql("DROP TABLE lf_test_employees")


def fresh(spark, name):
    return tempfile.mkdtemp(dir=spark.conf.get("spark.checkpoint.dir"), prefix=name) + "/t"


def test_stored_table_reads_empty_and_replaces_its_partitions(spark):
    t = tables.StoredTable(spark, fresh(spark, "emp-"), tables.EMPLOYEE_SCHEMA, tables.key_part("XRefCode", 4))
    assert t.read().count() == 0 and t.read().schema.fieldNames() == tables.EMPLOYEE_SCHEMA.fieldNames()
    src = spark.createDataFrame([(f"E{i}", "Ann", "D", 1, 1, "ACTIVE", None) for i in range(40)], tables.EMPLOYEE_SCHEMA)
    t.overwrite(src)
    t.overwrite(t.read().withColumn("employee_name", F.lit("Bo")))  # from a plan that reads the table itself
    assert t.read().count() == 40 and {r[0] for r in t.read().select("employee_name").distinct().collect()} == {"Bo"}


def test_rows_to_struct_infers_schema_and_keeps_first_case(spark):
    from ledgerfold.operators import roster

    df = spark.createDataFrame([(0, '{"XRefCode": "A", "Org": {"X": "o"}}'), (1, '{"xrefcode": "b", "Extra": 5}')],
                               "page_id long, t string").select("page_id", F.parse_json("t").alias("row"))
    out = roster.rows_to_struct(df)
    names = [c.lower() for c in out.columns]
    assert len(names) == len(set(names)) and "org" in names and "extra" in names
    assert out.filter(F.col("page_id") == 0).first()["Org"]["X"] == "o"


def test_only_changed_months_are_rewritten(spark):
    import datetime as dt
    from decimal import Decimal

    t = tables.StoredTable(spark, fresh(spark, "months-"), tables.DAY_SCHEMA, tables.month_part("Date"))

    def rows(*hours):
        data = [("A", dt.date(2031, m + 1, 3), Decimal(h), None, None, "Approved", f"h{m}", None, act) for m, (h, act) in enumerate(hours)]
        return spark.createDataFrame(data, tables.DAY_SCHEMA.simpleString()[7:-1].replace(":", " ") + ", merge_action string")

    def files():
        return {d: sorted(f for f in os.listdir(f"{t.path}/{d}") if f.endswith(".parquet")) for d in os.listdir(t.path) if d.startswith("part=")}

    assert t.changed_parts(rows((8, "keep"), (8, "noop"), (8, "unchanged"))) == []
    t.overwrite(rows((8, "insert"), (8, "insert")))
    before, second = files(), rows((8, "keep"), (4, "update"), (2, "insert"))
    assert t.changed_parts(second) == ["2031-02", "2031-03"]
    t.overwrite(second.where(t.part_column().isin(t.changed_parts(second))))
    after = files()
    assert set(after) == {"part=2031-01", "part=2031-02", "part=2031-03"}
    assert before["part=2031-01"] == after["part=2031-01"] and before["part=2031-02"] != after["part=2031-02"]
    assert {r["RecordHash"]: int(r["Hours"]) for r in t.read().collect()} == {"h0": 8, "h1": 4, "h2": 2}
    assert [r["RecordHash"] for r in t.read(["2031-02"]).collect()] == ["h1"]
    assert re.search(r"PartitionFilters: \[[^\]]*part#", t.read(["2031-02"])._jdf.queryExecution().executedPlan().toString())


def test_a_null_where_none_is_allowed_fails_the_write(spark):
    t = tables.StoredTable(spark, fresh(spark, "null-"), tables.EMPLOYEE_SCHEMA, tables.key_part("XRefCode"))
    good = spark.createDataFrame([("E1", None, None, None, None, None, None)], tables.EMPLOYEE_SCHEMA)
    t.overwrite(good)
    nulls = spark.createDataFrame([(None, "x")], "XRefCode string, employee_name string")
    with pytest.raises(Exception, match="null in NOT NULL column XRefCode"):
        t.overwrite(tables.typed(nulls, tables.EMPLOYEE_SCHEMA).unionByName(good))
    assert [r["XRefCode"] for r in t.read().collect()] == ["E1"]


def test_page_chains(spark):
    """First pages, a tail into a cycle, a cycle nothing leads to, merging chains, a gap, null urls, two pages of one url."""
    to = {1: "u2", 2: "u3", 3: "u4", 4: "u5", 5: "u3", 10: "u11", 11: "u10", 20: "u21", 21: "u22", 30: "u21", 40: "u99", 60: "u60"}
    ids = [*to, 22, 50]
    rows = [(i, None if i == 50 else f"u{i}", json.dumps({"Paging": {"Next": to.get(i, "")}})) for i in ids] + [(61, "u22", "{}")]
    p = spark.createDataFrame(rows, "page_id long, url string, t string").select("page_id", "url", F.parse_json("t").alias("page"))
    got = {r["page_id"]: tuple(r)[1:] for r in pages.page_chains(p).collect()}
    assert got == {
        1: (1, 0, False), 2: (1, 1, False), 3: (1, 2, True), 4: (1, 3, True), 5: (1, 4, True),
        10: (None, None, True), 11: (None, None, True), 60: (None, None, True),
        20: (20, 0, False), 30: (30, 0, False), 21: (20, 1, False), 22: (20, 2, False), 61: (61, 0, False),
        40: (40, 0, False), 50: (50, 0, False),
    }
    assert pages.page_chains(p.limit(0)).count() == 0


def test_a_long_chain(spark):
    n = 700
    p = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("u"), "id").alias("url"),
                              F.parse_json(F.concat(F.lit('{"Paging":{"Next":"u'), F.col("id") + 1, F.lit('"}}'))).alias("page"))
    got = pages.page_chains(p).agg(F.max("steps"), F.min("first_page"), F.max("first_page"), F.count_if("in_cycle")).first()
    assert tuple(got) == (n - 1, 0, 0, 0)


def test_names_that_are_null_blank_or_differ_in_case(spark):
    from ledgerfold.operators import roster

    texts = ['{"XRefCode":"emp-1","a b":1,"c":null,"d":{"x":null,"Y y":[{"k k":null}]},"A B":"z"}', '{"XRefCode":"emp-2\\u00a0","A b":"q","a b":7}']
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, t string").select("page_id", F.lit(0).alias("row_idx"), F.parse_json("t").alias("row"))
    out = roster.roster_frame_from_pages(df, "EMP")
    assert [c.lower() for c in out.columns] == ["xrefcode", "a b", "c", "d.y y", "d.x"]
    assert [r[1] for r in out.orderBy("XRefCode").collect()] == ["z", "q"]
