"""Reconcile truth table (J6-J9) and executed merges over several cycles (M1-M5)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.functions.identity import record_hash_normalized
from ledgerfold.operators import classify, merge
from ledgerfold.sources.tables import DAY_SCHEMA, EMPLOYEE_SCHEMA, LEDGER_SCHEMA, empty

CUR = T.StructType(
    [
        T.StructField("entry_idx", T.LongType()),
        T.StructField("day_idx", T.IntegerType()),
        T.StructField("employee_xref", T.StringType()),
        T.StructField("pto_date", T.DateType()),
        T.StructField("approval_type_code", T.StringType()),
        T.StructField("hours_requested", T.DecimalType(6, 2)),
    ]
)


def recs(spark, rows):
    data = [(i, 0, e, dt.date.fromisoformat(d), t, Decimal(str(h))) for i, (e, d, t, h) in enumerate(rows)]
    df = spark.createDataFrame(data, CUR)
    return df.withColumn(
        "record_hash", record_hash_normalized("employee_xref", "pto_date", "approval_type_code", "hours_requested")
    )


def ledger_of(spark, rows, now="2026-03-01 00:00:00"):
    return merge.ledger_rows(merge.ledger_apply(empty(spark, LEDGER_SCHEMA), recs(spark, rows), now=now, run_id="seed"))


def counts(c):
    return classify.action_counts(c).first().asDict()


def expected_actions(before, now):
    """The rules restated on plain tuples (key, day, type, hours): action per identity, counted."""
    out = dict.fromkeys(classify.ACTIONS, 0)
    for slot in {r[:2] for r in (*before, *now)}:
        old, new = ({r for r in rows if r[:2] == slot} for rows in (before, now))
        fresh, gone = new - old, old - new
        out["unchanged"] += len(old & new)
        out["changed" if gone else "new"] += len(fresh)
        out["superseded"] += bool(fresh and gone)
        out["cancelled"] += len(gone) - bool(fresh and gone)
    return out


def day_variants(day):
    """No row, one of three rows, or two of them on one day of one person."""
    some = [("JORIS", day, "ILL", 7.5), ("JORIS", day, "ILL", 2), ("JORIS", day, "MOVE", 7.5)]
    return [(), (some[0],), (some[1],), (some[2],), (some[0], some[1]), (some[1], some[2])]


def test_every_pair_of_day_states(spark):
    """All 36 transitions of one employee-day, each on a day of its own, in one reconcile."""
    before, now = [], []
    for i, (old, new) in enumerate((o, n) for o in range(6) for n in range(6)):
        variants = day_variants(str(dt.date(2031, 1, 1) + dt.timedelta(days=i)))
        before += variants[old]
        now += variants[new]
    c = classify.reconcile(recs(spark, now), ledger_of(spark, before))
    assert counts(c) == expected_actions(before, now)
    acts = expected_actions(before, now)
    assert classify.upserts(c).count() == acts["new"] + acts["changed"]
    assert classify.deactivations(c).count() == acts["cancelled"] + acts["superseded"]


def test_empty_sides(spark):
    rows = [("NOOR", "2031-05-02", "REST", 6), ("NOOR", "2031-05-03", "REST", 6)]
    none = empty(spark, LEDGER_SCHEMA)
    assert counts(classify.reconcile(recs(spark, rows), none)) == expected_actions([], rows)
    assert counts(classify.reconcile(recs(spark, []), ledger_of(spark, rows))) == expected_actions(rows, [])


def test_two_cycles_then_idempotent_then_reactivation(spark):
    c1 = [("EMP-001", "2026-03-16", "VAC", 8), ("EMP-001", "2026-03-20", "VAC", 8)]
    c2 = [("EMP-001", "2026-03-16", "VAC", 4), ("EMP-001", "2026-03-25", "VAC", 8)]
    l1 = merge.ledger_rows(merge.ledger_apply(empty(spark, LEDGER_SCHEMA), recs(spark, c1), now="2026-03-16 00:00:00", run_id="r1"))
    a2 = merge.ledger_apply(l1, recs(spark, c2), now="2026-03-17 00:00:00", run_id="r2").cache()
    assert counts(a2.filter(F.col("action").isNotNull())) == {
        "new": 1, "changed": 1, "unchanged": 0, "cancelled": 1, "superseded": 1
    }
    l2 = merge.ledger_rows(a2)
    assert l2.filter("is_active").count() == 2
    inactive = l2.filter("not is_active").collect()
    assert len(inactive) == 2 and all(r["deleted_at"] is not None for r in inactive)
    # same cycle twice with the same stamp: nothing moves
    again = merge.ledger_apply(l2, recs(spark, c2), now="2026-03-17 00:00:00", run_id="r2b")
    st = merge.ledger_counts(again).first().asDict()
    assert st == {"inserted": 0, "updated": 0, "reactivated": 0, "touched": 0, "cancelled": 0}
    # cycle 1 returns: both retired rows come back, keeping first_seen_at
    a3 = merge.ledger_apply(l2, recs(spark, c1), now="2026-03-18 00:00:00", run_id="r3")
    st3 = merge.ledger_counts(a3).first().asDict()
    assert st3["reactivated"] == 2 and st3["cancelled"] == 2
    back = a3.filter(F.col("merge_action") == "reactivate").collect()
    assert all(str(r["first_seen_at"]).startswith("2026-03-16") for r in back)


def test_seen_rows_are_touched_once(spark):
    rows = [("E1", "2026-03-01", "VAC", 8)]
    l1 = ledger_of(spark, rows, now="2026-03-01 00:00:00")
    a = merge.ledger_apply(l1, recs(spark, rows), now="2026-03-02 00:00:00", run_id="r")
    assert merge.ledger_counts(a).first()["touched"] == 1


# --- M2 employee upsert ---------------------------------------------------------
def emp(spark, rows, stamp=None):
    sch = EMPLOYEE_SCHEMA
    data = [(x, n, d, p, t, s, stamp) for x, n, d, p, t, s in rows]
    return spark.createDataFrame(data, sch)


def test_employee_merge_stamp_rules(spark):
    t0 = dt.datetime(2026, 1, 1)
    target = emp(spark, [("E1", "Ann", "D1", 1, 1, "ACTIVE"), ("E2", "Bob", "D1", 1, 1, "ACTIVE"),
                         ("E3", "Cy", "D1", 1, 1, "ACTIVE"), ("E9", "Gone", "D1", 1, 1, "ACTIVE")], stamp=t0)
    src = emp(spark, [("E1", "Ann B", "D1", 1, 1, "ACTIVE"), ("E2", "Bob", "D1", 1, 1, "TERMINATED"),
                      ("E3", "Cy", "D1", 1, 1, "ACTIVE"), ("E4", "Dee", "D2", 2, 2, None)]).drop("UpdatedDateTime")
    m = {r["XRefCode"]: r for r in merge.employee_merge(target, src, now="2026-02-01 00:00:00").collect()}
    assert m["E1"]["merge_action"] == "update" and m["E1"]["UpdatedDateTime"] == t0  # name change keeps stamp
    assert m["E2"]["merge_action"] == "update" and m["E2"]["UpdatedDateTime"] != t0  # status change moves it
    assert m["E3"]["merge_action"] == "unchanged" and m["E4"]["merge_action"] == "insert"
    assert m["E9"]["merge_action"] == "keep"  # leavers stay (Q17)


# --- M3 day-table upsert --------------------------------------------------------
def day_rows(spark, rows, stamp=None):
    data = [(x, dt.date.fromisoformat(d), Decimal(h), r, p, s, hsh, stamp) for x, d, h, r, p, s, hsh in rows]
    return spark.createDataFrame(data, DAY_SCHEMA)


def test_day_merge_scoped_cancel(spark):
    t0 = dt.datetime(2026, 1, 1)
    target = day_rows(spark, [
        ("A", "2026-03-02", "8.00", "Vac", "VAC", "Approved", "h1"),
        ("A", "2026-03-03", "8.00", "Vac", "VAC", "Approved", "h2"),   # missing, in scope → cancel
        ("B", "2026-03-03", "8.00", "Vac", "VAC", "Approved", "h3"),   # other employee → keep
        ("A", "2026-06-03", "8.00", "Vac", "VAC", "Approved", "h4"),   # outside window → keep
    ], stamp=t0)
    src = day_rows(spark, [
        ("A", "2026-03-02", "8.00", "Vac", "VAC", "Canceled", "h1"),   # status differs → update
        ("A", "2026-03-04", "8.00", "Vac", "VAC", "Approved", "h5"),   # new → insert
    ]).drop("UpdatedDateTime")
    keys = spark.createDataFrame([("A",)], "XRefCode string")
    m = {r["RecordHash"]: r for r in merge.day_merge(target, src, now="2026-03-10 00:00:00", run_keys=keys,
                                                      window_start="2026-03-01", window_end="2026-03-31").collect()}
    assert m["h1"]["merge_action"] == "update" and m["h1"]["Status"] == "Canceled"
    assert m["h2"]["merge_action"] == "cancel" and m["h2"]["Status"] == "Canceled"
    assert m["h3"]["merge_action"] == "keep" and m["h4"]["merge_action"] == "keep"
    assert m["h5"]["merge_action"] == "insert"
    none = spark.createDataFrame([], "XRefCode string")
    m2 = merge.day_merge(target, src, now="2026-03-10 00:00:00", run_keys=none,
                         window_start="2026-03-01", window_end="2026-03-31")
    assert m2.filter(F.col("merge_action") == "cancel").count() == 0  # empty key set cancels nothing (M4)


def test_merge_source_must_be_unique(spark):
    """Q20: a key with two source rows raises while the merge runs, whatever the rows' order."""
    src = emp(spark, [("E1", "A", "D", 1, 1, "ACTIVE"), ("E1", "B", "D", 1, 1, "ACTIVE"), ("E2", "C", "D", 1, 1, None)])
    with pytest.raises(Exception, match=r"not unique on \['XRefCode'\]: E1"):
        merge.employee_merge(empty(spark, EMPLOYEE_SCHEMA), src, now="2026-02-01 00:00:00").collect()
    assert merge.employee_merge(empty(spark, EMPLOYEE_SCHEMA), src.where("employee_name != 'B'"), now="2026-02-01 00:00:00").count() == 2


def test_two_level_summary_and_window_classify_identically(spark):
    prev = [("E1", "2026-03-01", "VAC", 8), ("E1", "2026-03-01", "VAC", 4), ("E1", "2026-03-02", "VAC", 8),
            ("E2", "2026-03-03", "VAC", 8)]
    cur = [("E1", "2026-03-01", "VAC", 2), ("E1", "2026-03-02", "VAC", 8), ("E3", "2026-03-04", "SICK", 8),
           ("E1", "2026-03-01", "PERS", 1)]
    stored = ledger_of(spark, prev)
    keys = ["employee_xref", "pto_date", "record_hash", "action"]

    def rows(**kw):
        return sorted(map(tuple, classify.reconcile(recs(spark, cur), stored, **kw).select(keys).collect()))

    base = rows()
    assert rows(hot_keys=True) == base
    applied = merge.ledger_apply(stored, recs(spark, cur), now="2026-03-05 00:00:00", run_id="r")
    assert sorted(map(tuple, applied.where("action IS NOT NULL").select(keys).collect())) == base


def hot_day(spark, n, first, hot):
    """``n`` records, a share ``hot`` of them on one employee-day, told apart by their type code."""
    k = F.col("id")
    is_hot = k % 100 < 100 * hot
    df = spark.range(first, first + n).select(
        k.alias("entry_idx"), F.lit(0).alias("day_idx"),
        F.when(is_hot, F.lit("HOT")).otherwise(F.concat(F.lit("E"), (k % 500).cast("string"))).alias("employee_xref"),
        F.when(is_hot, F.lit("2031-01-01")).otherwise(F.date_add(F.lit("2031-01-01").cast("date"), (k % 300).cast("int")).cast("string")).cast("date").alias("pto_date"),
        F.concat(F.lit("T"), k.cast("string")).alias("approval_type_code"), F.lit("8").cast("decimal(6,2)").alias("hours_requested"))
    return df.withColumn("record_hash", record_hash_normalized("employee_xref", "pto_date", "approval_type_code", "hours_requested"))


def test_a_third_of_all_records_on_one_employee_day(spark):
    """The first level spreads the hot day over salts; what meets in one group of the second is one row a salt."""
    n = 12_000
    before, now = hot_day(spark, n, 0, 0.34), hot_day(spark, n, n // 2, 0.34)
    stored = merge.ledger_rows(merge.ledger_apply(empty(spark, LEDGER_SCHEMA), before, now="2031-02-01 00:00:00", run_id="a"))
    ident = classify.settled(classify.identities(now, stored))
    moved = ident.where("fresh OR gone")
    salted = moved.groupBy(*classify.NATURAL_KEY, F.pmod(F.xxhash64("record_hash"), F.lit(classify.SALTS)).alias("salt")).count()
    sizes = [r["count"] for r in salted.where("employee_xref = 'HOT'").collect()]
    assert len(sizes) == classify.SALTS and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    got = sorted(map(tuple, classify.paired(ident).where("action IS NOT NULL").groupBy("action").count().collect()))
    want = sorted(map(tuple, classify.reconcile(now, stored).groupBy("action").count().collect()))
    assert got == want and sum(c for _, c in got) == n + n // 2
    plan = classify.paired(ident)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_one_identity_of_two_texts_stops_the_cycle(spark):
    """A planted collision, within the snapshot and against the ledger, raises; equal copies don't."""
    rows = [("E1", "2026-03-01", "VAC", 8), ("E1", "2026-03-01", "SICK", 8)]
    clash = recs(spark, rows).withColumn("record_hash", F.lit("00000000000000aa"))
    with pytest.raises(Exception, match="two records share the identity 00000000000000aa"):
        merge.ledger_apply(empty(spark, LEDGER_SCHEMA), clash, now="2026-03-02 00:00:00", run_id="r")
    stored = merge.ledger_rows(merge.ledger_apply(empty(spark, LEDGER_SCHEMA), clash.limit(1), now="2026-03-02 00:00:00", run_id="r"))
    other = clash.where(F.col("approval_type_code") != stored.first()["approval_type_code"])
    with pytest.raises(Exception, match="two records share the identity"):
        merge.ledger_apply(stored, other, now="2026-03-03 00:00:00", run_id="r")
    assert merge.ledger_apply(stored, clash.limit(1).unionByName(clash.limit(1)), now="2026-03-03 00:00:00", run_id="r").first()["merge_action"] == "touch"


def test_payload_is_not_shuffled_before_the_action_is_known(spark):
    """M1: the narrow side has no payload, and of the snapshot only rows to write are exchanged."""
    rows = [("E1", "2026-03-01", "VAC", 8), ("E1", "2026-03-02", "VAC", 8)]
    current = recs(spark, rows).withColumn("source_payload", F.lit("x"))
    stored = ledger_of(spark, rows[:1])
    narrow = merge.identities(current, stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "source_payload" not in narrow.split("Aggregate", 1)[1].split("LocalRelation")[0].split("LogicalRDD")[0]
    applied = merge.ledger_apply(stored, current, now="2026-03-05 00:00:00", run_id="r")
    assert {r["merge_action"]: r["source_payload"] for r in applied.collect()} == {"touch": None, "insert": "x"}


def test_day_merge_reads_only_months_it_may_change(spark):
    from ledgerfold.plans import jobs

    t0 = dt.datetime(2026, 1, 1)
    table = jobs.day_table(spark, "days-months")
    table.overwrite(day_rows(spark, [
        ("A", "2026-03-02", "8.00", "Vac", "VAC", "Approved", "h1"),
        ("A", "2026-06-03", "8.00", "Vac", "VAC", "Approved", "h4"),
        ("A", "2025-06-03", "8.00", "Vac", "VAC", "Approved", "h6"),
    ], stamp=t0))
    src = day_rows(spark, [("A", "2026-06-03", "8.00", "Vac", "VAC", "Canceled", "h4"), ("B", "2024-01-31", "8.00", None, None, "Approved", "h9")])
    keys = spark.createDataFrame([("A",)], "XRefCode string")
    merged, parts = merge.day_merge_stored(table, src, now="2026-03-10 00:00:00", run_keys=keys, window_start="2026-02-27", window_end="2026-03-31")
    assert parts == ["2024-01", "2026-02", "2026-03", "2026-06"]
    assert {r["RecordHash"]: r["merge_action"] for r in merged.collect()} == {"h1": "cancel", "h4": "update", "h9": "insert"}
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan and "2026-06" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]


def test_bucketed_ledger_is_not_exchanged(spark):
    """The identity join exchanges the snapshot alone, and so does the row join the actions; results are those of the plain table."""
    import uuid

    from ledgerfold.plans import jobs

    tag = uuid.uuid4().hex[:8]
    table = jobs.bucketed_ledger(spark, f"lf_bucketed_{tag}")
    before = [(f"E{i}", f"2031-0{1 + i % 4}-03", "VAC", 8) for i in range(60)]
    now = before[:40] + [(e, d, "SICK", 4) for e, d, *_ in before[40:50]] + [("NEW", "2031-05-01", "VAC", 8)]
    table.overwrite(ledger_of(spark, before))
    ident = merge.identities(recs(spark, now), table.read(), copartitioned=True)
    plan = ident._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert sorted(map(tuple, ident.collect())) == sorted(map(tuple, merge.identities(recs(spark, now), ledger_of(spark, before)).collect()))
    actions = merge.ledger_actions(table.read(), recs(spark, now), now="2031-06-01 00:00:00", copartitioned=True)
    table.overwrite(merge.ledger_next(table.read(), recs(spark, now), actions, now="2031-06-01 00:00:00", run_id="r"))
    want = merge.ledger_rows(merge.ledger_apply(ledger_of(spark, before), recs(spark, now), now="2031-06-01 00:00:00", run_id="r"))
    columns = [c for c in want.columns]
    assert sorted(map(str, table.read().select(columns).collect())) == sorted(map(str, want.collect()))
    spark.sql(f"DROP TABLE lf_bucketed_{tag}")


def in_two_steps(stored, current, now, run_id):
    """The apply by narrow actions and rows fetched after them."""
    return merge.ledger_next(stored, current, classify.settled(merge.ledger_actions(stored, current, now=now)), now=now, run_id=run_id)


def test_cycles_exchange_each_snapshot_once(spark):
    """M1: three cycles as one plan give the rows of three settled ones, and nothing is exchanged but the three snapshots and the first ledger."""
    days = [f"2031-0{1 + i % 3}-{1 + i % 5:02d}" for i in range(40)]
    one = [(f"E{i % 9}", d, "VAC", 1 + i % 4) for i, d in enumerate(days)]
    two = one[10:] + one[12:14] + [("E1", "2031-01-01", "SICK", 2), ("E99", "2031-04-01", "VAC", 2)]
    plan, want = empty(spark, LEDGER_SCHEMA), empty(spark, LEDGER_SCHEMA)
    for c, rows in enumerate((one, two, one), 1):
        now = f"2031-06-0{c} 00:00:00"
        applied = merge.ledger_apply(plan, recs(spark, rows), now=now, run_id=f"r{c}", settle=False)
        plan = merge.ledger_rows(applied, dealt=True)
        expected = in_two_steps(want, recs(spark, rows), now, f"r{c}")
        want = classify.settled(merge.ledger_rows(expected))
        assert sorted(map(str, applied.drop(merge.MONTH).collect())) == sorted(map(str, expected.collect()))
    text = applied._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == text.count("Exchange hashpartitioning(employee_xref") == 4


def test_apply_keeps_stored_copies_and_rows_without_a_whole_identity(spark):
    """Stored rows that come twice take one action, those that lack a part of their identity none; such a snapshot row is left out."""
    stored = ledger_of(spark, [("E1", "2031-01-01", "VAC", 8), ("E1", "2031-01-02", "VAC", 8), ("E2", "2031-01-03", "VAC", 8)])
    stored = stored.unionByName(stored.withColumn("is_active", F.when(F.col("pto_date") == "2031-01-02", F.lit(False)).otherwise(F.lit(None).cast("boolean"))))
    stored = stored.unionByName(stored.limit(1).withColumn("employee_xref", F.lit(None).cast("string"))).unionByName(stored.limit(1).withColumn("record_hash", F.lit(None).cast("string")))
    now = recs(spark, [("E1", "2031-01-01", "VAC", 8), ("E1", "2031-01-02", "SICK", 8), ("E3", "2031-01-02", "SICK", 8)])
    now = now.unionByName(now.limit(1).withColumn("pto_date", F.lit(None).cast("date")))
    stored = classify.settled(stored)
    got = merge.ledger_apply(stored, now, now="2031-02-01 00:00:00", run_id="r")
    want = in_two_steps(stored, now, "2031-02-01 00:00:00", "r")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def snapshot(spark, rows):
    """Requests of one day each: (entry, employee, day, type, hours)."""
    data = [(i, e, f"{d}T00:00:00", t, "APPROVED", float(h)) for i, e, d, t, h in rows]
    return spark.createDataFrame(data, "entry_idx bigint, employee_key string, TimeStart string, ReasonName string, Status string, NetHours double")


def test_a_bucketed_cycle_exchanges_its_snapshot_once(spark):
    """the rows of a bucketed cycle come from one exchange of the snapshot, and rows and counters are those of the plain table."""
    import os
    import uuid

    from pyspark.sql import Observation

    from ledgerfold.operators import expand
    from ledgerfold.plans import cycle, jobs
    from ledgerfold.session import shared_dir

    one = [(i, f"E{i % 7}", f"2031-0{1 + i % 4}-{1 + i % 9:02d}", "VAC", 8) for i in range(40)]
    two = one[8:] + [(50, "E1", one[1][2], "SICK", 4), (51, "E9", "2031-06-01", "VAC", 8), (52, "E9", "2031-06-01", "VAC", 8)]
    tag, at = uuid.uuid4().hex[:8], shared_dir(spark).removeprefix("file:")
    plain, bucketed = jobs.ledger_table(spark, f"ledger-{tag}"), jobs.bucketed_ledger(spark, f"lf_once_{tag}")
    for c, rows in enumerate((one, two, two, one), 1):
        # the third cycle repeats the second with its stamp
        cfg = cycle.LedgerCycle(now=f"2031-07-0{2 if c == 3 else c} 00:00:00", run_id=f"r{c}")
        want = cycle.run_ledger_cycle(plain, snapshot(spark, rows), cfg, pages=None)
        seen = set(os.listdir(at))
        got = cycle.run_ledger_cycle(bucketed, snapshot(spark, rows), cfg, pages=None)
        assert not {n.rsplit("-", 1)[0] for n in set(os.listdir(at)) - seen} & {"days", "identities", "actions"}
        assert got.rows.columns == want.rows.columns
        assert sorted(map(str, got.rows.collect())) == sorted(map(str, want.rows.collect()))
        assert {k: v for k, v in got.metrics.items() if k != "duration_s"} == {k: v for k, v in want.metrics.items() if k != "duration_s"}
    days = expand.ledger_days(snapshot(spark, two))
    plan = merge.bucketed_next(bucketed.read(), days, now="2031-08-01 00:00:00", run_id="r", buckets=bucketed.buckets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Exchange hashpartitioning(employee_xref") == 1 and "Bucketed: true" in plan
    held = spark.createDataFrame([("E1",)], "employee_xref string")
    before = {r["record_hash"]: r.asDict() for r in bucketed.read().where("employee_xref = 'E1'").collect()}
    days = expand.ledger_days(snapshot(spark, [r for r in two if r[1] != "E1"]))
    rows = cycle._replaced_in_buckets(bucketed, days, held, cycle.LedgerCycle(now="2031-08-01 00:00:00", run_id="h"), Observation())
    kept = rows.where("employee_xref = 'E1'").collect()
    assert before and {r["record_hash"]: {k: v for k, v in r.asDict().items() if k not in ("action", "merge_action")} for r in kept} == before
    assert {(r["action"], r["merge_action"]) for r in kept} == {(None, "keep")} and rows.where("merge_action = 'touch'").count() > 0
    spark.sql(f"DROP TABLE lf_once_{tag}")


def test_a_bucketed_cycle_expands_its_snapshot_once_and_replaces_changed_months(spark):
    """the days are computed once a cycle, months without a changed row keep their files, and of the actions only renamed ones are exchanged."""
    import os
    import uuid

    from ledgerfold.operators import expand
    from ledgerfold.plans import cycle, jobs
    from ledgerfold.session import shared_dir

    rows = [(i, f"E{i % 5}", f"2031-0{1 + i % 4}-{1 + i % 9:02d}", "VAC", 8) for i in range(40)]
    tag, at = uuid.uuid4().hex[:8], shared_dir(spark).removeprefix("file:")
    plain, table = jobs.ledger_table(spark, f"ledger-{tag}"), jobs.bucketed_ledger(spark, f"lf_kept_{tag}")

    def files():
        return {f for _, _, names in os.walk(f"{at}/lf_kept_{tag}") for f in names if f.startswith("part-")}

    cfg = cycle.LedgerCycle(now="2031-07-01 00:00:00", run_id="a")
    expanded = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(key):
        expanded.add(1)
        return key

    requests = snapshot(spark, rows).cache()
    requests.count()
    cycle.run_ledger_cycle(table, requests.withColumn("employee_key", seen(F.col("employee_key"))), cfg, pages=None)
    assert expanded.value == len(rows)
    assert cycle.run_ledger_cycle(plain, requests, cfg, pages=None).rows.count() == table.read().count()
    # as one that was stored twice, and one that isn't active
    double = table.read().where("pto_date = '2031-01-01'")
    more = double.unionByName(double.limit(1).withColumns({"pto_date": F.lit("2031-05-01").cast("date"), "is_active": F.lit(False)}))
    for t in (plain, table):
        t.overwrite(t.read().where("pto_date < '2031-02-01'").unionByName(more))
    before = files()
    again = cycle.run_ledger_cycle(table, requests, cfg, pages=None)
    assert files() == before and again.metrics["touched"] == 0 and again.metrics["unchanged"] == len({r[1:] for r in rows})
    two = snapshot(spark, [r for r in rows if r[2] != "2031-01-01"] + [(90, rows[4][1], rows[4][2], "SICK", 2), (91, rows[0][1], rows[0][2], "SICK", 2)])
    cfg = cycle.LedgerCycle(now="2031-07-02 00:00:00", run_id="b")
    got, want = cycle.run_ledger_cycle(table, two, cfg, pages=None), cycle.run_ledger_cycle(plain, two, cfg, pages=None)
    assert sorted(map(str, got.rows.collect())) == sorted(map(str, want.rows.collect()))
    actions = got.rows.select(*merge.IDENTITY, "action").distinct().groupBy("action").count().collect()
    assert {r["action"]: r["count"] for r in actions if r["action"]} == {k: got.metrics[k] for k in classify.ACTIONS if got.metrics[k]}
    assert got.metrics["superseded"] > 0 and got.metrics["changed"] > 0
    kept = {f for f in files() if f in before}
    assert kept and kept == {f for _, _, names in os.walk(f"{at}/lf_kept_{tag}/part=2031-05") for f in names if f.startswith("part-")}
    days = expand.ledger_days(two)
    applied = table.aside(merge.bucketed_next(table.read(), days, now="2031-08-01 00:00:00", run_id="r", buckets=table.buckets), "applied")
    named = table.aside(table.dealt(merge.renamed_actions(applied)), "named")
    plan = merge.with_actions(applied, named)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and plan.count("Bucketed: true") == 2
    spark.sql(f"DROP TABLE lf_kept_{tag}")


def test_a_table_of_one_file_is_dealt_out_as_a_shuffle_is(spark, tmp_path):
    """what a task derives from its part is exchanged, so parts shrink as a shuffle's do; with as many as there are cores, tasks of a large table spilled."""
    from ledgerfold.plans import derive

    spark.range(500).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    before, parts = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.defaultParallelism + 29
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        dealt = derive.table(spark, str(tmp_path), "orders", spread=True)
        assert dealt.select(F.spark_partition_id()).distinct().count() == parts and dealt.count() == 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
