"""Query catalog over the driver's tables: one entry per SURVEY §2 item group.

Every query reads whole driver tables (through :mod:`ledgerfold.plans.derive`)
and returns a DataFrame whose column names and types match the DuckDB text in
:mod:`ledgerfold.plans.oracle`. Timestamps are returned as
``yyyy-MM-dd HH:mm:ss`` text so both engines render them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions import identity as idf
from ledgerfold.functions import values as vf
from ledgerfold.operators import classify, dedupe, expand, merge, roster
from ledgerfold.functions import items as it
from ledgerfold.sources import mapping, pages, tables, windows
from ledgerfold.plans import derive
from ledgerfold.sources.tables import DAY_SCHEMA, EMPLOYEE_SCHEMA, LEDGER_SCHEMA, empty, settled

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# --- fixed values: stamps of the simulated cycles (never the wall clock) ----
NOW1 = "2026-03-16 06:00:00"
NOW2 = "2026-03-17 06:00:00"
NOW3 = "2026-03-18 06:00:00"
# ---------------------------------------------------------------------------
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def ts_text(c) -> Column:
    return F.date_format(c if isinstance(c, Column) else F.col(c), TS_TEXT)


# --------------------------------------------------------------------------- #
# Shared building blocks                                                      #
# --------------------------------------------------------------------------- #
def ledger_days(spark: SparkSession, sf: str, cycle: int, multi: bool = True) -> DataFrame:
    return expand.ledger_days(derive.requests(spark, sf, cycle), expand_multi_day=multi)


def ledger_after(spark: SparkSession, sf: str, cycles: int) -> DataFrame:
    """Ledger rows after ``cycles`` simulated runs (cycle 3 repeats cycle 1)."""
    led = empty(spark, LEDGER_SCHEMA)
    for c in range(1, cycles + 1):
        led = merge.ledger_rows(_applied(spark, sf, led, c), dealt=True)
    return led


def identities_after(spark: SparkSession, sf: str) -> DataFrame:
    """Identities of the ledger after the first run, all that a reconcile reads of it."""
    actions = merge.ledger_actions(empty(spark, LEDGER_SCHEMA), ledger_days(spark, sf, 1), now=NOW1)
    return merge.stored_after(actions, now=NOW1)


def _applied(spark: SparkSession, sf: str, stored: DataFrame, cycle: int) -> DataFrame:
    """One cycle's apply, as a plan: the cycles follow one another in the tasks that hold their rows, and each snapshot is exchanged once."""
    stamps = {1: NOW1, 2: NOW2, 3: NOW3}
    return merge.ledger_apply(stored, ledger_days(spark, sf, cycle), now=stamps[cycle], run_id=f"run-{cycle}", settle=False)


def apply_cycle(spark: SparkSession, sf: str, cycle: int) -> DataFrame:
    return _applied(spark, sf, ledger_after(spark, sf, cycle - 1), cycle)


LEDGER_OUT = [
    "record_hash",
    "employee_xref",
    "pto_date",
    "approval_type_code",
    "hours_requested",
    "reason_name",
    "status",
    "is_active",
    "ingest_run_id",
]


def ledger_view(df: DataFrame) -> DataFrame:
    extra = [c for c in ("action", "merge_action") if c in df.columns]
    return df.select(
        *LEDGER_OUT,
        ts_text("first_seen_at").alias("first_seen_at"),
        ts_text("last_seen_at").alias("last_seen_at"),
        ts_text("deleted_at").alias("deleted_at"),
        *extra,
    )


DAY_OUT = [
    "entry_idx",
    "day_idx",
    "day_source",
    "employee_xref",
    "pto_date",
    "approval_type_code",
    "hours_requested",
    "reason_name",
    "status",
    "record_hash",
]


# --------------------------------------------------------------------------- #
# H: identity and scalar functions                                            #
# --------------------------------------------------------------------------- #
@query("identity_hash")
def identity_hash(spark, sf):
    """Canonical text and 16-hex identity of every order as a day."""
    o = derive.table(spark, sf, "orders", spread=True)
    k = F.col("o_orderkey")
    key = F.concat(F.lit(" emp-"), F.col("o_custkey").cast("string"), F.lit(" "))
    typ = F.concat(F.lit("  "), F.lower("o_orderpriority"))
    hours = F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise((k % 80) / 4 + 0.125)
    return o.select(
        k.alias("o_orderkey"),
        idf.canonical_string(key, F.col("o_orderdate"), typ, hours).alias("canonical"),
        idf.record_hash(key, F.col("o_orderdate"), typ, hours).alias("record_hash"),
    )


@query("hours_half_even")
def hours_half_even(spark, sf):
    """H4: half-even 2-dp hours from numbers and from padded text; negatives → null."""
    li = derive.table(spark, sf, "lineitem", spread=True)
    raw = F.col("l_quantity") / 8 + F.col("l_discount") - 1
    return li.select(
        "l_orderkey",
        "l_linenumber",
        idf.norm_hours(raw).alias("hours"),
        idf.norm_hours(F.concat(F.lit(" "), raw.cast("string"), F.lit(" "))).alias("hours_from_text"),
        idf.norm_hours_text(F.col("l_quantity") / 8).alias("hours_text"),
    )


# --------------------------------------------------------------------------- #
# X: expansion                                                                #
# --------------------------------------------------------------------------- #
@query("expand_daylist")
def expand_daylist(spark, sf):
    """Requests carrying a usable per-day list, one row per listed day."""
    d = ledger_days(spark, sf, 0, multi=False)
    return d.filter(F.col("day_source") == "list").select(*DAY_OUT)


@query("expand_even")
def expand_even(spark, sf):
    """X2 + W3: even split over calendar days, end inclusive, remainder on the last day."""
    d = ledger_days(spark, sf, 0, multi=True)
    return d.filter(F.col("day_source") == "spread").select(*DAY_OUT)


@query("expand_choice")
def expand_choice(spark, sf):
    """X4 + P13-P18: list → even split → single day, every valid request of cycle 1."""
    return ledger_days(spark, sf, 0, multi=True).select(*DAY_OUT)


@query("expand_single")
def expand_single(spark, sf):
    """X4 without the multi-day option: list → single day on the start date."""
    return ledger_days(spark, sf, 0, multi=False).select(*DAY_OUT)


@query("expand_quarantine")
def expand_quarantine(spark, sf):
    """Requests rejected as a whole, with the reason."""
    r = expand.rejected_entries(derive.requests(spark, sf, 0), expand_multi_day=True)
    return r.select("entry_idx", "employee_key", "reject_reason")


@query("expand_weekdays")
def expand_weekdays(spark, sf):
    """X3 + P21 + H10: tagged requests → weekday rows of the day table (before dedupe)."""
    return expand.weekday_days(derive.tagged_requests(spark, sf, 0))


@query("weekday_quarantine")
def weekday_quarantine(spark, sf):
    """Q8 + P14 for the day-table flow: tagged requests that cannot be expanded, with the reason."""
    r = expand.weekday_rejects(derive.tagged_requests(spark, sf, 0))
    return r.select("status_rank", "entry_idx", "_XRefCode", "reject_reason")


@query("split_sum_check")
def split_sum_check(spark, sf):
    """A10: per split request, days and split total vs the request's rounded total."""
    d = ledger_days(spark, sf, 0, multi=True).filter(F.col("day_source") == "spread")
    per = d.groupBy("entry_idx").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_days"),
        F.sum("hours_requested").cast("decimal(12,2)").alias("split_total"),
    )
    req = derive.requests(spark, sf, 0).select(
        "entry_idx", idf.norm_hours(F.coalesce(F.col("NetHours"), F.lit(0.0))).cast("decimal(12,2)").alias("entry_total")
    )
    j = per.join(req, "entry_idx")
    return j.withColumn("preserved", F.col("split_total") == F.col("entry_total"))


# --------------------------------------------------------------------------- #
# A / W: collapses                                                            #
# --------------------------------------------------------------------------- #
@query("dedupe_first")
def dedupe_first(spark, sf):
    """One lineitem per (order, line), first by a total order of the other columns."""
    li = derive.table(spark, sf, "lineitem")
    order = [
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    ]
    return dedupe.first_wins(li, ["l_orderkey", "l_linenumber"], order)


@query("dedupe_day_records")
def dedupe_day_records(spark, sf):
    """A1 on day records: one row per identity, the earliest (entry, day) wins."""
    d = ledger_days(spark, sf, 0, multi=True).select(*DAY_OUT)
    return dedupe.dedupe_day_records(d, order=("entry_idx", "day_idx"))


# --------------------------------------------------------------------------- #
# Reconcile                                                            #
# --------------------------------------------------------------------------- #
@query("reconcile_actions")
def reconcile_actions(spark, sf):
    """Cycle 2 against the ledger of cycle 1, one row per identity with its action."""
    c = classify.reconcile(ledger_days(spark, sf, 2), identities_after(spark, sf))
    return c.select("employee_xref", "pto_date", "record_hash", "action")


@query("reconcile_actions_hot_keys")
def reconcile_actions_hot_keys(spark, sf):
    """J6-J9 with the hot-key plan (natural-key summary as partial aggregate + join back)."""
    c = classify.reconcile(ledger_days(spark, sf, 2), identities_after(spark, sf), hot_keys=True)
    return c.select("employee_xref", "pto_date", "record_hash", "action")


@query("reconcile_counts")
def reconcile_counts(spark, sf):
    """A4: class counts of cycle 2."""
    return classify.action_counts(classify.reconcile(ledger_days(spark, sf, 2), identities_after(spark, sf)))


@query("snapshot_overlap")
def snapshot_overlap(spark, sf):
    """U4 + A11: distinct identities of both snapshots and their overlap (one full-outer join)."""
    h1 = ledger_days(spark, sf, 1).select("record_hash").distinct().withColumn("in1", F.lit(True))
    h2 = ledger_days(spark, sf, 2).select("record_hash").distinct().withColumn("in2", F.lit(True))
    j = h1.join(h2, "record_hash", "full_outer")
    both = F.col("in1").isNotNull() & F.col("in2").isNotNull()
    return j.agg(
        F.count_if(F.col("in1").isNotNull()).cast("bigint").alias("n_cycle1"),
        F.count_if(F.col("in2").isNotNull()).cast("bigint").alias("n_cycle2"),
        F.count_if(both).cast("bigint").alias("n_both"),
        (F.count_if(both) == 0).alias("disjoint"),
    )


# --------------------------------------------------------------------------- #
# M1 / M5: ledger                                                             #
# --------------------------------------------------------------------------- #
@query("ledger_apply")
def ledger_apply(spark, sf):
    """M1 + J11 + P19 + P24: the ledger after cycle 2, with each row's merge action."""
    return ledger_view(apply_cycle(spark, sf, 2))


@query("ledger_reactivate")
def ledger_reactivate(spark, sf):
    """M5: cycle 3 repeats cycle 1; retired rows come back, keeping first_seen_at."""
    return ledger_view(apply_cycle(spark, sf, 3))


@query("ledger_stats")
def ledger_stats(spark, sf):
    """Exact merge counters of cycles 1-3."""
    seen, led = {1: Observation(), 2: Observation()}, empty(spark, LEDGER_SCHEMA)
    for c in (1, 2, 3):
        applied = _applied(spark, sf, led, c)
        if c in seen:
            applied = applied.observe(seen[c], *merge.count_columns("merge_action", merge.LEDGER_COUNTERS))
        led = merge.ledger_rows(applied, dealt=True)
    # the cycles run once, in the stage that writes; the earlier ones are counted on their way through
    last = merge.ledger_counts(settled(applied.select("merge_action"), "applied")).select(F.lit(3).alias("cycle"), "*")
    earlier = [(c, *[o.get[name] for name in merge.LEDGER_COUNTERS]) for c, o in seen.items()]
    return spark.createDataFrame(earlier, last.schema).unionByName(last)


@query("hash_collisions")
def hash_collisions(spark, sf):
    """Identities whose 16-hex prefix is shared by more than one canonical text."""
    d = ledger_days(spark, sf, 0)
    canon = F.concat_ws(
        "|", "employee_xref", F.col("pto_date").cast("string"), "approval_type_code",
        F.col("hours_requested").cast("string"),
    )
    g = d.groupBy("record_hash").agg(F.count_distinct(canon).cast("bigint").alias("n_texts"))
    return g.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_hashes"),
        F.count_if(F.col("n_texts") > 1).cast("bigint").alias("n_colliding"),
    )


@query("hash_migrate_v1")
def hash_migrate_v1(spark, sf):
    """H7: a full 64-hex (v1) digest migrates to its 16-hex prefix, equal to the v2 hash."""
    d = ledger_days(spark, sf, 0)
    canon = F.concat_ws(
        "|", "employee_xref", F.col("pto_date").cast("string"), "approval_type_code",
        F.col("hours_requested").cast("string"),
    )
    v1 = F.sha2(canon, 256)
    return d.select(
        "entry_idx",
        "day_idx",
        idf.migrate_v1_hash(v1).alias("migrated"),
        (idf.migrate_v1_hash(v1) == F.col("record_hash")).alias("matches_v2"),
    )


# --------------------------------------------------------------------------- #
# S13 / P / J: roster, detail payloads, mapping                               #
# --------------------------------------------------------------------------- #
PREFIX = "EMP"
AS_OF_PAST = "2023-06-01"
AS_OF_NOW = "2026-06-01"
AS_OF_EARLY = "2018-06-01"


def details(spark, sf) -> DataFrame:
    return roster.parse_details(derive.employee_details(spark, sf))


def dept_map(spark, sf) -> DataFrame:
    return mapping.load(derive.department_map_rows(spark, sf), strict=False)


@query("roster_scope")
def roster_scope(spark, sf):
    """S24 = P1 + A2 + P2 + P3: in-prefix roster, first row per key, flattened and ordered."""
    return roster.roster_frame(derive.roster_rows(spark, sf), PREFIX)


@query("roster_flatten")
def roster_flatten(spark, sf):
    """P2 + P3 over every landed roster row (page ordinals included)."""
    return roster.order_columns(roster.flatten(derive.roster_rows(spark, sf)))


@query("roster_empty")
def roster_empty(spark, sf):
    """A prefix that no key has gives a frame without rows that still has the key column first."""
    frame = roster.roster_frame(derive.roster_rows(spark, sf), "NOBODY")
    return frame.agg(F.count("XRefCode").alias("n_rows")).withColumn("first_column", F.lit(frame.columns[0]))


@query("employee_keys")
def employee_keys(spark, sf):
    """Roster keys as text, missing ones dropped, repeats kept."""
    return roster.employee_keys(derive.roster_rows(spark, sf)).select("XRefCode", "page_idx", "row_idx")


@query("status_latest")
def status_latest(spark, sf):
    """P5 + P6 + W2: name and latest employment status of every employee."""
    d = F.col("detail")
    return details(spark, sf).select(
        "XRefCode", roster.display_name(d).alias("DisplayName"), roster.employment_status(d).alias("employment_status")
    )


@query("primary_department")
def primary_department(spark, sf):
    """Department of the primary (else first) wrapped work assignment."""
    d = F.col("detail")
    return details(spark, sf).select("XRefCode", roster.primary_department(d).alias("DepartmentXRefCode"))


@query("department_as_of")
def department_as_of(spark, sf):
    """Department effective on two dates (covering item preferred)."""
    d = roster.with_department_as_of(details(spark, sf), F.to_date(F.lit(AS_OF_PAST)), "dept_past")
    d = roster.with_department_as_of(d, F.to_date(F.lit(AS_OF_NOW)), "dept_now")
    return d.select("XRefCode", "dept_past", "dept_now")


@query("department_fallback")
def department_fallback(spark, sf):
    """P8 + P10-P12: nothing covers the date → primary or latest start; path fallbacks."""
    d = roster.with_department_as_of(details(spark, sf), F.to_date(F.lit(AS_OF_EARLY)))
    return d.select("XRefCode", "department_xref")


@query("map_validate")
def map_validate(spark, sf):
    """Validation report of the mapping rows."""
    return mapping.validation(derive.department_map_rows(spark, sf))


@query("department_map")
def department_map(spark, sf):
    """S13 + H16 + P22: the effective map (later duplicate wins, invalid entries left out)."""
    return dept_map(spark, sf)


@query("department_lookup")
def department_lookup(spark, sf):
    """Every employee's current department resolved to project/task (null when unmapped)."""
    d = roster.with_department_as_of(details(spark, sf), F.to_date(F.lit(AS_OF_NOW))).select("XRefCode", "department_xref")
    return mapping.resolve(d, "department_xref", dept_map(spark, sf))


@query("employee_rows")
def employee_rows(spark, sf):
    """J2 + P23: in-scope roster keys → name, department, project, task, status; unmapped dropped."""
    keys = roster.roster_frame(derive.roster_rows(spark, sf), PREFIX)
    return roster.employee_rows(keys, details(spark, sf), dept_map(spark, sf))


@query("inactive_status_counts")
def inactive_status_counts(spark, sf):
    """P20 + A6: employees per non-ACTIVE status (null group kept)."""
    keys = roster.roster_frame(derive.roster_rows(spark, sf), PREFIX)
    return roster.inactive_status_counts(roster.employee_rows(keys, details(spark, sf), dept_map(spark, sf)))


def _asof_roster(spark, sf, subset=None, pick=roster.in_scope_roster):
    keys = roster.employee_keys(derive.roster_rows(spark, sf))
    return pick(keys, details(spark, sf), dept_map(spark, sf), F.to_date(F.lit(AS_OF_NOW)), subset=subset)


@query("scope_counts")
def scope_counts(spark, sf):
    """A5: kept / unmapped / unresolved over every key of the roster, repeats included."""
    return roster.scope_counts(_asof_roster(spark, sf, pick=roster.checked_keys))


@query("roster_subset")
def roster_subset(spark, sf):
    """J5 + J4 + A3: the as-of roster restricted to a key list (BUILDING segment customers)."""
    c = derive.table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    sub = roster.employee_keys(derive.roster_rows(spark, sf)).join(
        c.select(F.col("c_custkey").alias("_ck")),
        F.regexp_extract(F.col("XRefCode"), r"(\d+)", 1).cast("bigint") == F.col("_ck"),
        "left_semi",
    )
    return _asof_roster(spark, sf, subset=sub)


@query("job_roster_asof")
def job_roster_asof(spark, sf):
    """C4: in-scope employees with their effective department and project/task."""
    r = _asof_roster(spark, sf)
    return r.filter(F.col("outcome") == "kept").drop("outcome")


# --------------------------------------------------------------------------- #
# Employee and day tables                            #
# --------------------------------------------------------------------------- #
WINDOW_START = "1997-01-01"
WINDOW_END = "1999-12-31"


def _digits(c: str) -> Column:
    return F.regexp_extract(F.col(c), r"(\d+)", 1).cast("bigint")


def employee_source(spark, sf) -> DataFrame:
    keys = roster.roster_frame(derive.roster_rows(spark, sf), PREFIX)
    return roster.employee_rows(keys, details(spark, sf), dept_map(spark, sf))


def employee_table_v1(spark, sf) -> DataFrame:
    """Employee table after a first run; rows with digits ≡ 0 (mod 17) predate the stamp column."""
    t = merge.employee_merge(empty(spark, EMPLOYEE_SCHEMA), employee_source(spark, sf), now=NOW1).drop("merge_action")
    return t.withColumn(
        "UpdatedDateTime", F.when(_digits("XRefCode") % 17 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("UpdatedDateTime"))
    )


def employee_merged(spark, sf) -> DataFrame:
    src = derive.employee_rows_v2(employee_source(spark, sf))
    return merge.employee_merge(employee_table_v1(spark, sf), src, now=NOW2)


@query("employee_merge")
def employee_merge_q(spark, sf):
    """M2 + P25: second run against the employee table (stamp moves only on status change)."""
    m = employee_merged(spark, sf)
    return m.withColumn("UpdatedDateTime", ts_text("UpdatedDateTime"))


def day_source(spark, sf, cycle: int) -> DataFrame:
    return dedupe.dedupe_day_rows(expand.weekday_days(derive.tagged_requests(spark, sf, cycle)))


def day_table_v1(spark, sf) -> DataFrame:
    return merge.day_merge(
        empty(spark, DAY_SCHEMA), day_source(spark, sf, 1), now=NOW1, run_keys=None,
        window_start=WINDOW_START, window_end=WINDOW_END,
    ).drop("merge_action")


def day_merged(spark, sf, run_keys: DataFrame) -> DataFrame:
    return merge.day_merge(
        day_table_v1(spark, sf), day_source(spark, sf, 2), now=NOW2, run_keys=run_keys,
        window_start=WINDOW_START, window_end=WINDOW_END,
    )


def _day_view(df: DataFrame) -> DataFrame:
    return df.withColumn("UpdatedDateTime", ts_text("UpdatedDateTime"))


@query("day_rows_deduped")
def day_rows_deduped(spark, sf):
    """A1 on day-table rows: one row per RecordHash, APPROVED before CANCELED (Q3)."""
    return day_source(spark, sf, 0)


@query("day_merge")
def day_merge_q(spark, sf):
    """M3 + J11: cycle 2 into the day table; run keys = every employee fetched this run."""
    keys = derive.tagged_requests(spark, sf, 2).select("_XRefCode")
    return _day_view(day_merged(spark, sf, keys))


@query("day_merge_scoped")
def day_merge_scoped(spark, sf):
    """P26 + M4: cancel-if-missing limited to BUILDING-segment employees and the date window.

    The table is stored by months; only months of the window and of the new rows are merged, all others are kept.
    """
    from ledgerfold.plans import jobs

    c = derive.table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    keys = c.select(F.concat(F.lit("emp-"), F.col("c_custkey").cast("string")).alias("XRefCode"))
    table = jobs.day_table(spark, f"days-scoped-{_tag()}")
    table.overwrite(day_table_v1(spark, sf))
    source = settled(day_source(spark, sf, 2), "days")
    merged, parts = merge.day_merge_stored(table, source, now=NOW2, run_keys=keys, window_start=WINDOW_START, window_end=WINDOW_END)
    rest = table.with_parts().where(~F.col("part").isin(parts)).select(*DAY_SCHEMA.fieldNames(), F.lit("keep").alias("merge_action"))
    return _day_view(merged.unionByName(rest))


@query("merge_metrics")
def merge_metrics_q(spark, sf):
    """Affected-row metrics of the employee and day merges."""
    keys = derive.tagged_requests(spark, sf, 2).select("_XRefCode")
    e = merge.merge_metrics(employee_merged(spark, sf)).select(F.lit("employee").alias("target"), "*")
    d = merge.merge_metrics(day_merged(spark, sf, keys)).select(F.lit("day").alias("target"), "*")
    return e.unionByName(d)


# --------------------------------------------------------------------------- #
# Landed pages                                               #
# --------------------------------------------------------------------------- #
def landed(spark, sf, gaps: bool = False) -> DataFrame:
    return pages.parse_pages(derive.landed_pages(spark, sf, gaps))


@query("page_unwrap")
def page_unwrap(spark, sf):
    """S1 + S3: object members of every landed page (bare lists too), with position."""
    rows = pages.unwrap_list(landed(spark, sf))
    r = F.col("row")
    return rows.select(
        "page_id",
        "row_idx",
        it.vget(r, "$.XRefCode").alias("XRefCode"),
        it.vget(r, "$.FirstName").alias("FirstName"),
        it.vget(r, "$.HomeOrganization.XRefCode").alias("org_xref"),
    )


@query("page_employee_keys")
def page_employee_keys(spark, sf):
    """S4 over pages: keys of unwrapped rows, rows without a key dropped."""
    rows = pages.employee_keys(pages.unwrap_list(landed(spark, sf)))
    return rows.select("page_id", "row_idx", "XRefCode")


@query("roster_from_pages")
def roster_from_pages(spark, sf):
    """S24 on landed list pages: unwrap (S1), prefix (P1), inferred struct, first wins (A2), flatten."""
    rows = pages.unwrap_list(landed(spark, sf))
    return roster.roster_frame_from_pages(rows, PREFIX)


@query("page_denials")
def page_denials(spark, sf):
    """Pages that carry a denial message instead of data."""
    return pages.denials(landed(spark, sf))


@query("page_gaps")
def page_gaps(spark, sf):
    """Next-page pointers (text or href) whose page never landed."""
    return pages.page_gaps(landed(spark, sf, gaps=True))


@query("page_chains")
def page_chains(spark, sf):
    """S1 + S12: pages reached from first pages by their pointers, pages on cycles, unreachable pages."""
    return pages.page_chains(pages.parse_pages(derive.chained_pages(spark, sf)))


@query("single_unwrap")
def single_unwrap(spark, sf):
    """Detail responses wrapped in ``Data`` (even keys) or bare (odd keys)."""
    d = derive.employee_details(spark, sf)
    n = _digits("XRefCode")
    wrapped = n % 2 == 0
    text = F.when(wrapped, F.concat(F.lit('{"Data":'), F.col("payload"), F.lit("}"))).otherwise(F.col("payload"))
    p = pages.parse_pages(d.select(text.alias("payload"), wrapped.alias("wrapped")))
    p = p.withColumn("detail", pages.unwrap_single("page"))
    v = F.col("detail")
    return p.select(it.vget(v, "$.XRefCode").alias("XRefCode"), it.vget(v, "$.DisplayName").alias("DisplayName"), "wrapped")


# --------------------------------------------------------------------------- #
# Windows and manifest                                       #
# --------------------------------------------------------------------------- #
NOW_SPAN = "1998-06-15 10:30:00"
NOW_SPAN_2 = "1998-06-16 10:30:00"


def _customer_span(spark, sf) -> DataFrame:
    o = derive.table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


@query("window_chunks")
def window_chunks(spark, sf):
    """Each customer's order-date span cut into 30-day windows with shared edges."""
    w = _customer_span(spark, sf).select("o_custkey", F.inline(windows.chunk_windows("first", "last", 30)))
    return w.select("o_custkey", "window_idx", ts_text("lo").alias("lo"), ts_text("hi").alias("hi"))


@query("window_inclusive")
def window_inclusive(spark, sf):
    """The same spans as whole-day windows of 31 days without shared edges."""
    s = _customer_span(spark, sf).select("o_custkey", F.col("first").cast("date").alias("a"), F.col("last").cast("date").alias("b"))
    return s.select("o_custkey", F.inline(windows.inclusive_windows("a", "b", 31)))


@query("lookback_span")
def lookback_span(spark, sf):
    """S8 + S9 + H11: for every order date as 'now', the request span and its 30-day windows."""
    o = derive.table(spark, sf, "orders").select(F.col("o_orderdate").alias("now_ts")).distinct()
    lo, hi = windows.span_iso("now_ts")
    return o.select(
        ts_text("now_ts").alias("now"), lo.alias("span_start"), hi.alias("span_end"),
        F.size(windows.run_windows("now_ts")).cast("int").alias("n_windows"),
    )


def _manifest(spark, sf, keys: DataFrame) -> DataFrame:
    return windows.manifest(keys, "XRefCode", windows.run_windows(F.to_timestamp(F.lit(NOW_SPAN))))


@query("request_manifest")
def request_manifest(spark, sf):
    """S5 + J12 + U2: employees × statuses × windows of one scheduled run."""
    keys = roster.employee_keys(derive.roster_rows(spark, sf)).select(F.trim("XRefCode").alias("XRefCode")).distinct()
    m = _manifest(spark, sf, keys)
    return m.select("XRefCode", "status_rank", "status", "window_idx", ts_text("lo").alias("lo"), ts_text("hi").alias("hi"))


@query("requests_in_span")
def requests_in_span(spark, sf):
    """Requests overlapping a manifest window of their employee and status (edge spanners twice)."""
    r = derive.requests(spark, sf, 0).select(
        "entry_idx", F.trim("employee_key").alias("XRefCode"), "Status",
        F.col("TimeStart").try_cast("timestamp_ntz").alias("ts0"), F.col("TimeEnd").try_cast("timestamp_ntz").alias("ts1"),
    ).filter(F.col("ts0").isNotNull())
    spans = windows.run_windows(F.to_timestamp_ntz(F.lit(NOW_SPAN)))
    o = windows.matching(r, spans, windows.DEFAULT_STATUSES, "Status", "ts0", "ts1")
    return o.select("entry_idx", "XRefCode", "Status", "status_rank", "window_idx")


# --------------------------------------------------------------------------- #
# Small scalar helpers                                           #
# --------------------------------------------------------------------------- #
@query("bool_parse")
def bool_parse(spark, sf):
    """H8: three-valued flag parsing of varied spellings."""
    e = derive.table(spark, sf, "events")
    u = F.col("user_id")
    txt = (
        F.when(F.col("event_type") == "view", (u % 2).cast("string"))
        .when(F.col("event_type") == "click", F.when(u % 3 == 0, F.lit("Yes")).otherwise(F.lit("no")))
        .when(F.col("event_type") == "signup", F.lit(""))
        .when(F.col("event_type") == "purchase", F.lit(None).cast("string"))
        .otherwise(F.lit(" T "))
    )
    return e.select("event_id", txt.alias("flag_text"), vf.tri_bool(txt).alias("flag"))


@query("status_title")
def status_title(spark, sf):
    """Status words title-cased."""
    r = derive.requests(spark, sf, 0)
    return r.select("entry_idx", "Status", vf.title_status(F.col("Status")).alias("status_title"))


@query("iso_instant")
def iso_instant(spark, sf):
    """Event instants as UTC ISO-8601 with milliseconds and Z."""
    e = derive.table(spark, sf, "events")
    return e.select("event_id", vf.iso_instant(F.col("ts")).alias("iso"))


@query("now_truncate")
def now_truncate(spark, sf):
    """Event instants truncated to whole seconds."""
    e = derive.table(spark, sf, "events")
    return e.select("event_id", ts_text(vf.whole_seconds(F.col("ts"))).alias("ts_seconds"))


# --------------------------------------------------------------------------- #
# Typed tables                                                  #
# --------------------------------------------------------------------------- #
@query("typed_projection")
def typed_projection(spark, sf):
    """A loosely typed frame projected onto the declared employee schema."""
    src = employee_source(spark, sf).select(
        "XRefCode", "employee_name", "DepartmentXRefCode",
        F.col("ProjectId").cast("string").alias("ProjectId"), F.col("TaskId").cast("string").alias("TaskId"),
        "employment_status", F.lit("x").alias("extra"),
    )
    t = tables.typed(src, EMPLOYEE_SCHEMA)
    return t.withColumn("UpdatedDateTime", ts_text("UpdatedDateTime"))


@query("schema_evolve")
def schema_evolve(spark, sf):
    """The older five-column employee table gains the later columns."""
    old = employee_source(spark, sf).select("XRefCode", "employee_name", "DepartmentXRefCode", "ProjectId", "TaskId")
    ev = tables.add_missing_columns(old)
    return ev.withColumn("UpdatedDateTime", ts_text("UpdatedDateTime"))


@query("table_roundtrip")
def table_roundtrip(spark, sf):
    """S15-S17 + S21: employee rows merged into an empty stored table and read back."""
    from ledgerfold.plans import jobs

    t = jobs.employee_table(spark, f"roundtrip-{_tag()}")
    t.overwrite(merge.employee_merge(t.read(), employee_source(spark, sf), now=NOW1))
    return t.read().withColumn("UpdatedDateTime", ts_text("UpdatedDateTime"))


# --------------------------------------------------------------------------- #
# A9, O1, O3                                                                  #
# --------------------------------------------------------------------------- #
@query("cycle_metrics")
def cycle_metrics_q(spark, sf):
    """One-row metrics of cycle 2 and its one-line summary."""
    from ledgerfold.plans.cycle import LedgerCycle, cycle_metrics, metrics_text

    cfg = LedgerCycle(now=NOW2, run_id="run-2", expand_multi_day=True)
    checked = derive.table(spark, sf, "customer").select(F.concat(F.lit("emp-"), F.col("c_custkey").cast("string")).alias("XRefCode"))
    m = cycle_metrics(derive.requests(spark, sf, 2), apply_cycle(spark, sf, 2), cfg, checked)
    return m.withColumn("summary", metrics_text(m))


@query("roster_preview")
def roster_preview(spark, sf):
    """O1 + O3: first rows of the day table in (employee, date, hash) order — the limit is the feature."""
    d = day_source(spark, sf, 0)
    return d.orderBy("XRefCode", "Date", "RecordHash").limit(20).select("XRefCode", "Date", "Hours", "Status", "RecordHash")


# --------------------------------------------------------------------------- #
# Jobs with their table writes                                         #
# --------------------------------------------------------------------------- #
def _tag() -> str:
    import uuid

    return uuid.uuid4().hex[:12]


@query("job_employee_table")
def job_employee_table(spark, sf):
    """Roster → employee rows → employee table, after its first run."""
    from ledgerfold.plans import jobs

    t = jobs.employee_table(spark, f"employees-{_tag()}")
    run = jobs.employee_table_job(
        t, derive.roster_rows(spark, sf), details(spark, sf), derive.department_map_rows(spark, sf), prefix=PREFIX, now=NOW1, pages=None, strict=False
    )
    return run.rows.withColumn("UpdatedDateTime", ts_text("UpdatedDateTime"))


@query("job_day_table")
def job_day_table(spark, sf):
    """ACTIVE employees × statuses × windows → weekday rows → day table, after its first run."""
    from ledgerfold.plans import jobs

    t = jobs.day_table(spark, f"days-{_tag()}")
    run = jobs.day_table_job(t, employee_source(spark, sf), derive.requests(spark, sf, 0), now=NOW_SPAN, pages=None, strict=False)
    return run.rows.withColumn("UpdatedDateTime", ts_text("UpdatedDateTime"))


@query("job_ledger")
def job_ledger(spark, sf):
    """Two ledger cycles; the stored ledger after the second with its actions."""
    from ledgerfold.plans import jobs

    return ledger_view(jobs.ledger_job(spark, sf, _tag(), stamps=(NOW1, NOW2)))


@query("job_ledger_bucketed")
def job_ledger_bucketed(spark, sf):
    """C3 + S14 on a ledger bucketed by the identity: the same cycles, without an exchange of the stored rows."""
    from ledgerfold.plans import jobs

    return ledger_view(jobs.ledger_job(spark, sf, _tag(), stamps=(NOW1, NOW2), bucketed=True))


@query("landed_requests_expand")
def landed_requests_expand(spark, sf):
    """S3 + X4: requests landed as JSON pages, unwrapped and expanded (equals expand_choice)."""
    from ledgerfold.sources import requests as req_src

    p = pages.parse_pages(derive.landed_request_pages(spark, sf, 0))
    e = req_src.entries_from_pages(p).withColumn("entry_idx", F.col("page_id"))
    return expand.ledger_days(e.drop("page_id"), expand_multi_day=True).select(*DAY_OUT)


@query("landed_payloads")
def landed_payloads(spark, sf):
    """Each landed request as JSON text with its keys in order."""
    from ledgerfold.sources import requests as req_src

    p = pages.parse_pages(derive.landed_request_pages(spark, sf, 0))
    return req_src.entries_from_pages(p).select("page_id", "entry_idx", "source_payload")


@query("landed_rejects")
def landed_rejects(spark, sf):
    """P14/P15 from landed JSON pages: requests rejected as a whole, with the reason."""
    from ledgerfold.sources import requests as req_src

    p = pages.parse_pages(derive.landed_request_pages(spark, sf, 0))
    e = req_src.entries_from_pages(p).withColumn("entry_idx", F.col("page_id"))
    return expand.rejected_entries(e.drop("page_id"), expand_multi_day=True).select("entry_idx", "employee_key", "reject_reason")


@query("page_completeness")
def page_completeness(spark, sf):
    """S11 + S12 gate: pages, unreadable pages, denials and gaps of the landed run, in one row."""
    return pages.completeness(landed(spark, sf, gaps=True))


@query("job_ledger_gate")
def job_ledger_gate(spark, sf):
    """C3 on an incomplete second snapshot: employees with a refused page keep their stored rows.

    Every request is a page of its own; in cycle 2 the pages of orders ≡ 3 (mod 50) are refusals.
    """
    from ledgerfold.plans import jobs
    from ledgerfold.plans.cycle import LedgerCycle, run_ledger_cycle

    t = jobs.ledger_table(spark, f"ledger-gate-{_tag()}")
    run_ledger_cycle(t, derive.requests(spark, sf, 1), LedgerCycle(now=NOW1, run_id="run-1", expand_multi_day=True), pages=None)
    two = derive.requests(spark, sf, 2)
    refused = F.col("entry_idx") % 50 == 3
    page = F.when(refused, F.parse_json(F.lit('{"Message":"Rate limit reached"}'))).otherwise(F.parse_json(F.lit('{"Data":[]}')))
    landed_run = two.select("employee_key", F.col("entry_idx").alias("page_id"), page.alias("page"))
    cfg = LedgerCycle(now=NOW2, run_id="run-2", expand_multi_day=True)
    run = run_ledger_cycle(t, two.where(~refused), cfg, pages=landed_run, strict=False)
    return run.rows.select("record_hash", "employee_xref", "pto_date", "is_active", "ingest_run_id", "action", "merge_action")


@query("job_day_table_gate")
def job_day_table_gate(spark, sf):
    """C2 on a second run in which requests are rejected: their employees' stored days aren't canceled."""
    from ledgerfold.plans import jobs

    t = jobs.day_table(spark, f"days-gate-{_tag()}")
    people = settled(employee_source(spark, sf), "people")
    for cycle, now in ((1, NOW_SPAN), (2, NOW_SPAN_2)):
        run = jobs.day_table_job(t, people, derive.requests(spark, sf, cycle), now=now, pages=None, strict=False)
    return run.rows.select("RecordHash", "XRefCode", "Date", "Status", "merge_action")


@query("expand_audit")
def expand_audit(spark, sf):
    """The audit columns of every day record, taken over from its request."""
    k = F.col("entry_idx")
    r = derive.requests(spark, sf, 0).withColumns(
        {
            "AllDay": F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 4 == 1, "\tYes ").otherwise("no"),
            "DateOfRequest": F.col("TimeStart").substr(1, 10),
            "source_payload": F.concat(F.lit("order "), k.cast("string")),
        }
    )
    d = expand.ledger_days(r, expand_multi_day=True)
    return d.select("entry_idx", "day_idx", "reason_name", "status", "time_start", "time_end", "all_day", "date_of_request", "source_payload")


@query("ledger_active")
def ledger_active(spark, sf):
    """S14 + P24: identities of the active ledger rows after cycle 2."""
    return merge.active_records(merge.ledger_rows(apply_cycle(spark, sf, 2)))


@query("reconcile_writes")
def reconcile_writes(spark, sf):
    """The hashes cycle 2 writes (new, changed) and retires (cancelled, superseded)."""
    c = classify.reconcile(ledger_days(spark, sf, 2), identities_after(spark, sf))
    up = classify.upserts(c).select("record_hash", F.lit("upsert").alias("write"))
    return up.unionByName(classify.deactivations(c).select("record_hash", F.lit("retire").alias("write")))


@query("employees_in_scope")
def employees_in_scope(spark, sf):
    """Employees whose current department is in the map (semi-join)."""
    d = roster.with_department_as_of(details(spark, sf), F.to_date(F.lit(AS_OF_NOW))).select("XRefCode", "department_xref")
    return mapping.keep_in_scope(d, "department_xref", dept_map(spark, sf))


@query("ddl_tables")
def ddl_tables(spark, sf):
    """The three catalog tables created from their DDL, filled and read back (rows per table)."""
    from ledgerfold.session import shared_dir

    filled = {
        "ledger": (tables.LEDGER_DDL, merge.ledger_rows(apply_cycle(spark, sf, 1))),
        "employees": (tables.EMPLOYEE_DDL, tables.typed(employee_source(spark, sf), EMPLOYEE_SCHEMA)),
        "days": (tables.DAY_DDL, day_table_v1(spark, sf)),
    }
    out = None
    for name, (ddl, rows) in filled.items():
        table = f"lf_{name}_{_tag()}"
        spark.sql(tables.create_table_sql(table, ddl, location=f"{shared_dir(spark)}/{table}"))
        rows.select(*spark.table(table).columns).write.insertInto(table)
        read = spark.read.schema(spark.table(table).schema).parquet(f"{shared_dir(spark)}/{table}")
        spark.sql(f"DROP TABLE {table}")  # the files stay
        hashed = F.count_distinct("record_hash" if name == "ledger" else "XRefCode" if name == "employees" else "RecordHash")
        part = read.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"), hashed.alias("n_keys")).withColumn("n_columns", F.lit(len(read.columns)))
        out = part if out is None else out.unionByName(part)
    return out


@query("not_null_audit")
def not_null_audit(spark, sf):
    """Rows of the cycle-2 ledger breaking a declared NOT NULL (file tables do not enforce it)."""
    led = merge.ledger_rows(apply_cycle(spark, sf, 2))
    return led.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        tables.not_null_violations(led, LEDGER_SCHEMA).alias("n_violations"),
    )


@query("job_ledger_scoped")
def job_ledger_scoped(spark, sf):
    """C3 with S4/J5 + S8/S10 + statuses: BUILDING employees, APPROVED then CANCELED,
    requests overlapping the span around one 'now', written as a first ledger version."""
    from ledgerfold.plans import jobs
    from ledgerfold.plans.cycle import LedgerCycle, run_ledger_cycle

    t = jobs.ledger_table(spark, f"ledger-scoped-{_tag()}")
    c = derive.table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    keys = c.select(F.concat(F.lit("emp-"), F.col("c_custkey").cast("string")).alias("XRefCode"))
    cfg = LedgerCycle(now=NOW1, run_id="run-1", expand_multi_day=True, statuses=("APPROVED", "CANCELED"), span_now=NOW_SPAN)
    return ledger_view(run_ledger_cycle(t, derive.requests(spark, sf, 0), cfg, keys, pages=None).rows)


__all__ = ["QUERIES", "NOW1", "NOW2", "NOW3", "query"]
