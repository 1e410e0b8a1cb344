"""Scheduled jobs with their table writes.

Inputs are DataFrames (landed pages, payloads, mapping rows, requests). Each
job computes its merge once, into the shared folder, and replaces the partitions of
its table in which a row changed. A job started again after a failure, with the
same stamp, gives the same rows.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions.identity import norm_token
from ledgerfold.operators import dedupe, expand, merge, roster
from ledgerfold.plans import derive
from ledgerfold.plans.cycle import JobRun, LedgerCycle, run_ledger_cycle
from ledgerfold.session import shared_dir
from ledgerfold.sources import mapping, windows
from ledgerfold.sources.pages import IncompleteInput, affected_employees, require_complete
from ledgerfold.sources.tables import DAY_SCHEMA, EMPLOYEE_SCHEMA, LEDGER_SCHEMA, REJECT_SCHEMA, BucketedTable, StoredTable, key_part, month_part, settled


def employee_table_job(
    table: StoredTable,
    roster_rows: DataFrame,
    details: DataFrame,
    map_rows: DataFrame,
    *,
    prefix: str,
    now: str,
    pages: DataFrame | None,
    strict: bool = True,
) -> JobRun:
    """Roster pages → in-scope employee rows → M2 into the employee table.

    ``pages`` are the landed roster pages; an incomplete run of them ends the job, since an employee it lacks would be
    taken for one that isn't in scope. None says that the roster didn't come as pages. ``strict`` raises on a map entry
    that lacks an id (it would drop its department's employees); a source with two rows of one employee raises as it merges.
    """
    began = time.monotonic()
    if pages is not None:
        require_complete(pages)
    keys = roster.roster_frame(roster_rows, prefix)
    src = roster.employee_rows(keys, details, mapping.load(map_rows, strict=strict))
    return _merged_job(table, merge.employee_merge(table.read(), src, now=now), began)


def _merged_job(table: StoredTable, merged: DataFrame, began: float, rest: DataFrame | None = None) -> JobRun:
    """Compute a merge once, replace the partitions it changes; ``rest``: rows of partitions it didn't read."""
    counted = Observation()
    merged = settled(merged.observe(counted, *merge.count_columns("merge_action", merge.MERGE_COUNTERS)), "merged")
    parts = table.changed_parts(merged)
    if parts:
        table.overwrite(merged.where(table.part_column().isin(parts)))
    rows = merged if rest is None else merged.unionByName(rest.withColumn("merge_action", F.lit("keep")))
    return JobRun({**counted.get, "parts_written": len(parts), "duration_s": round(time.monotonic() - began, 3)}, rows)


def tagged_for_run(employees: DataFrame, requests: DataFrame, now: str, statuses=windows.DEFAULT_STATUSES) -> DataFrame:
    """C2 fetch stage: requests of ACTIVE employees that overlap the run's windows, tagged.

    ``requests`` carries ``employee_key``, ``Status`` and the request fields;
    they are cut to the run's span first, then joined to the run's keys on the
    normalised key, and tagged with the run key as given, the status rank and
    window index. A request whose times can't be read stays in, so that
    expansion rejects it where the job can see it.
    """
    run_keys = roster.active_keys(employees).withColumn("_k", norm_token(F.col("XRefCode")))
    r = requests.withColumns(
        {
            "_k": norm_token(F.col("employee_key")),
            "_ts0": F.col("TimeStart").try_cast("timestamp_ntz"),
            "_ts1": F.col("TimeEnd").try_cast("timestamp_ntz"),
        }
    )
    ended = F.col("TimeEnd").isNotNull() & (F.col("TimeEnd") != "")
    unread = F.col("_ts0").isNull() | (ended & F.col("_ts1").isNull())
    hit = windows.matching(r, windows.run_windows(F.to_timestamp_ntz(F.lit(now))), statuses, "Status", "_ts0", "_ts1", always=unread)
    return hit.join(run_keys, "_k").select(
        F.col("XRefCode").alias("_XRefCode"),
        F.col("Status").alias("_Status"),
        "status_rank",
        "window_idx",
        "entry_idx",
        "TimeStart",
        "TimeEnd",
        "NetHours",
        "ReasonName",
        "PayAdjShortName",
    )


def day_table_job(
    table: StoredTable,
    employees: DataFrame,
    requests: DataFrame,
    *,
    now: str,
    pages: DataFrame | None,
    strict: bool = True,
    rejects: StoredTable | None = None,
) -> JobRun:
    """Tagged requests → weekday rows → first-wins dedupe → M3 scoped to this run.

    Nothing is canceled on input that isn't whole. With ``strict`` (as in the
    source system) an incomplete page or a rejected request ends the job before
    it writes. Otherwise the employees concerned leave the cancel scope of this
    run: their stored days stay, and their readable requests are merged.
    Rejected requests are stored with their reasons in ``rejects``. ``pages`` are the
    landed pages behind ``requests``; None says that they didn't come as pages.

    The tagged requests and the day rows are settled, and only months of the run's window
    and of the day rows are read and merged.
    """
    began = time.monotonic()
    if pages is not None and strict:
        require_complete(pages)
    tagged = settled(tagged_for_run(employees, requests, now), "tagged")
    refused = expand.weekday_rejects(tagged).select(F.col("_XRefCode").alias("employee_key"), "entry_idx", "reject_reason")
    refused = settled(refused, "rejected")
    keys = roster.active_keys(employees)
    if strict:
        first = refused.first()
        if first is not None:
            raise IncompleteInput(f"requests were rejected, first: {first.asDict()}")
    else:
        held = refused.select("employee_key")
        if pages is not None:
            held = held.unionByName(affected_employees(pages))
        held = held.select(norm_token(F.col("employee_key")).alias("_k")).distinct()
        keys = keys.withColumn("_k", norm_token(F.col("XRefCode"))).join(held, "_k", "left_anti").drop("_k")
    if rejects is not None:
        rejects.overwrite(refused.withColumn("run_at", F.lit(now).cast("timestamp")))
    source = settled(dedupe.dedupe_day_rows(expand.weekday_days(tagged)), "days")
    start, end = windows.span_dates(now)
    merged, parts = merge.day_merge_stored(table, source, now=now, run_keys=keys, window_start=start, window_end=end)
    rest = table.with_parts().where(~F.col("part").isin(parts)).select(*table.schema.fieldNames())
    return _merged_job(table, merged, began, rest)


def ledger_job(spark: SparkSession, sf_dir: str, run_tag: str, stamps=("2026-03-16 06:00:00", "2026-03-17 06:00:00"), bucketed: bool = False) -> DataFrame:
    """C3 over two snapshot cycles; the ledger after the second with its ``action`` / ``merge_action``."""
    table = bucketed_ledger(spark, f"ledger_{run_tag}") if bucketed else ledger_table(spark, f"ledger-{run_tag}")
    run = None
    for cycle, now in enumerate(stamps, start=1):
        cfg = LedgerCycle(now=now, run_id=f"run-{cycle}", expand_multi_day=True)
        run = run_ledger_cycle(table, derive.requests(spark, sf_dir, cycle), cfg, pages=None)
    return run.rows


def _table(spark: SparkSession, name: str, schema, part: str) -> StoredTable:
    return StoredTable(spark, f"{shared_dir(spark)}/{name}", schema, part)


def ledger_table(spark: SparkSession, name: str) -> StoredTable:
    """A ledger by months of the day, in the session's shared folder."""
    return _table(spark, name, LEDGER_SCHEMA, month_part("pto_date"))


def bucketed_ledger(spark: SparkSession, name: str) -> BucketedTable:
    """A ledger by months whose files are bucketed by the identity, so that a cycle exchanges only its snapshot."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return BucketedTable(spark, name, f"{shared_dir(spark)}/{name}", LEDGER_SCHEMA, month_part("pto_date"), merge.IDENTITY, buckets)


def day_table(spark: SparkSession, name: str) -> StoredTable:
    """A day table by months, in the session's shared folder."""
    return _table(spark, name, DAY_SCHEMA, month_part("Date"))


def employee_table(spark: SparkSession, name: str) -> StoredTable:
    """An employee table by hash buckets of the key, in the session's shared folder."""
    return _table(spark, name, EMPLOYEE_SCHEMA, key_part("XRefCode"))


def reject_table(spark: SparkSession, name: str) -> StoredTable:
    """Rejected requests by run, in the session's shared folder; a run started again replaces its own."""
    return _table(spark, name, REJECT_SCHEMA, "date_format(run_at, 'yyyyMMddHHmmss')")


__all__ = ["bucketed_ledger", "day_table", "day_table_job", "employee_table", "employee_table_job", "ledger_job", "ledger_table", "reject_table", "tagged_for_run"]
