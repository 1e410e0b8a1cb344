"""The ledger cycle (C3) and its metrics.

A cycle settles the day records and the narrow actions in the shared folder, then
replaces the months of a :class:`~ledgerfold.sources.tables.StoredTable` in which a row
changes. A lost executor only re-runs tasks, and a lost run is started again.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerfold.functions.identity import norm_token
from ledgerfold.operators import expand, merge
from ledgerfold.operators.classify import ACTIONS
from ledgerfold.sources import windows
from ledgerfold.sources.pages import affected_employees, require_complete
from ledgerfold.sources.tables import BucketedTable, StoredTable, settled


@dataclass(frozen=True)
class LedgerCycle:
    """C3 configuration: one scheduled ledger run.

    ``statuses`` (in request order) keeps requests whose status was queried and
    ranks them for first-wins; ``span_now`` keeps requests overlapping the
    look-back/horizon span around it (S8 + S10); ``keys`` restricts the run to
    an explicit employee list (J5) instead of the whole roster.
    """

    now: str
    run_id: str
    expand_multi_day: bool = False
    key: str = "employee_key"
    statuses: tuple[str, ...] | None = None
    span_now: str | None = None


@dataclass(frozen=True)
class JobRun:
    """What a job did: ``metrics`` observed on its own writes, with the duration in seconds, and the
    table's ``rows`` after it with the actions of this run (lazy)."""

    metrics: dict
    rows: DataFrame


def scope_requests(requests: DataFrame, cfg: LedgerCycle, keys: DataFrame | None = None) -> DataFrame:
    """S4/J5 + S10 + status selection of the landed requests of one run."""
    r = requests
    if keys is not None:
        k = keys.select(norm_token(F.col(keys.columns[0])).alias("_k")).distinct()
        r = r.withColumn("_k", norm_token(F.col(cfg.key))).join(k, "_k", "left_semi").drop("_k")
    if cfg.statuses:
        # An entry without a status of its own has the one it was queried with
        own = F.nullif(F.col("Status"), F.lit(""))
        r = r.withColumn("Status", F.coalesce(own, F.col("query_status")) if "query_status" in r.columns else own)
        rank = F.array_position(F.array(*[F.lit(x) for x in cfg.statuses]), F.col("Status")).cast("int") - 1
        r = r.filter(F.col("Status").isin(*cfg.statuses)).withColumn("status_rank", rank)
    if cfg.span_now:
        lo, hi = windows.lookback_span(F.to_timestamp(F.lit(cfg.span_now)))
        start = F.col("TimeStart").try_cast("timestamp_ntz")
        end = F.coalesce(F.col("TimeEnd").try_cast("timestamp_ntz"), start)
        r = r.filter((start <= hi) & (end >= lo))
    return r


def cycle_counts(weight: str | None = None) -> list[Column]:
    """The counters of a cycle over its actions; for ``agg`` and ``observe``. With ``weight``, over numbers of them."""
    seen = {"day_records": ("insert", "reactivate", "touch", "noop")}
    merged = {"inserted": ("insert",), "reactivated": ("reactivate",), "touched": ("touch",), "cancelled_rows": ("cancel",)}
    return [
        *merge.count_columns("merge_action", seen, weight),
        *merge.count_columns("action", {a: (a,) for a in ACTIONS}, weight),
        *merge.count_columns("merge_action", merged, weight),
    ]


def cycle_metrics(
    requests: DataFrame, applied: DataFrame, cfg: LedgerCycle, checked: DataFrame | None = None, key: str = "employee_key"
) -> DataFrame:
    """One row — employees, fetched entries, day records, class and merge counts.

    ``checked`` (first column: the key) are the employees the run asked for, those
    without any request too; without it the requesting ones count. One-row
    aggregates are stacked (``unionByName``) and folded with ``max``; no join
    is needed to put them side by side.
    """
    asked = checked.select(F.col(checked.columns[0]).alias("_key")) if checked is not None else requests.select(F.col(key).alias("_key"))
    src = asked.agg(F.count_distinct("_key").cast("bigint").alias("employees"))
    src = src.unionByName(requests.agg(F.count(F.lit(1)).cast("bigint").alias("fetched_entries")), allowMissingColumns=True)
    res = applied.agg(*cycle_counts())
    both = src.unionByName(res, allowMissingColumns=True)
    cols = [*src.columns, *res.columns]
    return both.agg(*[F.max(c).alias(c) for c in cols]).select(F.lit(cfg.run_id).alias("run_id"), *cols)


def metrics_json(metrics: DataFrame) -> Column:
    """A9 as JSON text (``to_json`` of the metrics row)."""
    return F.to_json(F.struct(*[F.col(c) for c in metrics.columns]))


def metrics_text(metrics: DataFrame) -> Column:
    """A9 as one line of ``name=value`` pairs in the metrics' own order."""
    pairs = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in metrics.columns]
    return F.concat_ws(" ", *pairs)


def _replaced_in_buckets(table: BucketedTable, days: DataFrame, held: DataFrame | None, cfg: LedgerCycle, counted: Observation) -> DataFrame:
    """The next rows are computed once, in one pass that exchanges the snapshot alone, and settled in the table's buckets; the months that change
    are replaced from there. Of the actions, those that depend on other identities of the day are exchanged, narrow."""
    stored = table.read()
    if held is not None:
        stored = stored.join(held, "employee_xref", "left_anti")
    applied = table.aside(merge.bucketed_next(stored, days, now=cfg.now, run_id=cfg.run_id, buckets=table.buckets), "applied")
    parts = table.changed_parts(applied)
    if parts:
        rows = applied.where(table.part_column().isin(parts)).select(*table.schema.fieldNames())
        if held is not None:
            rows = rows.unionByName(table.read(parts).join(held, "employee_xref", "left_semi"))
        table.overwrite(rows, dealt=held is None)
    named = table.aside(table.dealt(merge.renamed_actions(applied)), "named")
    merge.action_numbers(applied, named).observe(counted, *cycle_counts("n")).write.format("noop").mode("overwrite").save()
    rows = merge.with_actions(applied, named).select(*table.schema.fieldNames(), "action", "merge_action")
    if held is None:
        return rows
    kept = table.read().join(held, "employee_xref", "left_semi").withColumns({"action": F.lit(None).cast("string"), "merge_action": F.lit("keep")})
    return rows.unionByName(kept)


def run_ledger_cycle(
    table: StoredTable,
    requests: DataFrame,
    cfg: LedgerCycle,
    keys: DataFrame | None = None,
    *,
    pages: DataFrame | None,
    strict: bool = True,
    rejects: StoredTable | None = None,
) -> JobRun:
    """Read the stored rows, classify, replace the months that change.

    ``pages`` are the landed pages behind ``requests``; None says that the
    requests didn't come as pages. With ``strict`` an unreadable, refused or missing page ends the run before anything is
    written; otherwise the stored rows of the employees concerned stay as
    they are in this cycle. Rejected requests go to ``rejects`` with their reasons.

    The next rows are computed once, in one pass over stored rows and day records, and settled with their actions; the months that
    change are replaced from there. Counters of actions are observed on that write (``employees`` where ``keys`` are given).
    """
    began = time.monotonic()
    held = None
    if pages is not None:
        if strict:
            require_complete(pages)
        else:
            held = affected_employees(pages).select(norm_token(F.col("employee_key")).alias("employee_xref"))
    seen: dict[str, Observation] = {}
    if keys is not None:
        seen["keys"] = Observation()
        asked = keys.select(norm_token(F.col(keys.columns[0])).alias("key")).distinct()
        keys = settled(asked.observe(seen["keys"], F.count(F.lit(1)).alias("employees")), "keys")
    scoped = scope_requests(requests, cfg, keys)
    if rejects is not None:
        refused = expand.rejected_entries(scoped, key=cfg.key, expand_multi_day=cfg.expand_multi_day)
        rejects.overwrite(refused.select(F.col(cfg.key).alias("employee_key"), "entry_idx", "reject_reason", F.lit(cfg.now).cast("timestamp").alias("run_at")))
    seen["actions"] = Observation()
    # counted apart: the stage that expands the requests may run again when its exchange is lost
    fetched = {"fetched_entries": scoped.count()}
    days = expand.ledger_days(scoped, key=cfg.key, expand_multi_day=cfg.expand_multi_day)
    stored = table.read()
    if held is not None:
        held = settled(held.distinct(), "held")
        days = days.join(held, "employee_xref", "left_anti")
        kept = stored.join(held, "employee_xref", "left_semi").select("*", *[F.lit(a).cast("string").alias(n) for n, a in (("action", None), ("merge_action", "keep"))])
        stored = stored.join(held, "employee_xref", "left_anti")
    if isinstance(table, BucketedTable):
        rows = _replaced_in_buckets(table, days, held, cfg, seen["actions"])
    else:
        applied = merge.ledger_apply(stored, days, now=cfg.now, run_id=cfg.run_id, settle=False).drop(merge.MONTH)
        rows = settled(applied.observe(seen["actions"], *cycle_counts()), "applied")
        parts = table.changed_parts(rows)
        rows = rows if held is None else rows.unionByName(settled(kept, "kept"))
        if parts:
            table.overwrite(rows.where(table.part_column().isin(parts)))
    counted = {name: o.get for name, o in seen.items()}
    metrics = {**counted.get("keys", {}), **fetched, **counted["actions"]}
    return JobRun({"run_id": cfg.run_id, **metrics, "duration_s": round(time.monotonic() - began, 3)}, rows.select(*table.schema.fieldNames(), "action", "merge_action"))


__all__ = ["JobRun", "LedgerCycle", "cycle_counts", "cycle_metrics", "metrics_json", "metrics_text", "run_ledger_cycle", "scope_requests"]
