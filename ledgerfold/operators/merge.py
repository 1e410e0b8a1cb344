"""Conditional upserts as join plans.

Each merge returns the target's next rows plus a ``merge_action`` column, so the
counters (A7/A8) are exact aggregates of the same plan, and a stored table's
writer replaces the partitions in which a row changed. One stamp ``now`` per
call (Q21); never ``current_timestamp()`` inside a checked plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.functions.identity import record_hash_normalized
from ledgerfold.operators.classify import HASH, HASHED, NATURAL_KEY, identities, identity_text, key_summary, moved, one_text, paired, renewed, with_action
from ledgerfold.operators.dedupe import DEFAULT_ORDER, first_wins
from ledgerfold.sources.tables import DAY_SCHEMA, EMPLOYEE_SCHEMA, LEDGER_SCHEMA, StoredTable, settled, typed

IDENTITY = (*NATURAL_KEY, HASH)
#: With the employee, what :func:`dealt_out` deals by.
MONTH = "_month"
#: Columns that a day record takes from its request as they are.
AUDIT = ("reason_name", "status", "time_start", "time_end", "all_day", "date_of_request", "source_payload")
LEDGER_ACTIONS = ("insert", "update", "reactivate", "touch", "cancel")


def _ts(now) -> Column:
    """The cycle's one stamp (Q21), truncated to whole seconds."""
    c = now if isinstance(now, Column) else F.to_timestamp(F.lit(str(now)))
    return F.date_trunc("second", c)


def changed(a: Column, b: Column) -> Column:
    """P25: null-safe 'differs'."""
    return ~a.eqNullSafe(b)


def unique_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q20: a merge source; a key with two rows raises as the merge runs.

    Rows are counted per key where the merge deals and sorts them by that key anyway, so no exchange is added. The check stands in the
    first column besides the key, which a merge always reads.
    """
    named = F.concat(F.lit(f"merge source is not unique on {list(key)}: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in key]))
    several = F.count(F.lit(1)).over(Window.partitionBy(*key)) > 1
    first = next(f for f in df.schema.fields if f.name not in key)
    return df.withColumn(first.name, F.when(several, F.raise_error(named).cast(first.dataType)).otherwise(F.col(first.name)))


# --------------------------------------------------------------------------- #
# M1 / M5: ledger apply                                                        #
# --------------------------------------------------------------------------- #
def _merge_action(now_c: Column) -> Column:
    return (
        F.when(F.col("in_cur") & ~F.col("stored"), F.lit("insert"))
        .when(F.col("in_cur") & ~F.col("st_active"), F.lit("reactivate"))
        .when(F.col("in_cur") & F.col("last_seen").eqNullSafe(now_c), F.lit("noop"))
        .when(F.col("in_cur"), F.lit("touch"))
        .when(F.col("gone"), F.lit("cancel"))
        .otherwise(F.lit("keep"))
    )


def ledger_actions(stored: DataFrame, current: DataFrame, *, now, copartitioned: bool = False) -> DataFrame:
    """What happens to each identity, from keys, flags and stamps alone: ``action`` and ``merge_action``.

    Unseen → insert; seen but stored inactive → reactivate; seen and active → touch, or noop when already
    stamped; active but gone (cancelled or superseded) → cancel; everything else is kept as stored.
    The identities are settled, so that each side is read once. ``copartitioned``: see :func:`classify.identities`.
    """
    c = paired(settled(identities(current, stored, copartitioned=copartitioned), "identities"))
    return c.select(*IDENTITY, "first_seen", "action", _merge_action(_ts(now)).alias("merge_action"))


def stored_after(actions: DataFrame, *, now) -> DataFrame:
    """Identities of the ledger after the actions, with ``is_active`` and ``first_seen_at``; no ledger row is read."""
    seen = F.col("merge_action").isin("insert", "reactivate", "touch", "noop")
    return actions.select(*IDENTITY, seen.alias("is_active"), F.coalesce(F.col("first_seen"), _ts(now)).alias("first_seen_at"))


#: Actions whose row comes from the snapshot; all others keep the stored row.
FROM_SNAPSHOT = ("insert", "reactivate")


def ledger_next(stored: DataFrame, current: DataFrame, actions: DataFrame, *, now, run_id: str) -> DataFrame:
    """The ledger rows after the actions (late materialisation of M1).

    Stored rows meet their action on the identity. Of the snapshot, only rows to insert or reactivate are
    fetched, by a join with their actions before the first-wins collapse; that join's side of few actions is broadcast, or
    its runtime filter prunes the snapshot, so payloads of rows that stay aren't shuffled.
    """
    now_c, keys = _ts(now), list(IDENTITY)
    old = typed(stored, LEDGER_SCHEMA).join(actions.select(*keys, "action", "merge_action"), keys, "left")
    # a stored row without an action took no part in this cycle
    old = old.withColumn("merge_action", F.coalesce("merge_action", F.lit("keep"))).where(~F.col("merge_action").isin(*FROM_SNAPSHOT))
    seen, gone = F.col("merge_action").isin("touch", "noop"), F.col("merge_action") == "cancel"
    old = old.withColumns(
        {
            "first_seen_at": F.coalesce(F.col("first_seen_at"), now_c),
            "last_seen_at": F.when(seen, now_c).otherwise(F.col("last_seen_at")),
            "is_active": F.when(seen, F.lit(True)).when(gone, F.lit(False)).otherwise(F.coalesce(F.col("is_active"), F.lit(True))),
            "deleted_at": F.when(gone, now_c).otherwise(F.col("deleted_at")),
        }
    )
    wanted = actions.where(F.col("merge_action").isin(*FROM_SNAPSHOT)).select(*keys, "first_seen", "action", "merge_action")
    taken = first_wins(current.join(wanted, keys), keys)
    taken = typed(taken, LEDGER_SCHEMA, keep=("first_seen", "action", "merge_action")).withColumns(
        {
            "first_seen_at": F.when(F.col("merge_action") == "insert", now_c).otherwise(F.coalesce(F.col("first_seen"), now_c)),
            "last_seen_at": now_c,
            "is_active": F.lit(True),
            "deleted_at": F.lit(None).cast("timestamp"),
            "ingest_run_id": F.lit(run_id),
        }
    )
    columns = [*LEDGER_SCHEMA.fieldNames(), "action", "merge_action"]
    return old.select(*columns).unionByName(taken.select(*columns))


def dealt_out(df: DataFrame) -> DataFrame:
    """Rows dealt out by employee and month: an employee-day lies whole in one partition, and days of one request lie together.

    ``_month`` stays, as the sign that they are; rows that have it aren't exchanged again. The number of partitions is the
    session's: merged ones would be sorted whole, and spill.
    """
    if MONTH in df.columns:
        return df
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn(MONTH, F.trunc("pto_date", "month")).repartition(n, "employee_xref", MONTH)


def ledger_apply(stored: DataFrame, current: DataFrame, *, now, run_id: str, settle: bool = True) -> DataFrame:
    """M1: the next ledger from all stored rows and this cycle's day records, with ``action`` (A4) and ``merge_action``.

    ``current`` may still hold duplicates; first wins by ordinal. Each side is read and exchanged once, whole: rows are dealt
    out by employee and month and sorted by identity, and flags, first copy and natural-key summary are windows over that one
    order. All values of the summary are maxima, so a group is passed in order, and one that is large spills.

    The result is settled, so that a collision of identities stops the cycle here; with ``settle=False`` it is a plan that raises as
    it runs. Such a plan keeps the column ``_month``: its rows are dealt out as the next cycle needs its stored rows.
    """
    now_c = _ts(now)
    order = _copy_order(current)
    text = identity_text(current, stored)
    cur = typed(current.withColumns({"_cur": F.lit(True), "_text": text}), LEDGER_SCHEMA, keep=("_cur", "_text", *order))
    sto = stored.withColumns({"_cur": F.lit(False), "_text": text})
    sto = typed(sto, LEDGER_SCHEMA, keep=("_cur", "_text", *[c for c in (MONTH,) if c in sto.columns]))
    rows = dealt_out(cur.withColumns(_unread_stamps())).unionByName(dealt_out(sto), allowMissingColumns=True)
    rows = _flagged(rows, [MONTH, *IDENTITY], order)
    day = Window.partitionBy(MONTH, *NATURAL_KEY)
    rows = with_action(rows.withColumns({n: e.over(day) for n, e in key_summary(HASH).items()}), HASH)
    known = _whole_identity()
    rows = rows.withColumns({"action": F.when(known, F.col("action")), "merge_action": F.when(known, _merge_action(now_c)).otherwise(F.lit("keep"))})
    applied = _next_rows(rows, now_c, run_id, ("action", "merge_action", MONTH))
    return settled(applied.drop(MONTH), "applied") if settle else applied


def _copy_order(current: DataFrame) -> list[str]:
    order = [c for c in DEFAULT_ORDER if c in current.columns]
    if not order:
        raise ValueError("first wins needs at least one ordering column")
    return order


def _unread_stamps() -> dict[str, Column]:
    """What the snapshot says of stamps and flags isn't read."""
    return {c: F.lit(None).cast(LEDGER_SCHEMA[c].dataType) for c in ("first_seen_at", "last_seen_at", "is_active", "deleted_at", "ingest_run_id")}


def _whole_identity() -> Column:
    """A row without a whole identity takes no part."""
    known = F.lit(True)
    for k in IDENTITY:
        known = known & F.col(k).isNotNull()
    return known


def _flagged(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Day records (``_cur``) and stored rows with their identity's flags and stamps, as windows over the one order of the identities."""
    copies = Window.partitionBy(*keys).orderBy(F.col("_cur").desc(), *order)
    whole = copies.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns(
        {
            "_copy": F.row_number().over(copies),
            "in_cur": F.max("_cur").over(whole),
            "stored": F.max(~F.col("_cur")).over(whole),
            "st_active": F.max(~F.col("_cur") & F.coalesce(F.col("is_active"), F.lit(True))).over(whole),
            "first_seen": F.max("first_seen_at").over(whole),
            "last_seen": F.max("last_seen_at").over(whole),
            "_least": F.min("_text").over(whole),
            "_greatest": F.max("_text").over(whole),
        }
    )
    return moved(one_text(rows, HASH))


def _next_rows(rows: DataFrame, now_c: Column, run_id: str, keep: Sequence[str] = ()) -> DataFrame:
    """Of flagged rows with their ``merge_action``, those that the ledger holds after it: first copies to insert or reactivate, stored rows else."""
    taken = F.col("_cur") & F.col("merge_action").isin(*FROM_SNAPSHOT)
    rows = rows.where((taken & (F.col("_copy") == 1)) | (~F.col("_cur") & ~F.col("merge_action").isin(*FROM_SNAPSHOT)))
    seen, gone = F.col("merge_action").isin("touch", "noop"), F.col("merge_action") == "cancel"
    first = F.when(F.col("merge_action") == "insert", now_c).when(F.col("_cur"), F.col("first_seen")).otherwise(F.col("first_seen_at"))
    stamps = {
        "first_seen_at": F.coalesce(first, now_c),
        "last_seen_at": F.when(F.col("_cur") | seen, now_c).otherwise(F.col("last_seen_at")),
        "is_active": F.when(F.col("_cur") | seen, F.lit(True)).when(gone, F.lit(False)).otherwise(F.coalesce(F.col("is_active"), F.lit(True))),
        "deleted_at": F.when(gone, now_c).when(~F.col("_cur"), F.col("deleted_at")),
        "ingest_run_id": F.when(F.col("_cur"), F.lit(run_id)).otherwise(F.col("ingest_run_id")),
    }
    return rows.select(*[stamps.get(c, F.col(c)).alias(c) for c in LEDGER_SCHEMA.fieldNames()], *keep)


# --------------------------------------------------------------------------- #
# M1 on a ledger bucketed by the identity                                      #
# --------------------------------------------------------------------------- #
def dealt_to_buckets(days: DataFrame, buckets: int) -> DataFrame:
    """Day records dealt out by identity, as a bucketed ledger's rows lie. Their hash doesn't travel: it is taken again from the fields it stands for."""
    again = record_hash_normalized("employee_xref", "pto_date", "approval_type_code", "hours_requested")
    return days.drop(HASH).repartition(buckets, *NATURAL_KEY, again).withColumn(HASH, again)


def bucketed_next(stored: DataFrame, days: DataFrame, *, now, run_id: str, buckets: int) -> DataFrame:
    """The ledger rows after a cycle, from bucketed ``stored`` rows and day records of :func:`expand.ledger_days`; first wins by ordinal.

    What happens to a row depends on its identity alone, so the snapshot is exchanged once and the next rows lie in the
    buckets they are written to. An employee-day with very many records is spread over the buckets. With the rows come their
    ``merge_action``, ``fresh``, ``gone`` and ``stays`` (was active and is seen); ``_one`` marks a single row of each identity.
    """
    order, keys, text = _copy_order(days), list(IDENTITY), identity_text(days, stored)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    cur = dealt_to_buckets(days.select(*NATURAL_KEY, *HASHED, HASH, *AUDIT, *order), buckets).withColumn("_text", text)
    copies = Window.partitionBy(*keys).orderBy(*order)
    ends = {"c_least": F.min("_text").over(copies.rowsBetween(*whole)), "c_greatest": F.max("_text").over(copies.rowsBetween(*whole))}
    cur = cur.withColumns({"_first": F.row_number().over(copies), **ends}).where("_first = 1")
    cur = typed(cur, LEDGER_SCHEMA, keep=("c_least", "c_greatest")).withColumns({**_unread_stamps(), "c_here": F.lit(True)})
    copies = Window.partitionBy(*keys).orderBy("last_seen_at")
    sto = typed(stored, LEDGER_SCHEMA).withColumn("_text", text)
    flags = {"active": F.coalesce(F.col("is_active"), F.lit(True)), "first_seen": F.col("first_seen_at"), "last_seen": F.col("last_seen_at"), "greatest": F.col("_text")}
    flags = {f"s_{n}": F.max(c).over(copies.rowsBetween(*whole)) for n, c in flags.items()}
    sto = sto.withColumns({"s_copy": F.row_number().over(copies), **flags, "s_least": F.min("_text").over(copies.rowsBetween(*whole)), "s_here": F.lit(True)}).drop("_text")
    fields = [f for f in LEDGER_SCHEMA.fieldNames() if f not in keys]
    rows = cur.join(sto.withColumnsRenamed({f: f"s_{f}" for f in fields}), keys, "full_outer").withColumns(
        {
            "in_cur": F.col("c_here").isNotNull(),
            "stored": F.col("s_here").isNotNull(),
            "st_active": F.coalesce("s_active", F.lit(False)),
            "first_seen": F.col("s_first_seen"),
            "last_seen": F.col("s_last_seen"),
            "_copy": F.coalesce("s_copy", F.lit(1)),
            "_least": F.least("c_least", "s_least"),
            "_greatest": F.greatest("c_greatest", "s_greatest"),
        }
    )
    rows = moved(one_text(rows, HASH)).withColumns({"_one": F.col("_copy") == 1, "stays": F.col("in_cur") & F.col("st_active")})
    rows = rows.withColumn("merge_action", F.when(_whole_identity(), _merge_action(_ts(now))).otherwise(F.lit("keep")))
    # a day record without a whole identity is left out
    rows = rows.withColumn("_cur", F.col("merge_action").isin(*FROM_SNAPSHOT)).where("_cur OR stored")
    values = [F.when(F.col("_cur"), F.col(f)).otherwise(F.col(f"s_{f}")).alias(f) for f in fields]
    flags = ("merge_action", "fresh", "gone", "stays", "_one")
    return _next_rows(rows.select(*keys, *values, "_cur", "_copy", "first_seen", "last_seen", *flags), _ts(now), run_id, flags)


def renamed_actions(applied: DataFrame) -> DataFrame:
    """Identities that changed or were superseded, by :func:`classify.renewed`, of rows of :func:`bucketed_next`, settled."""
    one = applied.where("_one")
    narrow = [*IDENTITY, F.col("first_seen_at").alias("first_seen")]
    return renewed(one.where("fresh").select(*narrow), one.where("gone").select(*narrow))


def _action_alone(named: Column) -> Column:
    """What appeared is new and what vanished is cancelled, unless it is ``named`` otherwise."""
    there = F.when(F.col("stays"), F.lit("unchanged")).when(F.col("fresh"), F.coalesce(named, F.lit("new")))
    return there.when(F.col("gone"), F.coalesce(named, F.lit("cancelled")))


def with_actions(applied: DataFrame, named: DataFrame) -> DataFrame:
    """Rows of :func:`bucketed_next` with their ``action``; those ``named`` by :func:`renamed_actions` lie in the same buckets."""
    rows = applied.join(named.select(*IDENTITY, F.col("action").alias("_named")).hint("shuffle_hash"), list(IDENTITY), "left")
    return rows.withColumn("action", _action_alone(F.col("_named"))).drop("_named")


def action_numbers(applied: DataFrame, named: DataFrame) -> DataFrame:
    """How many identities (``n``) have which ``action`` and ``merge_action``, without a join: the ``named`` ones are taken off what they were alone."""
    alone = applied.where("_one").withColumn("action", _action_alone(F.lit(None).cast("string")))
    alone = alone.groupBy("action", "merge_action").agg(F.count(F.lit(1)).alias("n"))
    more = named.groupBy("action").agg(F.count(F.lit(1)).alias("n"))
    less = more.select(F.when(F.col("action") == "changed", F.lit("new")).otherwise(F.lit("cancelled")).alias("action"), (-F.col("n")).alias("n"))
    return alone.unionByName(more.unionByName(less), allowMissingColumns=True)


def count_columns(column: str, names: dict[str, Sequence[str]], weight: str | None = None) -> list[Column]:
    """A BIGINT count per name of the rows whose ``column`` is one of its values; for ``agg`` and ``observe``. A row counts ``weight`` times."""
    found = {name: F.coalesce(F.col(column).isin(*values), F.lit(False)) for name, values in names.items()}
    if weight:
        return [F.coalesce(F.sum(F.when(c, F.col(weight))), F.lit(0)).cast("bigint").alias(name) for name, c in found.items()]
    return [F.count_if(c).cast("bigint").alias(name) for name, c in found.items()]


# fixed values: names of the counters and the actions they count
LEDGER_COUNTERS = {"inserted": ("insert",), "updated": ("update",), "reactivated": ("reactivate",), "touched": ("touch",), "cancelled": ("cancel",)}
MERGE_COUNTERS = {
    "num_inserted_rows": ("insert",),
    "num_updated_rows": ("update", "cancel"),
    "num_affected_rows": ("insert", "update", "cancel"),
    "num_unchanged_source_rows": ("unchanged",),
}


def ledger_counts(applied: DataFrame) -> DataFrame:
    """Exact merge counters of one apply."""
    return applied.agg(*count_columns("merge_action", LEDGER_COUNTERS))


def ledger_rows(applied: DataFrame, dealt: bool = False) -> DataFrame:
    """The stored columns of an apply result (what gets written); ``dealt``: with its ``_month``, for the next apply."""
    return applied.select(*LEDGER_SCHEMA.fieldNames(), *([MONTH] if dealt else []))


def active_records(ledger: DataFrame) -> DataFrame:
    """S14 + P24: (hash, employee, date) of active rows; missing flag = active."""
    return ledger.filter(F.coalesce(F.col("is_active"), F.lit(True))).select(
        "record_hash", "employee_xref", "pto_date"
    )


# --------------------------------------------------------------------------- #
# M2: employee upsert                                                          #
# --------------------------------------------------------------------------- #
# fixed value: part of the merge's contract
EMPLOYEE_COMPARED = ("employee_name", "DepartmentXRefCode", "ProjectId", "TaskId", "employment_status")


def employee_merge(target: DataFrame, source: DataFrame, *, now) -> DataFrame:
    """M2: key ``XRefCode``; rewrite only when a compared column differs
    (null-safe) or the stamp is missing; the stamp moves only when the status
    changed or was never set. Rows missing from the source stay (Q17); a
    source with two rows of one key raises (Q20)."""
    now_c = _ts(now)
    t = typed(target, EMPLOYEE_SCHEMA)
    s = unique_rows(typed(source, EMPLOYEE_SCHEMA).drop("UpdatedDateTime"), ["XRefCode"])
    j = t.select(F.col("XRefCode"), F.struct(*t.columns).alias("t")).join(
        s.select(F.col("XRefCode"), F.struct(*s.columns).alias("s")), "XRefCode", "full_outer"
    )
    diff = F.lit(False)
    for c in EMPLOYEE_COMPARED:
        diff = diff | changed(F.col(f"t.{c}"), F.col(f"s.{c}"))
    diff = diff | F.col("t.UpdatedDateTime").isNull()
    action = (
        F.when(F.col("t").isNull(), F.lit("insert"))
        .when(F.col("s").isNull(), F.lit("keep"))
        .when(diff, F.lit("update"))
        .otherwise(F.lit("unchanged"))
    )
    j = j.withColumn("merge_action", action)
    take_s = F.col("merge_action").isin("insert", "update")
    cols = [F.col("XRefCode")]
    for c in EMPLOYEE_COMPARED:
        cols.append(F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    status_same = F.col("t.employment_status").eqNullSafe(F.col("s.employment_status"))
    stamp = (
        F.when(F.col("merge_action") == "insert", now_c)
        .when((F.col("merge_action") == "update") & ~(status_same & F.col("t.UpdatedDateTime").isNotNull()), now_c)
        .otherwise(F.col("t.UpdatedDateTime"))
    )
    return j.select(*cols, stamp.alias("UpdatedDateTime"), "merge_action").select(
        *EMPLOYEE_SCHEMA.fieldNames(), "merge_action"
    )


# --------------------------------------------------------------------------- #
# Day-table upsert                                              #
# --------------------------------------------------------------------------- #
# fixed value: part of the merge's contract
DAY_COMPARED = ("Status", "ReasonName", "PayAdjShortName")
# fixed value: part of the merge's contract
CANCELED = "Canceled"


def day_merge(
    target: DataFrame,
    source: DataFrame,
    *,
    now,
    run_keys: DataFrame | None,
    window_start: str,
    window_end: str,
) -> DataFrame:
    """M3: key ``RecordHash``. Matched rows are rewritten only when status,
    reason or pay code differ (null-safe) or the stamp is missing; unmatched
    source rows are inserted; target rows absent from the source are set to
    ``Canceled`` only inside this run's scope — key in ``run_keys`` (a
    semi-join, so an empty key set cancels nothing: M4), date within the
    window, not already cancelled (P26)."""
    now_c = _ts(now)
    t = typed(target, DAY_SCHEMA)
    s = typed(source, DAY_SCHEMA).drop("UpdatedDateTime")
    j = t.select(F.col("RecordHash"), F.struct(*t.columns).alias("t")).join(
        s.select(F.col("RecordHash"), F.struct(*s.columns).alias("s")), "RecordHash", "full_outer"
    )
    diff = F.lit(False)
    for c in DAY_COMPARED:
        diff = diff | changed(F.col(f"t.{c}"), F.col(f"s.{c}"))
    diff = diff | F.col("t.UpdatedDateTime").isNull()
    candidate = (
        F.col("s").isNull()
        & F.col("t.Date").between(F.to_date(F.lit(window_start)), F.to_date(F.lit(window_end)))
        & (F.col("t.Status") != CANCELED)
    )
    if run_keys is None:
        in_scope = F.lit(False)
    else:
        # only rows that may be canceled look for their employee; all others get a key of their own that none has
        own = F.when(candidate, F.col("t.XRefCode")).otherwise(F.concat(F.lit("\u0000"), F.col("RecordHash")))
        keys = run_keys.select(F.col(run_keys.columns[0]).cast("string").alias("_scope"), F.lit(True).alias("_in_run"))
        j = j.withColumn("_scope", own).join(keys.distinct(), "_scope", "left")
        in_scope = candidate & F.col("_in_run")
    action = (
        F.when(F.col("t").isNull(), F.lit("insert"))
        .when(F.col("s").isNotNull() & diff, F.lit("update"))
        .when(F.col("s").isNotNull(), F.lit("unchanged"))
        .when(F.coalesce(in_scope, F.lit(False)), F.lit("cancel"))
        .otherwise(F.lit("keep"))
    )
    j = j.withColumn("merge_action", action)
    take_s = F.col("merge_action").isin("insert", "update")
    cols = [F.col("RecordHash")]
    for c in ("XRefCode", "Date", "Hours", "ReasonName", "PayAdjShortName"):
        cols.append(F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    cols.append(
        F.when(take_s, F.col("s.Status"))
        .when(F.col("merge_action") == "cancel", F.lit(CANCELED))
        .otherwise(F.col("t.Status"))
        .alias("Status")
    )
    cols.append(
        F.when(F.col("merge_action").isin("insert", "update", "cancel"), now_c)
        .otherwise(F.col("t.UpdatedDateTime"))
        .alias("UpdatedDateTime")
    )
    return j.select(*cols, "merge_action").select(*DAY_SCHEMA.fieldNames(), "merge_action")


def day_merge_stored(
    table: StoredTable, source: DataFrame, *, now, run_keys: DataFrame | None, window_start: str, window_end: str
) -> tuple[DataFrame, list[str]]:
    """M3 against a month-partitioned table: reads only months of the window and of the source's dates.

    A record's hash holds its date, so a match can't lie in another month, and a row outside the window is never
    canceled. Returns the next rows of those months and their names (the months of the source are few and named
    by one narrow aggregate); the scan of ``table`` has them as partition filter. ``source`` is read twice.
    """
    named = source.select(F.date_format("Date", "yyyy-MM").alias("part")).distinct()
    window = F.sequence(F.trunc(F.to_date(F.lit(window_start)), "month"), F.to_date(F.lit(window_end)), F.expr("INTERVAL 1 MONTH"))
    span = source.sparkSession.range(1).select(F.explode(F.transform(window, lambda d: F.date_format(d, "yyyy-MM"))).alias("part"))
    parts = sorted({r["part"] for r in named.unionByName(span).collect() if r["part"]})
    merged = day_merge(table.read(parts), source, now=now, run_keys=run_keys, window_start=window_start, window_end=window_end)
    return merged, parts


def merge_metrics(merged: DataFrame) -> DataFrame:
    """Inserted / updated (incl. cancelled) / affected / unchanged source rows."""
    return merged.agg(*count_columns("merge_action", MERGE_COUNTERS))


__all__ = [
    "LEDGER_ACTIONS",
    "NATURAL_KEY",
    "active_records",
    "changed",
    "day_merge",
    "day_merge_stored",
    "employee_merge",
    "ledger_actions",
    "ledger_apply",
    "ledger_counts",
    "ledger_next",
    "ledger_rows",
    "merge_metrics",
    "stored_after",
    "unique_rows",
]
