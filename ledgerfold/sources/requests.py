"""Landed request pages → typed request rows (S3, P13 on the payload).

A request page lands as JSON (``{"Data":[entry, …], "Paging":…}``) with the
employee key, queried status and window as landing metadata columns. Entries
become typed columns with candidate keys resolved by ``coalesce``; the raw
entry text is kept as ``source_payload`` (not part of the identity).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import items as it
from ledgerfold.operators.expand import DAY_DATE_KEYS, DAY_HOURS_KEYS, DAY_LIST_KEYS
from ledgerfold.sources.pages import unwrap_list

ENTRY_TEXT_FIELDS = (
    "TimeStart",
    "TimeEnd",
    "ReasonName",
    "PayAdjustmentCodeName",
    "PayAdjustmentCodeXRefCode",
    "PayAdjShortName",
    "DateOfRequest",
    "Status",
    "AllDay",
)
#: Hours stay text, so that a value which is there but no number is told from a missing one.
DAY_LIST_TYPE = "array<struct<Date:string,NetHours:string>>"


def _day_list(row: Column) -> Column:
    """The first present day-list key (an empty list counts, null and '' don't), elements as (Date, NetHours).

    A key that is present without being a list ends the search: the request has no breakdown.
    """
    chosen = None
    for k in reversed(DAY_LIST_KEYS):
        value = it.vget(row, f"$.{k}", "variant")
        present = value.isNotNull() & ~F.is_variant_null(value) & ~F.coalesce(it.vget(row, f"$.{k}") == "", F.lit(False))
        chosen = F.when(present, it.vget(row, f"$.{k}", "array<variant>")).otherwise(F.lit(None) if chosen is None else chosen)

    def elem(x: Column) -> Column:
        date = F.coalesce(*[it.text(x, f"$.{k}") for k in DAY_DATE_KEYS])
        hours = F.coalesce(*[it.text(x, f"$.{k}") for k in DAY_HOURS_KEYS])
        return F.when(it.is_object(x), F.struct(date.alias("Date"), hours.alias("NetHours")))

    return F.transform(chosen, elem).cast(DAY_LIST_TYPE)


def entries_from_pages(pages: DataFrame, keep: tuple[str, ...] = ("employee_key", "page_id")) -> DataFrame:
    """S3: one typed request row per object entry of each landed page.

    ``entry_idx`` is the entry's position in its page; with ``page_id`` (and
    any status/window ranks kept) it orders "first wins" downstream.
    """
    keep = tuple(c for c in (*keep, "status_rank", "window_idx", "query_status") if c in pages.columns)
    rows = unwrap_list(pages, keep=keep)
    r = F.col("row")
    fields = {f: it.vget(r, f"$.{f}") for f in ENTRY_TEXT_FIELDS}
    return rows.select(
        *keep,
        F.col("row_idx").cast("long").alias("entry_idx"),
        *[v.alias(k) for k, v in fields.items()],
        it.vget(r, "$.NetHours").alias("NetHours"),
        _day_list(r).alias("DayList"),
        F.to_json(r).alias("source_payload"),
    )
