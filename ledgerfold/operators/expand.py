"""Request → day rows.

Per request, one projection decides the source of its days (explicit list,
even split or the start day), computes the split's scalars once and
validates the request as a whole (kept or rejected entirely); then a single
``explode`` over the day index yields the days, whose date and hours are
derived after the generator. No Python runs per row; the fan-out is bounded
by the request's own day span.

Two conventions exist and are kept apart:

* ledger flow (:func:`ledger_days`): explicit per-day list, else an even
  split over calendar days with the end date *inclusive* (option), else one
  row on the start date; missing hours → 0.
* day-table flow (:func:`weekday_days`): weekdays only, end *exclusive*,
  hours = total / weekday count (8.0 per day when absent).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ledgerfold.functions.identity import (
    norm_hours,
    norm_token,
    record_hash_normalized,
)
from ledgerfold.functions.values import first_text, lenient_date, title_status, tri_bool
from ledgerfold.operators.partitioning import with_materialized

# --- fixed values: candidate field names in the source payload, by priority --
TYPE_CODE_KEYS = ("PayAdjustmentCodeName", "PayAdjustmentCodeXRefCode", "ReasonName")
DAY_LIST_KEYS = ("DayList", "Days", "TAFWDays", "TimeAwayFromWorkDays")
DAY_DATE_KEYS = ("Date", "DateTime", "WorkDate")
DAY_HOURS_KEYS = ("NetHours", "Hours", "HoursRequested")
DAY_TABLE_TYPE_KEYS = ("PayAdjShortName", "ReasonName")
DEFAULT_DAY_HOURS = 8.0
# ---------------------------------------------------------------------------

def _present(df: DataFrame, names) -> list[str]:
    cols = set(df.columns)
    return [n for n in names if n in cols]


def _null_col(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def _number(value: Column, missing: float) -> Column:
    """A number or numeric text; null or '' counts as ``missing``, anything unreadable is null."""
    text = value.cast("string")
    return F.when(text.isNull() | (text == ""), F.lit(missing)).otherwise(text.try_cast("double"))


def _first_field(elem: Column, fields: dict, names) -> Column:
    """P13 over the fields of one array element (text fields skip '')."""
    cands = []
    for n in names:
        if n not in fields:
            continue
        v = elem[n]
        cands.append(F.nullif(v, F.lit("")) if isinstance(fields[n], StringType) else v)
    return F.coalesce(*cands) if cands else F.lit(None)


def _day_list(df: DataFrame):
    """X1 source array: first present of the day-list fields (an empty list counts)."""
    names = [n for n in _present(df, DAY_LIST_KEYS) if isinstance(df.schema[n].dataType, ArrayType)]
    if not names:
        return None, {}
    elem_type = df.schema[names[0]].dataType.elementType
    fields = {f.name: f.dataType for f in elem_type.fields} if isinstance(elem_type, StructType) else {}
    return F.coalesce(*[F.col(n) for n in names]), fields


def _spread_scalars(df: DataFrame) -> DataFrame:
    """X2 + W3 scalars, once per request: first day, day count, per-day and last-day hours.

    Reversed dates are swapped; every day but the last gets ``total / n``
    rounded half-even to 2 decimals, the last the rounded remainder (so the
    split keeps the total), a single day keeps the total as given.
    """
    lo, hi = F.least("_start", "_end"), F.greatest("_start", "_end")
    df = with_materialized(
        df, {"_lo": lo, "_n": F.datediff(hi, lo) + 1, "_total": F.col("_hours").try_cast("decimal(38,18)")}
    )
    # a total beyond the decimal's range gives null, and so a rejected request
    per = F.bround(F.col("_total").try_cast("decimal(28,18)") / F.col("_n").cast("decimal(10,0)"), 2)
    df = with_materialized(df, {"_per_raw": per})
    return with_materialized(
        df,
        {
            "_per": norm_hours(F.col("_per_raw")),
            "_last": norm_hours(F.bround(F.col("_total") - F.col("_per_raw") * (F.col("_n") - 1), 2)),
            "_one": norm_hours(F.col("_total")),
        },
    )


def _elem_date(e: Column, fields: dict) -> Column:
    return lenient_date(_first_field(e, fields, DAY_DATE_KEYS))


def _elem_hours(e: Column, fields: dict) -> Column:
    return norm_hours(_first_field(e, fields, DAY_HOURS_KEYS))


def ledger_entries(
    entries: DataFrame,
    *,
    key: str = "employee_key",
    expand_multi_day: bool = False,
) -> DataFrame:
    """P13-P16 + X4 per request, before any explode.

    Adds ``_mode`` (``list`` = explicit per-day list X1, ``spread`` = even
    split X2, ``single`` = one row on the start date), the scalars each mode
    needs, ``reject_reason`` and ``valid``. Validity is decided for the whole
    request here, so a request is kept or rejected entirely (P14).
    """
    e = with_materialized(
        entries,
        {
            "type_raw": first_text(*[F.col(c) for c in _present(entries, TYPE_CODE_KEYS)]),
            "_start": lenient_date(F.col("TimeStart")),
            "_hours": _number(_null_col(entries, "NetHours", "double"), 0.0),
        },
    )
    dl, fields = _day_list(e)
    usable = F.lit(False)
    if dl is not None and fields:
        e = e.withColumn("_dl", dl)
        usable = (F.size("_dl") > 0) & F.forall(
            "_dl",
            lambda x: x.isNotNull()
            & _first_field(x, fields, DAY_DATE_KEYS).isNotNull()
            & _first_field(x, fields, DAY_HOURS_KEYS).isNotNull(),
        )
    else:
        e = e.withColumn("_dl", F.lit(None).cast("array<struct<Date:string,NetHours:double>>"))
        fields = {"Date": StringType(), "NetHours": None}
    mode = F.when(usable, F.lit("list"))
    if expand_multi_day:
        time_end = _null_col(e, "TimeEnd")
        mode = mode.when(time_end.isNotNull() & (time_end != ""), F.lit("spread"))
        e = e.withColumn("_end", lenient_date(time_end))
    else:
        e = e.withColumn("_end", F.lit(None).cast("date"))
    e = _spread_scalars(e.withColumn("_mode", mode.otherwise(F.lit("single"))))
    # dates and hours of a list are read once, here; a day takes its element
    listed = F.transform("_dl", lambda x: F.struct(_elem_date(x, fields).alias("day"), _elem_hours(x, fields).alias("hours")))
    e = with_materialized(e, {"_listed": F.when(F.col("_mode") == "list", listed)})
    list_ok = F.forall("_listed", lambda x: x["day"].isNotNull() & x["hours"].isNotNull())
    spread_ok = F.col("_lo").isNotNull() & F.when(
        F.col("_n") == 1, F.col("_one").isNotNull()
    ).otherwise(F.col("_per").isNotNull() & F.col("_last").isNotNull())
    single_ok = F.col("_start").isNotNull() & norm_hours(F.col("_hours")).isNotNull()
    days_ok = (
        F.when(F.col("_mode") == "list", list_ok).when(F.col("_mode") == "spread", spread_ok).otherwise(single_ok)
    )
    # identity parts are per request: normalised once, not once per exploded day
    e = with_materialized(e, {"_key_n": norm_token(F.col(key)), "_type_n": norm_token(F.col("type_raw"))})
    reason = (
        F.when(F.col("type_raw").isNull(), F.lit("no_type_code"))
        .when(F.col("_key_n").isNull(), F.lit("bad_employee_key"))
        .when(F.col("_type_n").isNull(), F.lit("bad_type_code"))
        .when(~F.coalesce(days_ok, F.lit(False)), F.lit("bad_day"))
    )
    e = with_materialized(e, {"reject_reason": reason})
    return e.withColumn("valid", F.col("reject_reason").isNull())


_SCRATCH = ("type_raw", "_start", "_hours", "_dl", "_listed", "_end", "_mode", "_lo", "_n", "_total", "_per_raw", "_per", "_last", "_one", "_key_n", "_type_n")


def ledger_days(
    entries: DataFrame,
    *,
    key: str = "employee_key",
    query_status: str | None = None,
    expand_multi_day: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Valid requests exploded to day records (P17/P18): identity + audit columns.

    One ``explode`` over the day index; dates and hours of each day are
    computed after it from the request's scalars (or its list element).
    """
    e = ledger_entries(entries, key=key, expand_multi_day=expand_multi_day)
    status = F.coalesce(F.nullif(_null_col(e, "Status"), F.lit("")), _null_col(e, "query_status"), F.lit(query_status))
    audit = {
        "reason_name": _null_col(e, "ReasonName"),
        "status": status,
        "time_start": _null_col(e, "TimeStart"),
        "time_end": _null_col(e, "TimeEnd"),
        "all_day": tri_bool(_null_col(e, "AllDay")),
        "date_of_request": _null_col(e, "DateOfRequest"),
        "source_payload": _null_col(e, "source_payload"),
    }
    lineage = [c for c in ("status_rank", "window_idx", "page_id", "entry_idx") if c in e.columns]
    count = (
        F.when(F.col("_mode") == "list", F.size("_listed")).when(F.col("_mode") == "spread", F.col("_n")).otherwise(F.lit(1))
    )
    # Invalid requests explode a null array (no rows) instead of being
    # filtered: a filter would be evaluated a second time, in the scan stage.
    exploded = e.select(
        *keep,
        *lineage,
        F.col("_key_n").alias("employee_xref"),
        F.col("_type_n").alias("approval_type_code"),
        *[v.alias(k) for k, v in audit.items()],
        "_mode",
        "_listed",
        "_start",
        "_hours",
        "_lo",
        "_n",
        "_per",
        "_last",
        "_one",
        F.explode(F.when(F.col("valid"), F.sequence(F.lit(0), count - 1))).alias("day_idx"),
    )
    elem = F.get(F.col("_listed"), F.col("day_idx"))
    i, n = F.col("day_idx"), F.col("_n")
    pto_date = (
        F.when(F.col("_mode") == "list", elem["day"])
        .when(F.col("_mode") == "spread", F.date_add(F.col("_lo"), i))
        .otherwise(F.col("_start"))
    )
    hours = (
        F.when(F.col("_mode") == "list", elem["hours"])
        .when((F.col("_mode") == "spread") & (n == 1), F.col("_one"))
        .when((F.col("_mode") == "spread") & (i == n - 1), F.col("_last"))
        .when(F.col("_mode") == "spread", F.col("_per"))
        .otherwise(norm_hours(F.col("_hours")))
    )
    days = exploded.withColumns({"pto_date": pto_date, "hours_requested": hours})
    return days.select(
        *keep,
        *lineage,
        "day_idx",
        F.col("_mode").alias("day_source"),
        "employee_xref",
        "pto_date",
        "approval_type_code",
        "hours_requested",
        *audit.keys(),
        record_hash_normalized("employee_xref", "pto_date", "approval_type_code", "hours_requested").alias(
            "record_hash"
        ),
    )


def rejected_entries(entries: DataFrame, **kw) -> DataFrame:
    """P14/P15 quarantine: requests skipped as a whole, with the reason."""
    e = ledger_entries(entries, **kw)
    return e.filter(~F.col("valid")).drop("valid", *_SCRATCH)


# --------------------------------------------------------------------------- #
# Day-table flow (X3)                                                          #
# --------------------------------------------------------------------------- #
def weekday_array(start_text: Column, end_text: Column) -> Column:
    """24-hour steps from start while < end, Monday-Friday only."""
    start = start_text.try_cast("timestamp_ntz")
    end = end_text.try_cast("timestamp_ntz")
    steps = F.sequence(start, end - F.expr("INTERVAL 1 MICROSECOND"), F.expr("INTERVAL 1 DAY"))
    return F.when(end > start, F.filter(steps, lambda d: F.weekday(d) < 5)).otherwise(
        F.array().cast("array<timestamp_ntz>")
    )


def _weekday_plan(tagged: DataFrame) -> DataFrame:
    """Per tagged request: weekday array, per-day hours, type and validity (each computed once)."""
    start, end = F.col("TimeStart"), _null_col(tagged, "TimeEnd")
    net = _null_col(tagged, "NetHours", "double")
    pay = _null_col(tagged, "PayAdjShortName")
    reason = _null_col(tagged, "ReasonName")
    p = with_materialized(
        tagged,
        {
            "_days": weekday_array(start, end),
            "_type": F.when(pay.isNotNull() & (pay != ""), pay).otherwise(F.coalesce(reason, F.lit("None"))),
            "_parsed": start.try_cast("timestamp_ntz").isNotNull() & end.try_cast("timestamp_ntz").isNotNull(),
        },
    )
    n = F.size("_days")
    p = with_materialized(
        p,
        {"_hours": F.when(net.isNull(), F.lit(DEFAULT_DAY_HOURS)).otherwise(F.try_divide(net.try_cast("double"), n))},
    )
    why = (
        F.when(~F.col("_parsed"), F.lit("bad_time_span"))
        .when(n == 0, F.lit(None).cast("string"))  # without a weekday nothing else is looked at
        .when(norm_token(F.col("_XRefCode")).isNull(), F.lit("bad_employee_key"))
        .when(norm_token(F.col("_type")).isNull(), F.lit("bad_type_code"))
        .when(norm_hours(F.col("_hours")).isNull(), F.lit("bad_hours"))
    )
    p = with_materialized(p, {"reject_reason": why}).drop("_parsed")
    # identity parts are per request: normalise once, not once per exploded day
    return with_materialized(
        p,
        {
            "_key_n": norm_token(F.col("_XRefCode")),
            "_type_n": norm_token(F.col("_type")),
            "_hours_n": norm_hours(F.col("_hours")),
        },
    )


def weekday_days(tagged: DataFrame) -> DataFrame:
    """X3 + H10 + H6: tagged requests → one row per weekday off.

    ``Hours`` is total / weekday count as a double rounded half-even into
    ``DECIMAL(6,2)``; the identity uses the key as normalised, the stored
    ``XRefCode`` stays as given. A request that cannot be expanded is
    rejected whole (see :func:`weekday_rejects`), never partly.
    """
    p = _weekday_plan(tagged)
    lineage = [c for c in ("status_rank", "window_idx", "entry_idx") if c in tagged.columns]
    rows = p.select(
        *lineage,
        F.col("_XRefCode").alias("XRefCode"),
        _null_col(p, "ReasonName").alias("ReasonName"),
        _null_col(p, "PayAdjShortName").alias("PayAdjShortName"),
        title_status(F.col("_Status")).alias("Status"),
        "_key_n",
        "_type_n",
        "_hours_n",
        F.posexplode(F.when(F.col("reject_reason").isNull(), F.col("_days"))).alias("day_idx", "_day"),
    )
    day = F.col("_day").cast("date")
    return rows.select(
        *lineage,
        "day_idx",
        "XRefCode",
        day.alias("Date"),
        F.col("_hours_n").alias("Hours"),
        "ReasonName",
        "PayAdjShortName",
        "Status",
        record_hash_normalized(F.col("_key_n"), day, F.col("_type_n"), F.col("_hours_n")).alias("RecordHash"),
    )


def weekday_rejects(tagged: DataFrame) -> DataFrame:
    """Tagged requests that cannot be expanded (the source job stopped on them)."""
    p = _weekday_plan(tagged)
    return p.filter(F.col("reject_reason").isNotNull()).drop("_days", "_hours", "_type")


__all__ = [
    "ledger_entries",
    "ledger_days",
    "rejected_entries",
    "weekday_array",
    "weekday_days",
    "weekday_rejects",
]
