"""Request windows, look-back spans and the request manifest.

Windows are regular steps from a start, so the window a timestamp falls in
is arithmetic; the manifest is each employee's row exploded over a small,
parameter-bounded array of (status, window) pairs — no cross join, no
driver loop over employees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.values import iso_instant

# --- fixed values: default span and chunking of the scheduled day-table run --
LOOKBACK_DAYS = 30
HORIZON_DAYS = 90
CHUNK_DAYS = 30
DEFAULT_STATUSES = ("APPROVED", "CANCELED")
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _days(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} DAYS")


def chunk_windows(start, end, n_days: int) -> Column:
    """``[start, end)`` cut into consecutive ``n_days`` windows; edges shared,
    the last one cut at ``end``; empty when ``start >= end``.

    Returns ``array<struct<window_idx, lo, hi>>`` (explode it).
    """
    s, e = _col(start), _col(end)
    steps = F.sequence(s, e, _days(n_days))
    arr = F.transform(
        F.filter(steps, lambda lo: lo < e),
        lambda lo, i: F.struct(i.alias("window_idx"), lo.alias("lo"), F.least(lo + _days(n_days), e).alias("hi")),
    )
    return F.when(s < e, arr)


def inclusive_windows(start, end, n_days: int) -> Column:
    """Whole-day windows ``[lo, min(lo + n - 1, end)]`` stepping ``n`` days while ``lo <= end``."""
    s, e = _col(start), _col(end)
    arr = F.transform(
        F.sequence(s, e, _days(n_days)),
        lambda lo, i: F.struct(i.alias("window_idx"), lo.alias("lo"), F.least(F.date_add(lo, n_days - 1), e).alias("hi")),
    )
    return F.when(s <= e, arr)


def lookback_span(now, lookback_days: int = LOOKBACK_DAYS, horizon_days: int = HORIZON_DAYS) -> tuple[Column, Column]:
    """UTC start of day of (now − lookback), last millisecond of the day of (now + horizon)."""
    n = _col(now)
    lo = F.date_trunc("day", n - _days(lookback_days))
    hi = F.date_trunc("day", n + _days(horizon_days)) + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MILLISECOND")
    return lo, hi


def span_dates(now: str, lookback_days: int = LOOKBACK_DAYS, horizon_days: int = HORIZON_DAYS) -> tuple[str, str]:
    """S8/S9 for a literal ``now``: first and last calendar day of the run's span."""
    import datetime as dt

    t = dt.datetime.fromisoformat(now)
    return (str((t - dt.timedelta(days=lookback_days)).date()), str((t + dt.timedelta(days=horizon_days)).date()))


def span_iso(now, **kw) -> tuple[Column, Column]:
    """S8 rendered as the source API's ISO-8601 UTC text with milliseconds."""
    lo, hi = lookback_span(now, **kw)
    return iso_instant(lo), iso_instant(hi)


def run_windows(now, lookback_days: int = LOOKBACK_DAYS, horizon_days: int = HORIZON_DAYS, chunk_days: int = CHUNK_DAYS) -> Column:
    """The scheduled run's span (now − lookback … now + horizon) in ``chunk_days`` windows."""
    n = _col(now)
    return chunk_windows(n - _days(lookback_days), n + _days(horizon_days), chunk_days)


def manifest(employees: DataFrame, key: str, windows: Column, statuses: Sequence[str] = DEFAULT_STATUSES) -> DataFrame:
    """S5 + J12 + U2: one row per (employee, status, window), in request order.

    ``windows`` is an array column of ``struct<window_idx, lo, hi>`` (e.g.
    from :func:`run_windows` on a literal ``now``); the status × window array
    is bounded by the parameters, and exploding it replaces a cross product.
    """
    st = F.array(*[F.struct(F.lit(i).alias("status_rank"), F.lit(s).alias("status")) for i, s in enumerate(statuses)])
    combos = F.flatten(F.transform(st, lambda s: F.transform(windows, lambda w: F.struct(s["status_rank"], s["status"], w["window_idx"], w["lo"], w["hi"]))))
    return employees.select(key, F.inline(combos))


def matching(requests: DataFrame, windows: Column, statuses: Sequence[str], status: str, start, end, always: Column | None = None) -> DataFrame:
    """One row per request and window that it overlaps, with ``status_rank`` and ``window_idx``.

    Overlap is ``start <= hi and end >= lo`` (a missing end counts as the
    start); a request spanning a window edge matches both windows, as the
    source returned it twice. The windows are a literal array, so matching is
    a filter on the request's own row: no join. Rows for which ``always``
    holds are kept once, with window 0.
    """
    s = _col(start)
    e = F.coalesce(_col(end), s)
    always = F.lit(False) if always is None else F.coalesce(always, F.lit(False))
    rank = F.array_position(F.array(*[F.lit(x) for x in statuses]), F.col(status)).cast("int") - 1
    hits = F.transform(F.filter(windows, lambda w: (s <= w["hi"]) & (e >= w["lo"])), lambda w: w["window_idx"])
    idx = F.when(always, F.array(F.lit(0))).otherwise(hits)
    return requests.filter(F.col(status).isin(*statuses)).select("*", rank.alias("status_rank"), F.explode(idx).alias("window_idx"))
