"""Pickers over arrays of semi-structured items.

Payload collections arrive as ``VARIANT`` (landed JSON). Each picker is a
higher-order-function expression over the row's own array, so no explode or
shuffle is needed. "Latest / first on tie" is done by ordering on
``(key, -index)`` and fetching the winner by index: a VARIANT cannot be
ordered itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.functions.values import lenient_date

MIN_DATE = "0001-01-01"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vget(v: Column, path: str, type_name: str = "string") -> Column:
    """Safe nested path (null when any step is missing or not an object)."""
    return F.try_variant_get(v, path, type_name)


def is_object(v: Column) -> Column:
    return vget(v, "$", "map<string,variant>").isNotNull()


def objects(arr: Column) -> Column:
    """Keep only object members of an ``array<variant>``."""
    return F.filter(arr, is_object)


def as_items(v) -> Column:
    """P10: ``{"Items":[…]}``, ``{"items":[…]}`` or a bare ``[…]`` → object members."""
    v = _col(v)
    arr = F.coalesce(
        vget(v, "$.Items", "array<variant>"),
        vget(v, "$.items", "array<variant>"),
        vget(v, "$", "array<variant>"),
    )
    return objects(arr)


def wrapped_items(v) -> Column:
    """Only the ``{"Items":[…]}`` form (as the per-employee detail readers accept)."""
    return objects(vget(_col(v), "$.Items", "array<variant>"))


def truthy_bool(v: Column, path: str) -> Column:
    return F.coalesce(vget(v, path, "boolean"), F.lit(False))


def text(v: Column, path: str) -> Column:
    """String at ``path``; ``''`` counts as missing."""
    return F.nullif(vget(v, path, "string"), F.lit(""))


def latest_by_text(items: Column, path: str) -> Column:
    """Item with the greatest text at ``path`` (missing = ''), first on tie."""
    best = F.array_max(
        F.transform(items, lambda x, i: F.struct(F.coalesce(vget(x, path, "string"), F.lit("")).alias("k"), (-i).alias("ni")))
    )
    return F.get(items, -best["ni"])


def first_or_primary(items: Column, flag_path: str = "$.IsPrimary") -> Column:
    """First item whose flag is true, else the first item."""
    return F.coalesce(F.get(F.filter(items, lambda x: truthy_bool(x, flag_path)), 0), F.get(items, 0))


def _start(x: Column, both: bool = True) -> Column:
    s = text(x, "$.EffectiveStart")
    if both:
        s = F.coalesce(s, text(x, "$.EffectiveStartDate"))
    return lenient_date(s)


def _end(x: Column) -> Column:
    return lenient_date(F.coalesce(text(x, "$.EffectiveEnd"), text(x, "$.EffectiveEndDate")))


def with_effective_item(df, items: str, as_of: Column, out: str):
    """The item effective on ``as_of``, in column ``out``.

    Covering items (open bounds allowed, both ends inclusive); when none
    cover, all items (then only ``EffectiveStart`` is read for ordering). In
    that pool: the first primary (``IsPrimary`` or ``IsPrimaryWork``), else
    the greatest start (missing = lowest), first on tie. Covering set, pool and pick
    are projected in stages, so the arrays are not re-filtered for every use.
    """
    it_ = F.col(items)
    df = df.withColumn(
        f"{out}_cov",
        F.filter(it_, lambda x: (_start(x).isNull() | (_start(x) <= as_of)) & (_end(x).isNull() | (_end(x) >= as_of))),
    )
    cov = F.col(f"{out}_cov")
    df = df.withColumns({f"{out}_use": F.size(cov) > 0, f"{out}_pool": F.when(F.size(cov) > 0, cov).otherwise(it_)})
    pool, use = F.col(f"{out}_pool"), F.col(f"{out}_use")
    primary = F.get(F.filter(pool, lambda x: truthy_bool(x, "$.IsPrimary") | truthy_bool(x, "$.IsPrimaryWork")), 0)
    best = F.array_max(
        F.transform(
            pool,
            lambda x, i: F.struct(
                F.coalesce(F.when(use, _start(x)).otherwise(_start(x, both=False)), F.to_date(F.lit(MIN_DATE))).alias("k"),
                (-i).alias("ni"),
            ),
        )
    )
    df = df.withColumn(out, F.coalesce(primary, F.get(pool, -best["ni"])))
    return df.drop(f"{out}_cov", f"{out}_use", f"{out}_pool")


__all__ = [
    "with_effective_item",
    "as_items",
    "first_or_primary",
    "is_object",
    "latest_by_text",
    "objects",
    "text",
    "vget",
    "wrapped_items",
]
