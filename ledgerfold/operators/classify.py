"""Snapshot vs stored table: new / changed / unchanged / cancelled / superseded.

Plan shape (no driver collect, no IN-lists, no per-row Python):

1. ``current ∪ stored``, keys and flags only, grouped by identity
   ``(employee, date, hash)``. All values are maxima or minima of fixed width, so
   copies combine in a hash aggregate before the one exchange.
2. Per natural key ``(employee, date)``: does anything new appear, does an active
   stored row vanish, and which vanished hash is the "last" one (greatest
   ``(first_seen_at, hash)``). Identities that neither appear nor vanish don't
   take part. :func:`paired` takes partial maxima of the vanished per (key, salt), then per key,
   and joins them back, so that an employee-day with very many records is
   spread over tasks; :func:`reconcile` uses a window where that isn't asked for.
3. Each identity takes its action from a CASE over its flags and summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.sources.tables import settled

NATURAL_KEY = ("employee_xref", "pto_date")
HASH = "record_hash"
ACTIONS = ("new", "changed", "unchanged", "cancelled", "superseded")
#: Columns that, with the natural key, make up an identity's text.
HASHED = ("approval_type_code", "hours_requested")
#: Parts a natural key is summed up in first.
SALTS = 64


def identity_text(current: DataFrame, stored: DataFrame) -> Column:
    """A second hash of an identity's text; null unless both sides have the hashed columns."""
    if all(c in current.columns and c in stored.columns for c in HASHED):
        return F.xxhash64(F.col(HASHED[0]), F.col(HASHED[1]).cast("decimal(6,2)"))
    return F.lit(None).cast("bigint")


def one_text(df: DataFrame, hash_col: str = HASH) -> DataFrame:
    """An identity whose least and greatest second hash differ raises as its ``in_cur`` is read."""
    clash = F.concat(F.lit("two records share the identity "), F.col(hash_col))
    return df.withColumn("in_cur", F.when(F.col("_least") != F.col("_greatest"), F.raise_error(clash).cast("boolean")).otherwise(F.col("in_cur")))


def moved(df: DataFrame) -> DataFrame:
    """``fresh``: appears and wasn't active; ``gone``: was active and isn't there."""
    return df.withColumns({"fresh": F.col("in_cur") & ~F.col("st_active"), "gone": ~F.col("in_cur") & F.col("st_active")})


def identities(
    current: DataFrame,
    stored: DataFrame,
    *,
    natural_key: Sequence[str] = NATURAL_KEY,
    hash_col: str = HASH,
    stored_order: str = "first_seen_at",
    copartitioned: bool = False,
) -> DataFrame:
    """Step 1: one narrow row per identity.

    ``copartitioned`` says that ``stored`` is bucketed by the identity: then the snapshot alone is
    exchanged, and joined to it.

    ``in_cur``, ``stored``, ``st_active`` (missing flag = active, P24), the stored row's
    ``first_seen`` and ``last_seen``, and ``fresh`` / ``gone``. No payload takes part. Where both sides have the
    hashed columns, least and greatest second hash of them are taken along, and an identity
    that stands for two different texts (H17) raises.
    """
    keys = [*natural_key, hash_col]
    second = identity_text(current, stored)

    def stamp(name: str) -> Column:
        return F.col(name).cast("timestamp") if name in stored.columns else F.lit(None).cast("timestamp")

    active = F.coalesce(F.col("is_active"), F.lit(True)) if "is_active" in stored.columns else F.lit(True)
    none = F.lit(None).cast("timestamp")
    cur = current.select(*keys, F.lit(True).alias("in_cur"), F.lit(False).alias("stored"), F.lit(False).alias("st_active"), none.alias("first_seen"), none.alias("last_seen"), second.alias("_text"))
    sto = stored.select(*keys, F.lit(False).alias("in_cur"), F.lit(True).alias("stored"), active.alias("st_active"), stamp(stored_order).alias("first_seen"), stamp("last_seen_at").alias("last_seen"), second.alias("_text"))
    flags = ("in_cur", "stored", "st_active", "first_seen", "last_seen")
    ends = [F.min("_text").alias("_least"), F.max("_text").alias("_greatest")]
    if copartitioned:
        seen = cur.groupBy(*keys).agg(F.lit(True).alias("_seen"), *ends)
        false = F.lit(False)
        one = seen.join(sto.drop("in_cur"), keys, "full_outer").select(
            *keys,
            F.coalesce("_seen", false).alias("in_cur"),
            *[F.coalesce(c, false).alias(c) for c in ("stored", "st_active")],
            *("first_seen", "last_seen"),
            F.least("_least", "_text").alias("_least"),
            F.greatest("_greatest", "_text").alias("_greatest"),
        )
    else:
        one = cur.unionByName(sto).groupBy(*keys).agg(*[F.max(c).alias(c) for c in flags], *ends)
    return moved(one_text(one, hash_col)).select(*keys, *flags, "fresh", "gone")


def key_summary(hash_col: str) -> dict[str, Column]:
    last = F.when(F.col("gone"), F.struct(F.col("first_seen").alias("at"), F.col(hash_col).alias("hash")))
    return {"_has_fresh": F.max("fresh"), "_has_gone": F.max("gone"), "_last": F.max(last)}


def with_action(j: DataFrame, hash_col: str) -> DataFrame:
    action = (
        F.when(F.col("in_cur") & F.col("st_active"), F.lit("unchanged"))
        .when(F.col("fresh") & F.col("_has_gone"), F.lit("changed"))
        .when(F.col("fresh"), F.lit("new"))
        .when(F.col("gone") & F.col("_has_fresh") & (F.col(hash_col) == F.col("_last.hash")), F.lit("superseded"))
        .when(F.col("gone"), F.lit("cancelled"))
    )
    return j.withColumn("action", action).drop("_has_fresh", "_has_gone", "_last")


def _last_vanished(gone: DataFrame, keys: Sequence[str], hash_col: str) -> DataFrame:
    """The last hash of each natural key from which something vanished, settled: in two levels, so that a hot key is one row of a salt."""
    salt = F.pmod(F.xxhash64(hash_col), F.lit(SALTS)).alias("_salt")
    salted = gone.groupBy(*keys, salt).agg(F.max(F.struct(F.col("first_seen").alias("at"), F.col(hash_col).alias("hash"))).alias("_last"))
    return settled(salted.groupBy(*keys).agg(F.max("_last").alias("_last")), "last")


def renewed(fresh: DataFrame, gone: DataFrame, *, natural_key: Sequence[str] = NATURAL_KEY, hash_col: str = HASH) -> DataFrame:
    """Steps 2-3 for those identities only whose action depends on others of their key: ``changed`` and ``superseded`` ones.

    ``fresh`` and ``gone`` hold each identity once, ``gone`` with its ``first_seen``. Any other that appears is new, any other that vanishes is cancelled.
    """
    keys = list(natural_key)
    last = _last_vanished(gone, keys, hash_col)
    came = settled(fresh.select(*keys, hash_col).join(last.select(*keys), keys, "left_semi"), "changed")
    went = last.join(came.select(*keys).distinct(), keys, "left_semi").select(*keys, F.col("_last.hash").alias(hash_col))
    return came.withColumn("action", F.lit("changed")).unionByName(went.withColumn("action", F.lit("superseded")))


def paired(ident: DataFrame, *, natural_key: Sequence[str] = NATURAL_KEY, hash_col: str = HASH) -> DataFrame:
    """Steps 2-3 with the summary in two levels. ``ident`` is read five times, narrow: give a settled table.

    Vanished identities give the last hash per (key, salt), then per key; identities that appear only look whether their
    key is among those. The last hashes are settled, so that their size is known: where nothing vanished, what appeared isn't exchanged.
    So what is aggregated and joined is as much as vanished, and a hot key is one row of either side's summary.
    """
    keys = list(natural_key)
    fresh, gone = ident.where("fresh"), ident.where("gone")
    last = _last_vanished(gone, keys, hash_col)
    renewed = fresh.select(*keys).join(last.select(*keys), keys, "left_semi").distinct().withColumn("_renewed", F.lit(True))
    came = fresh.join(last, keys, "left").withColumn("action", F.when(F.col("_last").isNull(), F.lit("new")).otherwise(F.lit("changed")))
    went = gone.join(last, keys).join(renewed, keys, "left")
    last_one = F.col("_renewed").isNotNull() & (F.col(hash_col) == F.col("_last.hash"))
    went = went.withColumn("action", F.when(last_one, F.lit("superseded")).otherwise(F.lit("cancelled")))
    rest = ident.where(~(F.col("fresh") | F.col("gone")))
    rest = rest.withColumn("action", F.when(F.col("in_cur") & F.col("st_active"), F.lit("unchanged")))
    columns = [*ident.columns, "action"]
    return came.select(*columns).unionByName(went.select(*columns)).unionByName(rest.select(*columns))


def reconcile(
    current: DataFrame,
    stored: DataFrame,
    *,
    natural_key: Sequence[str] = NATURAL_KEY,
    hash_col: str = HASH,
    stored_order: str = "first_seen_at",
    hot_keys: bool = False,
) -> DataFrame:
    """J6-J9 as one frame: ``natural key, hash, action``.

    ``stored`` may hold every ledger row; only active ones (missing flag =
    active, P24) take part in the pairing. Inactive stored rows that do not
    reappear get no action and are left out. By default the summary is a window over the
    de-duplicated identities, and the plan stays lazy; a window group holds the identities of one
    employee-day. ``hot_keys`` settles the identities and uses :func:`paired`.
    """
    keys = [*natural_key, hash_col]
    ident = identities(current, stored, natural_key=natural_key, hash_col=hash_col, stored_order=stored_order)
    if hot_keys:
        c = paired(settled(ident, "identities"), natural_key=natural_key, hash_col=hash_col)
    else:
        w = Window.partitionBy(*natural_key)
        c = with_action(ident.withColumns({n: e.over(w) for n, e in key_summary(hash_col).items()}), hash_col)
    return c.filter(F.col("action").isNotNull()).select(*keys, "action")


def action_counts(classified: DataFrame) -> DataFrame:
    """A4: one row with a BIGINT count per action."""
    return classified.agg(
        *[F.count_if(F.col("action") == a).cast("bigint").alias(a) for a in ACTIONS]
    )


def upserts(classified: DataFrame) -> DataFrame:
    """Rows to write — new + changed."""
    return classified.filter(F.col("action").isin("new", "changed"))


def deactivations(classified: DataFrame) -> DataFrame:
    """Hashes to retire — cancelled + superseded."""
    return classified.filter(F.col("action").isin("cancelled", "superseded"))
