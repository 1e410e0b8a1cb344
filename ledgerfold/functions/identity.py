"""Deterministic day-record identity.

The identity of a day record is a truncated SHA-256 over four normalised fields
joined by a separator. These are column expressions, so the hash is computed
inside whole-stage codegen next to the scan, never in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: must equal the source system's identity spec ------------
HASH_SPEC_VERSION = 2
FIELD_SEPARATOR = "|"
HASH_LENGTH = 16
HOURS_TYPE = "decimal(6,2)"
# ---------------------------------------------------------------------------

# Wide enough to hold any parsed hours value before rounding.
_PARSE_TYPE = "decimal(38,18)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Text without leading and trailing whitespace of any kind.

    ``(?U)`` makes the classes Unicode-aware (no-break space, em space, …), as
    ``F.trim`` is not.
    """
    return F.regexp_replace(_col(c).cast("string"), r"(?U)^\s+|\s+$", "")


def norm_token(c) -> Column:
    """Strip every leading/trailing whitespace char, upper-case.

    An empty result becomes null, which downstream validity checks treat as
    an invalid record (the source raised an error there).
    """
    s = F.upper(strip(c))
    return F.when(s != "", s)


def norm_date(c) -> Column:
    """H2/H9: calendar date of a date, timestamp or ISO text (first 10 chars, or 8 of the compact form).

    Dates and timestamps are first rendered as text so that a wall-clock
    timestamp keeps its written calendar day (no zone shift). Unparsable → null.
    """
    text = strip(c)
    compact = F.when(text.rlike(r"^\d{8}($|T\d)"), F.try_to_date(F.substring(text, 1, 8), "yyyyMMdd"))
    return F.coalesce(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"), compact)


def norm_hours(c) -> Column:
    """H4: hours rounded half-even to 2 decimals as ``DECIMAL(6,2)``.

    Numbers and numeric text are parsed into a wide decimal (a double goes
    through its shortest decimal text, as the source system did), rounded
    with ``bround`` (half-even; a plain cast would round half-up), then
    narrowed with ``try_cast``. Negative, unparsable or too-large values → null.
    """
    as_dec = _try_cast(_col(c), _PARSE_TYPE)
    rounded = F.bround(as_dec, 2)
    narrowed = _try_cast(rounded, HOURS_TYPE)
    return F.when(narrowed >= 0, narrowed)


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def norm_hours_text(c) -> Column:
    """Hours as the fixed two-decimal text used inside the canonical string."""
    return norm_hours(c).cast("string")


def canonical_string(key, day, type_code, hours) -> Column:
    """H5: ``KEY|yyyy-MM-dd|TYPE|h.hh`` or null when any part is invalid.

    ``concat_ws`` silently skips nulls, so validity is checked first.
    """
    k, d, t, h = norm_token(key), norm_date(day), norm_token(type_code), norm_hours(hours)
    ok = k.isNotNull() & d.isNotNull() & t.isNotNull() & h.isNotNull()
    return F.when(
        ok,
        F.concat_ws(FIELD_SEPARATOR, k, F.date_format(d, "yyyy-MM-dd"), t, h.cast("string")),
    )


def record_hash(key, day, type_code, hours) -> Column:
    """H6: first 16 hex chars of SHA-256 over the canonical string."""
    return hash_of_canonical(canonical_string(key, day, type_code, hours))


def record_hash_normalized(key, day, type_code, hours) -> Column:
    """H6 over fields that are already normalised (string, date, string, decimal(6,2)).

    Same result as :func:`record_hash` on such inputs, without re-parsing them.
    """
    k, d, t, h = _col(key), _col(day), _col(type_code), _col(hours)
    ok = k.isNotNull() & d.isNotNull() & t.isNotNull() & h.isNotNull()
    canon = F.concat_ws(FIELD_SEPARATOR, k, d.cast("string"), t, h.cast(HOURS_TYPE).cast("string"))
    return hash_of_canonical(F.when(ok, canon))


def hash_of_canonical(canon: Column) -> Column:
    return F.substring(F.sha2(canon, 256), 1, HASH_LENGTH)


def migrate_v1_hash(c) -> Column:
    """H7: a v1 (full 64-hex) digest becomes its v2 prefix; v2 values stay."""
    return F.substring(_col(c), 1, HASH_LENGTH)
