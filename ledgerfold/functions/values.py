"""Small value parsers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.functions.identity import strip

# --- fixed values: spellings the source system reads as "true" --------------
TRUE_WORDS = ("1", "true", "yes", "y", "t")
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_text(*cols) -> Column:
    """P13 for text candidates: ``coalesce(nullif(c1,''), nullif(c2,''), …)``."""
    return F.coalesce(*[F.nullif(_col(c).cast("string"), F.lit("")) for c in cols])


def lenient_date(c) -> Column:
    """First 10 chars as ``yyyy-MM-dd``; empty or bad → null."""
    return F.try_to_date(F.substring(_col(c).cast("string"), 1, 10), "yyyy-MM-dd")


def tri_bool(c) -> Column:
    """H8: null or '' → null; booleans kept; listed words → true; else false."""
    text = F.lower(strip(c))
    return (
        F.when(_col(c).isNull() | (_col(c).cast("string") == ""), F.lit(None).cast("boolean"))
        .otherwise(text.isin(*TRUE_WORDS))
    )


def title_status(c) -> Column:
    """Every run of letters in title case: ``ON_HOLD`` → ``On_Hold``."""
    runs = F.regexp_extract_all(F.lower(_col(c)), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def iso_instant(c) -> Column:
    """Instant rendered as UTC ISO-8601 with milliseconds and ``Z``.

    The wall clock in UTC is counted from the epoch as a zone-less timestamp, so the
    session's zone has no part in it.
    """
    millis = F.unix_millis(_col(c).cast("timestamp"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    wall = F.timestamp_add("SECOND", F.floor(millis / 1000), epoch).cast("string")
    part = F.lpad(F.pmod(millis, F.lit(1000)).cast("string"), 3, "0")
    return F.concat(F.translate(wall, " ", "T"), F.lit("."), part, F.lit("Z"))


def whole_seconds(c) -> Column:
    """Truncate a timestamp to whole seconds."""
    return F.date_trunc("second", _col(c))
