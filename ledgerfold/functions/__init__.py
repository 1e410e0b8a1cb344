"""Column expressions. Every function takes and returns ``pyspark.sql.Column``."""

from ledgerfold.functions.identity import (  # noqa: F401
    FIELD_SEPARATOR,
    HASH_LENGTH,
    HASH_SPEC_VERSION,
    canonical_string,
    migrate_v1_hash,
    norm_date,
    norm_hours,
    norm_hours_text,
    norm_token,
    record_hash,
    record_hash_normalized,
)
from ledgerfold.functions.values import (  # noqa: F401
    first_text,
    iso_instant,
    lenient_date,
    title_status,
    tri_bool,
    whole_seconds,
)
