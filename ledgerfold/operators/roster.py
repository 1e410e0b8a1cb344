"""Roster narrowing and enrichment.

Inputs are landed pages/payloads (``VARIANT`` or typed structs). All steps
are projections, semi/left joins against the broadcast mapping dimension and
keyed collapses; the detail of every employee is handled in one plan instead
of one request per employee.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StructType

from ledgerfold.functions import items as it
from ledgerfold.functions.identity import norm_token, strip
from ledgerfold.operators.dedupe import first_wins, last_wins
from ledgerfold.operators.partitioning import with_materialized
from ledgerfold.sources import mapping

# --- fixed values: column order preferred by the roster frame ---------------
PREFERRED_ORDER = (
    "XRefCode",
    "EmployeeNumber",
    "FirstName",
    "LastName",
    "DisplayName",
    "HireDate",
    "TerminationDate",
    "Status",
)
# ---------------------------------------------------------------------------
ACTIVE = "ACTIVE"
#: Columns that tell which of several details of one employee landed last.
LANDING_ORDER = ("landed_at", "page_id", "page_idx", "row_idx")


def keep_prefix(df: DataFrame, prefix: str, key: str = "XRefCode") -> DataFrame:
    """Keep rows whose trimmed, upper-cased key starts with ``prefix``; no key → dropped."""
    k = F.upper(strip(F.col(key)))
    return df.filter(k.startswith(prefix.upper()))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs → dotted top-level columns; arrays stay whole."""

    def walk(schema: StructType, prefix: list[str]) -> list[Column]:
        out = []
        for f in schema.fields:
            path = [*prefix, f.name]
            if isinstance(f.dataType, StructType):
                out.extend(walk(f.dataType, path))
            else:
                ref = F.col(path[0])
                for p in path[1:]:
                    ref = ref.getField(p)
                out.append(ref.alias(sep.join(path)))
        return out

    return df.select(*walk(df.schema, []))


def order_columns(df: DataFrame, preferred: Sequence[str] = PREFERRED_ORDER) -> DataFrame:
    """Preferred columns first (those present), the rest sorted by name."""
    rank = {name: i for i, name in enumerate(preferred)}
    ordered = sorted(df.columns, key=lambda name: (rank.get(name, len(rank)), name))
    return df.select(*[F.col(f"`{name}`") for name in ordered])


def roster_frame(rows: DataFrame, prefix: str, order: Sequence[str] = ("page_idx", "row_idx")) -> DataFrame:
    """S24 = P1 + A2 + P2 + P3 (+ P4: an empty input keeps the declared columns)."""
    scoped = keep_prefix(rows, prefix)
    first = first_wins(scoped, ["XRefCode"], order).drop(*order)
    return order_columns(flatten(first))


def _type_text(t: DataType) -> str:
    """DDL of a type with quoted names; a field that is always null reads as text."""
    if isinstance(t, StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{_type_text(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, ArrayType):
        return f"array<{_type_text(t.elementType)}>"
    return "string" if isinstance(t, NullType) else t.simpleString()


def _object_type(text: str) -> StructType:
    """The aggregate's type text as a Spark type; quoted names are left as they are."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    return DataType.fromDDL("".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in parts))


def _typed_object(row: Column, path: str, t: StructType) -> list[tuple[str, Column]]:
    """(name, column) per field of an object; names that differ only in case become one column, first value found."""
    found: dict[str, tuple[str, list[tuple[Column, str]]]] = {}
    for f in t.fields:
        quoted = f.name.replace("\\", "\\\\").replace("'", "\\'")
        at = f"{path}['{quoted}']"
        if isinstance(f.dataType, StructType) and f.dataType.fields:
            inner = F.struct(*[c.alias(n) for n, c in _typed_object(row, at, f.dataType)])
            value, kind = F.when(it.is_object(it.vget(row, at, "variant")), inner), "struct"
        else:
            kind = _type_text(f.dataType)
            value = F.try_variant_get(row, at, kind)
        found.setdefault(f.name.lower(), (f.name, []))[1].append((value, kind))
    out = []
    for name, values in found.values():
        kinds = {k for _, k in values}
        same = [v for v, _ in values] if len(kinds) == 1 and kinds != {"struct"} or len(values) == 1 else [F.to_json(v) if k == "struct" else v.cast("string") for v, k in values]
        out.append((name, F.coalesce(*same)))
    return out


def rows_to_struct(rows: DataFrame, col: str = "row") -> DataFrame:
    """P2 input for landed rows: VARIANT objects → top-level typed columns.

    The merged schema of all rows comes from one ``schema_of_variant_agg``
    aggregate (the driver receives only the schema text); every field is then
    read by its own path. Fields that are null in all rows are text. Spark resolves
    names without case, so keys that differ only in case share one column, in
    which the first one present wins.
    """
    schema = rows.agg(F.schema_of_variant_agg(F.col(col))).first()[0]
    others = [c for c in rows.columns if c != col]
    if not schema or not schema.startswith("OBJECT<"):
        return rows.select(*others)
    fields = _typed_object(F.col(col), "$", _object_type(schema))
    taken = {c.lower() for c in others}
    return rows.select(*others, *[c.alias(n) for n, c in fields if n.lower() not in taken])


def roster_frame_from_pages(rows: DataFrame, prefix: str, order: Sequence[str] = ("page_id", "row_idx")) -> DataFrame:
    """S24 over landed list pages: prefix filter on the raw key first (as the
    source system did), then the struct is inferred from the kept rows only."""
    k = F.upper(strip(it.vget(F.col("row"), "$.XRefCode")))
    scoped = rows.filter(k.startswith(prefix.upper())).select(*order, "row")
    return roster_frame(rows_to_struct(scoped), prefix, order)


def employee_keys(rows: DataFrame, key: str = "XRefCode") -> DataFrame:
    """Keys of the list pages as text, empty/missing dropped (repeats kept)."""
    k = F.col(key).cast("string")
    return rows.filter(k.isNotNull() & (k != "")).select(k.alias("XRefCode"), *[c for c in rows.columns if c != key])


# --------------------------------------------------------------------------- #
# Detail payload pickers (one projection for all employees)                   #
# --------------------------------------------------------------------------- #
def display_name(v: Column) -> Column:
    """P5."""
    return it.vget(v, "$.DisplayName")


def employment_status(v: Column) -> Column:
    """Status code of the item with the latest ``EffectiveStart`` text (wrapped form only)."""
    items = it.wrapped_items(it.vget(v, "$.EmploymentStatuses", "variant"))
    pick = it.latest_by_text(items, "$.EffectiveStart")
    return it.vget(pick, "$.EmploymentStatus.XRefCode")


def primary_department(v: Column) -> Column:
    """``Position.Department.XRefCode`` of the primary (else first) wrapped assignment."""
    items = it.wrapped_items(it.vget(v, "$.WorkAssignments", "variant"))
    return it.vget(it.first_or_primary(items), "$.Position.Department.XRefCode")


# --- fixed values: where a department code may live, most specific first ----
DEPARTMENT_PATHS = (
    ("WorkAssignments", "$.Department.XRefCode"),
    ("WorkAssignments", "$.DepartmentXRefCode"),
    ("WorkAssignments", "$.Position.Department.XRefCode"),
    ("EmploymentStatuses", "$.Department.XRefCode"),
    ("EmploymentStatuses", "$.OrgUnitXRefCode"),
    (None, "$.HomeOrganization.XRefCode"),
    (None, "$.DepartmentXRefCode"),
)
# ---------------------------------------------------------------------------


def with_department_as_of(df: DataFrame, as_of: Column, out: str = "department_xref", detail: str = "detail") -> DataFrame:
    """P8 + P9 + P10: first non-empty code over the ordered paths, trimmed and upper-cased.

    Collection paths read the item effective on ``as_of`` from either
    wrapping of the collection. The collections and their picks are projected
    once as columns, then the seven paths read from them.
    """
    v = F.col(detail)
    for coll in ("WorkAssignments", "EmploymentStatuses"):
        df = df.withColumn(f"_{coll}", it.as_items(it.vget(v, f"$.{coll}", "variant")))
        df = it.with_effective_item(df, f"_{coll}", as_of, f"_{coll}_pick")
    cands = []
    for coll, path in DEPARTMENT_PATHS:
        src = v if coll is None else F.col(f"_{coll}_pick")
        cands.append(it.text(src, path))
    df = df.withColumn(out, F.upper(strip(F.coalesce(*cands))))
    return df.drop(*[f"_{c}{sfx}" for c in ("WorkAssignments", "EmploymentStatuses") for sfx in ("", "_pick")])


def parse_details(details: DataFrame, payload: str = "payload") -> DataFrame:
    """Landed detail text → ``detail`` VARIANT (``Data`` object if present, else the payload; unreadable text → null)."""
    staged = with_materialized(details, {"_v": F.try_parse_json(F.col(payload))})
    v, data = F.col("_v"), it.vget(F.col("_v"), "$.Data", "variant")
    return with_materialized(staged, {"detail": F.when(it.is_object(data), data).otherwise(v)}).drop("_v")


def employee_projection(details: DataFrame, key: str = "XRefCode", keep: Sequence[str] = ()) -> DataFrame:
    """P23 for every employee: key, name, department (P7), status."""
    d = F.col("detail")
    return details.select(
        *keep,
        F.coalesce(it.vget(d, "$.XRefCode"), F.col(key)).alias("XRefCode"),
        display_name(d).alias("DisplayName"),
        primary_department(d).alias("DepartmentXRefCode"),
        employment_status(d).alias("EmploymentStatus"),
    )


def employee_rows(keys: DataFrame, details: DataFrame, dept_map: DataFrame) -> DataFrame:
    """Per roster key, name/department/project/task/status; unresolved project dropped.

    ``keys`` (column ``XRefCode`` as given, possibly repeated) is collapsed
    first; the detail is matched on the normalised key.
    """
    k = keys.select("XRefCode").distinct().withColumn("_k", norm_token(F.col("XRefCode")))
    # one detail per normalised key: the last landed, then the greatest values, so that no key gets two rows
    landed = [c for c in LANDING_ORDER if c in details.columns]
    proj = employee_projection(details, keep=landed).withColumn("_k", norm_token(F.col("XRefCode"))).drop("XRefCode")
    shown = ["DisplayName", "DepartmentXRefCode", "EmploymentStatus"]
    one = last_wins(proj.select("_k", *shown, *landed), ["_k"], [*landed, *shown]).select("_k", *shown)
    j = k.join(one, "_k", "left").drop("_k")
    enriched = mapping.resolve(j, "DepartmentXRefCode", dept_map, how="inner")
    return enriched.select(
        "XRefCode",
        F.col("DisplayName").alias("employee_name"),
        "DepartmentXRefCode",
        F.col("project_id").alias("ProjectId"),
        F.col("task_id").alias("TaskId"),
        F.col("EmploymentStatus").alias("employment_status"),
    )


def active_keys(employees: DataFrame) -> DataFrame:
    """P20: keys of ACTIVE employees (null status is not active)."""
    return employees.filter(F.col("employment_status") == ACTIVE).select("XRefCode")


def inactive_status_counts(employees: DataFrame) -> DataFrame:
    """How many employees per non-ACTIVE status, the null group included."""
    return (
        employees.filter(~F.col("employment_status").eqNullSafe(F.lit(ACTIVE)))
        .groupBy("employment_status")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    )


def in_scope_roster(
    keys: DataFrame,
    details: DataFrame,
    dept_map: DataFrame,
    as_of: Column,
    *,
    subset: DataFrame | None = None,
    order: Sequence[str] = ("page_idx", "row_idx"),
) -> DataFrame:
    """C4 = J5 + P8 + J3 + J4: in-scope employees with the department effective ``as_of``.

    Output as :func:`checked_keys`; J4 collapses repeated keys, last wins (ties
    by the greatest values, so the choice doesn't depend on arrival).
    """
    checked = checked_keys(keys, details, dept_map, as_of, subset=subset, order=order)
    keep_order = [c for c in order if c in checked.columns]
    values = ["department_xref", "project_id", "task_id", "outcome"]
    return last_wins(checked, ["xref"], [*keep_order, *values]).drop(*keep_order)


def checked_keys(
    keys: DataFrame,
    details: DataFrame,
    dept_map: DataFrame,
    as_of: Column,
    *,
    subset: DataFrame | None = None,
    order: Sequence[str] = ("page_idx", "row_idx"),
) -> DataFrame:
    """J5 + P8 + J3, one row for every key that is checked, repeats included.

    ``xref, department_xref, project_id, task_id, outcome``, where outcome is
    ``kept``, ``unmapped`` (department not in the map, a blank one too) or
    ``unresolved`` (no department found).
    """
    if subset is not None:
        keys = keys.join(subset.select("XRefCode").distinct(), "XRefCode", "left_semi")
    landed = [c for c in LANDING_ORDER if c in details.columns]
    d = with_department_as_of(details, as_of).select(norm_token(F.col("XRefCode")).alias("_k"), "department_xref", *landed)
    d = last_wins(d, ["_k"], [*landed, "department_xref"]).select("_k", "department_xref")
    k = keys.withColumn("_k", norm_token(F.col("XRefCode")))
    j = k.join(d, "_k", "left").drop("_k")
    r = mapping.resolve(j, "department_xref", dept_map, how="left")
    outcome = (
        F.when(F.col("department_xref").isNull(), F.lit("unresolved"))
        .when(F.col("project_id").isNull(), F.lit("unmapped"))
        .otherwise(F.lit("kept"))
    )
    r = r.withColumn("outcome", outcome)
    keep_order = [c for c in order if c in r.columns]
    return r.select(F.col("XRefCode").alias("xref"), "department_xref", "project_id", "task_id", "outcome", *keep_order)


def scope_counts(roster: DataFrame) -> DataFrame:
    """A5: kept / unmapped / unresolved counts over every key checked (:func:`checked_keys`)."""
    o = F.col("outcome")
    return roster.agg(
        F.count_if(o == "kept").cast("bigint").alias("kept"),
        F.count_if(o == "unmapped").cast("bigint").alias("unmapped"),
        F.count_if(o == "unresolved").cast("bigint").alias("unresolved"),
    )


__all__ = [
    "ACTIVE",
    "active_keys",
    "with_department_as_of",
    "display_name",
    "employee_keys",
    "employee_projection",
    "employee_rows",
    "employment_status",
    "flatten",
    "in_scope_roster",
    "inactive_status_counts",
    "keep_prefix",
    "order_columns",
    "parse_details",
    "primary_department",
    "roster_frame",
    "roster_frame_from_pages",
    "rows_to_struct",
    "scope_counts",
]
