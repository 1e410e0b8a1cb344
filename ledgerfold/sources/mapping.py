"""Department → (project, task) dimension.

The map is a configuration dimension. It is validated with one aggregate;
lookups are left joins on the normalised key (strip + upper).
A later entry (greater ``ordinal``) for the same normalised key wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.identity import norm_token
from ledgerfold.operators.dedupe import last_wins


def validation(rows: DataFrame) -> DataFrame:
    """S13 report: entries, distinct normalised keys, entries lacking an id."""
    key = norm_token(F.col("department"))
    return rows.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_entries"),
        F.count_distinct(key).cast("bigint").alias("n_keys"),
        F.count_if(F.col("project_id").isNull()).cast("bigint").alias("n_missing_project"),
        F.count_if(F.col("task_id").isNull()).cast("bigint").alias("n_missing_task"),
        F.count_if(key.isNull()).cast("bigint").alias("n_blank_keys"),
    ).withColumn(
        "valid",
        (F.col("n_entries") > 0) & (F.col("n_missing_project") == 0) & (F.col("n_missing_task") == 0),
    )


def load(rows: DataFrame, *, strict: bool = True) -> DataFrame:
    """Validated map ``(dept_key, department, project_id, task_id)``.

    ``strict`` raises on an empty map or any entry lacking an id (as the
    source system did); otherwise such entries are left out.
    """
    if strict:
        rep = validation(rows).first()
        if not rep["valid"]:
            raise ValueError(
                f"department map invalid: entries={rep['n_entries']} missing project={rep['n_missing_project']} "
                f"missing task={rep['n_missing_task']}"
            )
    ok = rows.filter(F.col("project_id").isNotNull() & F.col("task_id").isNotNull())
    keyed = ok.withColumn("dept_key", norm_token(F.col("department"))).filter(F.col("dept_key").isNotNull())
    order = ["ordinal"] if "ordinal" in keyed.columns else ["department"]
    out = last_wins(keyed.select("dept_key", "department", "project_id", "task_id", *order), ["dept_key"], order)
    return out.select("dept_key", "department", "project_id", "task_id")


def resolve(df: DataFrame, dept_col: str, dept_map: DataFrame, *, how: str = "left") -> DataFrame:
    """Add ``project_id``/``task_id`` for ``dept_col`` (null key → no match).

    How the map is joined is the optimizer's choice, by its measured size.
    """
    m = dept_map.select("dept_key", "project_id", "task_id")
    keyed = df.withColumn("_dept_key", norm_token(F.col(dept_col)))
    return keyed.join(m, keyed["_dept_key"] == m["dept_key"], how).drop("_dept_key", "dept_key")


def keep_in_scope(df: DataFrame, dept_col: str, dept_map: DataFrame) -> DataFrame:
    """P22 membership: rows whose department is mapped (semi-join)."""
    m = dept_map.select("dept_key")
    keyed = df.withColumn("_dept_key", norm_token(F.col(dept_col)))
    return keyed.join(m, keyed["_dept_key"] == m["dept_key"], "left_semi").drop("_dept_key")


def departments(dept_map: DataFrame) -> DataFrame:
    """The in-scope department keys."""
    return dept_map.select("dept_key").distinct()


def project_ids(dept_map: DataFrame) -> DataFrame:
    """Distinct project ids."""
    return dept_map.select("project_id").distinct()


def size(dept_map: DataFrame) -> DataFrame:
    """Number of mapped departments."""
    return dept_map.agg(F.count(F.lit(1)).cast("bigint").alias("n_departments"))
