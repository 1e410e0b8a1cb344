"""Stored tables: declared schemas, typed projection, partitioned file tables.

Plain file tables have no MERGE/UPDATE, so a cycle computes the next rows of the
partitions it changes and replaces those by Spark's dynamic partition overwrite.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ledgerfold.session import shared_dir

# --- fixed values: column contracts of the three stored tables --------------
LEDGER_DDL = (
    "record_hash STRING NOT NULL, employee_xref STRING NOT NULL, pto_date DATE NOT NULL, "
    "approval_type_code STRING NOT NULL, hours_requested DECIMAL(6,2) NOT NULL, reason_name STRING, "
    "status STRING, time_start STRING, time_end STRING, all_day BOOLEAN, date_of_request STRING, "
    "source_payload STRING, first_seen_at TIMESTAMP NOT NULL, last_seen_at TIMESTAMP NOT NULL, "
    "is_active BOOLEAN NOT NULL, deleted_at TIMESTAMP, ingest_run_id STRING NOT NULL"
)
EMPLOYEE_DDL = (
    "XRefCode STRING NOT NULL, employee_name STRING, DepartmentXRefCode STRING, ProjectId INT, "
    "TaskId INT, employment_status STRING, UpdatedDateTime TIMESTAMP"
)
DAY_DDL = (
    "XRefCode STRING NOT NULL, Date DATE NOT NULL, Hours DECIMAL(6,2) NOT NULL, ReasonName STRING, "
    "PayAdjShortName STRING, Status STRING NOT NULL, RecordHash STRING NOT NULL, UpdatedDateTime TIMESTAMP"
)
# ---------------------------------------------------------------------------

_TYPES = {
    "STRING": StringType(),
    "DATE": DateType(),
    "DECIMAL(6,2)": DecimalType(6, 2),
    "TIMESTAMP": TimestampType(),
    "BOOLEAN": BooleanType(),
    "INT": IntegerType(),
}


def schema_of(ddl: str) -> StructType:
    """Declared column list → ``StructType`` (no session needed)."""
    fields = []
    for part in ddl.split(", "):
        words = part.split()
        fields.append(StructField(words[0], _TYPES[words[1]], nullable=not part.endswith("NOT NULL")))
    return StructType(fields)


LEDGER_SCHEMA = schema_of(LEDGER_DDL)
EMPLOYEE_SCHEMA = schema_of(EMPLOYEE_DDL)
DAY_SCHEMA = schema_of(DAY_DDL)
#: Requests that a run set aside.
REJECT_SCHEMA = schema_of("employee_key STRING, entry_idx STRING, reject_reason STRING, run_at TIMESTAMP NOT NULL")


def typed(df: DataFrame, schema: StructType, *, fill_missing: bool = True, keep: Iterable[str] = ()) -> DataFrame:
    """Project ``df`` onto ``schema`` — fixed order, declared types, missing → null; columns to ``keep`` follow as they are.

    A value that can't be read as its type becomes null by ``try_cast``; a
    null where the schema allows none is found by :func:`not_null_violations`.
    """
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        elif fill_missing:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"missing column {f.name}")
    return df.select(*cols, *keep)


def not_null_violations(df: DataFrame, schema: StructType) -> Column:
    """Count of rows breaking a declared NOT NULL (file tables do not enforce it)."""
    required = [F.col(f.name).isNull() for f in schema.fields if not f.nullable and f.name in df.columns]
    if not required:
        return F.lit(0).cast("bigint")
    bad = required[0]
    for c in required[1:]:
        bad = bad | c
    return F.count_if(bad).cast("bigint")


def enforced(df: DataFrame, schema: StructType) -> DataFrame:
    """S19 at write: declared names, order and types; a null in a NOT NULL column raises while the rows are written."""
    columns = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"null in NOT NULL column {f.name}")).cast(f.dataType))
        columns.append(c.alias(f.name))
    return df.select(*columns)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A table that does not exist yet reads as empty with its schema."""
    return spark.createDataFrame([], schema)


def lacking_fields(df: DataFrame, schema: StructType) -> list[StructField]:
    """Fields of ``schema`` that ``df`` has under no spelling of their name, in the schema's order."""
    known = [f.name.casefold() for f in df.schema.fields]
    return [f for f in schema.fields if f.name.casefold() not in known]


def add_missing_columns(df: DataFrame, schema: StructType = EMPLOYEE_SCHEMA) -> DataFrame:
    """``df`` with a null column for each field of ``schema`` that it lacks."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking_fields(df, schema)})


def evolve_table(spark: SparkSession, table: str, schema: StructType = None) -> list[str]:
    """S18 for a catalog table: add the fields of ``schema`` that it lacks, in one statement; returns their names."""
    schema = EMPLOYEE_SCHEMA if schema is None else schema
    lacking = lacking_fields(spark.table(table), schema)
    if lacking:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lacking)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return [f.name for f in lacking]


def create_table_sql(
    table: str, ddl: str, fmt: str = "parquet", partition_by: str | None = None, location: str | None = None
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a catalog table (optionally at ``location``)."""
    clean = re.sub(r"\s+NOT NULL", "", ddl) if fmt == "parquet" else ddl
    part = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({clean}) USING {fmt}{part}{loc}"


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` computed once into a folder of its own in the shared folder, and read back from there.

    Plans that use it more than once read files instead of computing it again, and lost executors cost nothing.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def month_part(column: str) -> str:
    """Partition text of a date column: its month."""
    return f"date_format({column}, 'yyyy-MM')"


def key_part(column: str, n: int = 16) -> str:
    """Partition text of a key column: one of ``n`` hash buckets."""
    return f"cast(pmod(xxhash64({column}), {n}) AS string)"


class StoredTable:
    """Parquet files in one folder, partitioned by ``part`` (SQL text over the table's columns).

    A write replaces the partitions it has rows for and no other
    (``partitionOverwriteMode=dynamic``). Spark writes them aside and moves them in
    when the job commits, so the rows may come from a plan that reads this table,
    and a job lost before that leaves the table as it was. One lost while files are moved
    is run again: the merges give the same rows for the same stamp.
    """

    #: ``merge_action`` values that leave a stored row as it is.
    UNCHANGED = ("keep", "noop", "unchanged")

    def __init__(self, spark: SparkSession, path: str, schema: StructType, part: str):
        self.spark, self.path, self.schema, self.part = spark, path.rstrip("/"), schema, part
        self._create()

    def _create(self) -> None:
        """The folder, if there is none yet."""
        rows = empty(self.spark, self.schema).withColumn("part", F.lit("none"))
        rows.write.mode("ignore").partitionBy("part").parquet(self.path)

    def part_column(self) -> Column:
        return F.coalesce(F.expr(self.part), F.lit("none"))

    def with_parts(self) -> DataFrame:
        """All rows with their ``part``; a filter on it is a partition filter of the scan."""
        return self.spark.read.schema(StructType([*self.schema.fields, StructField("part", StringType())])).parquet(self.path)

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The table's rows, or those of some partitions; empty where nothing was written yet."""
        rows = self.with_parts()
        rows = rows if parts is None else rows.where(F.col("part").isin(list(parts)))
        return rows.select(*self.schema.fieldNames())

    def changed_parts(self, merged: DataFrame) -> list[str]:
        """Partitions that hold a row changed by a merge; as many as the table has partitions at most."""
        moved = merged.where(~F.col("merge_action").isin(*self.UNCHANGED))
        return sorted(r["part"] for r in moved.select(self.part_column().alias("part")).distinct().collect())

    def overwrite(self, rows: DataFrame) -> None:
        """Replace the partitions of ``rows``, which are whole partitions, by them.

        Types are the declared ones; a null where the schema allows none fails the write.
        AQE cuts or joins the written partitions to its advisory size (``REBALANCE``).
        """
        out = enforced(rows, self.schema).withColumn("part", self.part_column()).hint("rebalance", "part")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("part").parquet(self.path)


class BucketedTable(StoredTable):
    """A stored table known to the catalog, its files bucketed by ``keys``.

    A side that is dealt out by the same keys into as many parts meets it without an exchange (or a sort of
    whole partitions) of the stored rows. ``buckets`` should be the session's ``spark.sql.shuffle.partitions``.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, schema: StructType, part: str, keys: Iterable[str], buckets: int):
        self.name, self.keys, self.buckets = name, tuple(keys), buckets
        super().__init__(spark, path, schema, part)

    def _create(self) -> None:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, part STRING) USING parquet OPTIONS (compression 'zstd', 'mapreduce.fileoutputcommitter.algorithm.version' '2') PARTITIONED BY (part) "
            f"CLUSTERED BY ({', '.join(self.keys)}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def with_parts(self) -> DataFrame:
        return self.spark.table(self.name)

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, *self.keys)

    @contextmanager
    def _settings(self, values: dict[str, str]) -> Iterator[None]:
        """Session settings for one write."""
        before = {name: self.spark.conf.get(name) for name in values}
        try:
            for name, value in values.items():
                self.spark.conf.set(name, value)
            yield
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value)

    def aside(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows``, which lie in this table's buckets, settled in a bucketed table of their own beside it."""
        own = f"{self.name}_{name}_{uuid.uuid4().hex[:12]}"
        at = f"{shared_dir(self.spark)}/{own}"
        # a task has one bucket, so it needs one file open and no order; wide merges generate methods that the JVM doesn't compile beyond 8000 bytes
        with self._settings({"spark.sql.maxConcurrentOutputFileWriters": "1", "spark.sql.codegen.hugeMethodLimit": "8000"}):
            rows.write.bucketBy(self.buckets, *self.keys).option("path", at).option("compression", "zstd").format("parquet").saveAsTable(own)
        return self.spark.table(own)

    def overwrite(self, rows: DataFrame, dealt: bool = False) -> None:
        """As :meth:`StoredTable.overwrite`; a task writes one bucket of every partition. ``dealt``: the rows lie in the buckets already."""
        out = enforced(rows, self.schema).withColumn("part", self.part_column())
        out = out if dealt else self.dealt(out)
        # insertInto has no option for it
        with self._settings({"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            out.write.insertInto(self.name, overwrite=True)
