"""Incremental ledger runs over a landing folder (Structured Streaming).

The source system is polled on a schedule and each poll lands one snapshot of
request pages as any number of files of JSON lines
(``{"snapshot_id":…, "employee_key":…, "page_id":…, "url":…, "page":{…}}``), and last of
all a completion line ``{"snapshot_id":…, "pages":n}``. A file stream with
``trigger(availableNow=True)`` picks up the files not yet processed. A micro-batch
keeps its lines and a narrow list of its page ids in the work folder, by
snapshot; whether a snapshot is whole is read from the narrow lists of the snapshots the batch names,
and its lines are read once, when it is applied. A snapshot is applied as
a ledger cycle once its completion line is there and as many readable pages as
it names; until then nothing of it is used, because anything missing from a
cycle is retired. How files fall into micro-batches has no influence.

Snapshots are applied in the order of their ids. One that becomes whole after a later one was applied
is noted as ``late`` and never applied: it would retire what the later one brought. Of two different pages with
one id, the one of the later micro-batch counts, in one batch that with the greater text. If the driver dies after the
table is written but before the snapshot is noted as applied, it is applied
again; that only refreshes ``last_seen_at``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions import items as it
from ledgerfold.plans.cycle import LedgerCycle, run_ledger_cycle
from ledgerfold.sources.requests import entries_from_pages
from ledgerfold.sources.tables import StoredTable

LANDED = "snapshot_id string, value string, batch long, snapshot string"
LISTED = "page_id long, pages long, batch long, snapshot string"
NOTED = "snapshot_id string, outcome string"


def landed_lines(spark: SparkSession, landing_path: str) -> DataFrame:
    """Streaming frame of landed lines with the snapshot they belong to (null where unreadable)."""
    raw = spark.readStream.format("text").load(landing_path)
    return raw.select(it.vget(F.try_parse_json(F.col("value")), "$.snapshot_id").alias("snapshot_id"), "value")


def snapshot_pages(lines: DataFrame) -> DataFrame:
    """Landed lines → ``snapshot_id, pages, employee_key, page_id, url, page``; completion lines have ``pages``."""
    v = F.try_parse_json(F.col("value"))
    return lines.select(
        "snapshot_id",
        it.vget(v, "$.pages", "long").alias("pages"),
        it.vget(v, "$.employee_key").alias("employee_key"),
        it.vget(v, "$.page_id", "long").alias("page_id"),
        it.vget(v, "$.url").alias("url"),
        it.vget(v, "$.page", "variant").alias("page"),
    )


def complete_snapshots(listed: DataFrame) -> DataFrame:
    """Snapshots whose completion line names exactly the pages that landed, from the narrow lists."""
    counts = listed.groupBy("snapshot").agg(F.max("pages").alias("want"), F.count_distinct("page_id").alias("got"))
    return counts.where("want = got").select(F.col("snapshot").alias("snapshot_id"))


def chosen_lines(lines: DataFrame) -> DataFrame:
    """One line of each page id of a snapshot: the last by batch, then by text. Completion lines are left out."""
    v = F.try_parse_json(F.col("value"))
    keyed = lines.withColumns({"page_id": it.vget(v, "$.page_id", "long"), "pages": it.vget(v, "$.pages", "long")}).where("pages IS NULL")
    last = keyed.groupBy("snapshot_id", "page_id").agg(F.max(F.struct("batch", "value")).alias("last"))
    return last.select("snapshot_id", F.col("last.value").alias("value"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _note(spark: SparkSession, work: str, snapshot: str, outcome: str) -> None:
    spark.createDataFrame([(snapshot, outcome)], NOTED).write.mode("append").parquet(f"{work}/applied")


def apply_landed(table: StoredTable, batch: DataFrame, epoch_id: int, *, work: str, run_prefix: str, expand_multi_day: bool, strict: bool):
    """``foreachBatch`` body: keep the batch's lines, then one ledger cycle per snapshot that is now whole."""
    spark = batch.sparkSession
    own = f"batch={epoch_id}"  # a repeated batch replaces itself
    by_snapshot = batch.withColumn("snapshot", F.coalesce("snapshot_id", F.lit("")))
    by_snapshot.write.mode("overwrite").partitionBy("snapshot").parquet(f"{work}/landed/{own}")
    lines = _read(spark, f"{work}/landed", LANDED)
    new = snapshot_pages(lines.where(F.col("batch") == epoch_id)).where("snapshot_id IS NOT NULL AND (pages IS NOT NULL OR page IS NOT NULL)")
    narrow = new.select(F.when(F.col("page").isNotNull(), F.col("page_id")).alias("page_id"), "pages", F.col("snapshot_id").alias("snapshot"))
    narrow.write.mode("overwrite").partitionBy("snapshot").parquet(f"{work}/pages/{own}")
    listed = _read(spark, f"{work}/pages", LISTED)
    named = [r["snapshot"] for r in listed.where(F.col("batch") == epoch_id).select("snapshot").distinct().collect()]  # snapshots of this batch
    noted = _read(spark, f"{work}/applied", NOTED)
    ready = complete_snapshots(listed.where(F.col("snapshot").isin(named))).join(noted, "snapshot_id", "left_anti")
    for row in ready.orderBy("snapshot_id").collect():  # ids of new snapshots
        snapshot = row["snapshot_id"]
        newest = _read(spark, f"{work}/applied", NOTED).where("outcome = 'applied'").agg(F.max("snapshot_id")).first()[0]
        if newest is not None and snapshot < newest:
            _note(spark, work, snapshot, "late")
            continue
        now = dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None).isoformat(sep=" ")
        cfg = LedgerCycle(now=now, run_id=f"{run_prefix}-{snapshot}", expand_multi_day=expand_multi_day)
        pages = snapshot_pages(chosen_lines(lines.where(F.col("snapshot") == snapshot)))
        run_ledger_cycle(table, entries_from_pages(pages), cfg, pages=pages, strict=strict)
        _note(spark, work, snapshot, "applied")


def run_available(
    spark: SparkSession,
    landing_path: str,
    table: StoredTable,
    checkpoint: str,
    *,
    run_prefix: str = "stream",
    expand_multi_day: bool = False,
    strict: bool = True,
):
    """Process everything landed since the last run, then stop (``availableNow``).

    ``strict`` ends the run on a refused page or one whose next page is missing; otherwise the employees
    concerned keep their stored rows (see :func:`run_ledger_cycle`).
    """
    q = (
        landed_lines(spark, landing_path)
        .writeStream.foreachBatch(
            lambda df, eid: apply_landed(
                table, df, eid, work=f"{checkpoint}-work", run_prefix=run_prefix, expand_multi_day=expand_multi_day, strict=strict
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
