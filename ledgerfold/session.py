"""Session helpers: build a session for tests/bench and find the shared work folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerfold") -> SparkSession:
    """Session used by tests and the bench. Jobs on a cluster receive theirs."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # joins whose partitions turn out small need no sort
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    The cluster names it. Where it is unset, only a master whose tasks run in
    this one process gets a temporary folder; elsewhere executors would write
    to their own disks, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="ledgerfold-")
        spark.sparkContext.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")
