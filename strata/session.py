"""Session construction and the shared folder used to materialise layers."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# "Today" for every rule that reads GETDATE() in the source SQL.  Results must
# not depend on the wall clock, so it is a parameter with this default.
DEFAULT_AS_OF = "2026-01-01"


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for the CLI, tests, bench and local runs.

    A session that exists already is taken as it is.  Otherwise what the
    launcher set (spark-submit options, spark-defaults, PYSPARK_SUBMIT_ARGS)
    wins: the defaults below only fill in keys that nobody set, and the
    master is local only if none is given.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    SparkContext._ensure_initialized()  # starts the JVM with the launcher's options
    given = SparkConf()
    builder = SparkSession.builder
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = given.get("spark.master", None)
    if chosen in (None, "local[*]"):  # what spark-submit fills in if nobody chose one
        chosen = master or f"local[{cpus}]"
    builder = builder.master(chosen)
    defaults = {
        "spark.app.name": app,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    if chosen.startswith("local"):  # a cluster's partition count is the launcher's business
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    log_dir = os.environ.get("STRATA_EVENT_LOG_DIR")
    if log_dir:  # stage/task timings for tools/stage_report.py
        defaults |= {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    for key, value in defaults.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OURS = "strata.initialPartitionNum"  # marks a number that was set here
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with: the session's, or more where the
    input asked for it (``enough_partitions``)."""
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(own, int(spark.conf.get(_INITIAL, None) or 0))


def enough_partitions(spark: SparkSession, rows: int, most: int) -> None:
    """Shuffles begin with partitions of about ``most`` of ``rows`` rows at
    most, so that a task's sort or hash table does not grow with the input and
    spill; adaptive execution joins what turns out small.  A session that has
    set its own number, or more partitions, is left as it is."""
    if spark.conf.get(_INITIAL, None) is None or spark.conf.get(_OURS, None) == "true":
        need = -(-rows // most)
        if need > partitions(spark):
            spark.conf.set(_OURS, "true")
            spark.conf.set(_INITIAL, str(need))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and materialised layers.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  If neither is set, a local master gets a private folder
    (tests, bench); any other master is an error, as its executors would each
    write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or \
                spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
