"""Session settings and the shared scratch folder."""

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def build_session(app_name: str = "wayfare", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on and zone-free timestamps.

    Shuffle partitions are left to the cluster's own setting unless given: adaptive execution
    merges small ones and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset (single-machine
    tests) is a temporary folder made, and recorded in the session so it is made once.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="wayfare-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder; no two calls return the same one."""
    return os.path.join(scratch_root(spark), f"wayfare-{uuid.uuid4().hex[:12]}", name)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A handful of driver-side values as a table, held in the plan itself."""
    fields = StructType.fromDDL(schema).fields
    entries = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*entries)))


TASK_ROWS = 250_000  # of trips, as wide as they are stored, that a task sorts or groups: some 50 MB


@contextmanager
def small_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, writes of about ``rows`` rows run in tasks small enough to sort and group in memory without spilling.

    The number of tasks grows with the rows, the size of one does not. A task that meets few partitions of a
    written table opens a file for each in place of sorting its rows. What the session sets itself stays; results don't depend on any of it.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": parts,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "12m",
        "spark.sql.files.maxPartitionBytes": "8m",
        "spark.sql.maxConcurrentOutputFileWriters": 8,
    }
    wanted = {key: value for key, value in wanted.items() if spark.conf.get(key, None) is None}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key in wanted:
            spark.conf.unset(key)
