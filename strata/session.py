"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# A scan with eleven gates and a wide duplicate removal compiles to one method above the size the
# JVM translates to machine code by default; without this flag it would be interpreted.
_JIT = "-XX:-DontCompileHugeMethods"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # The default, INT96, carries no statistics, so no filter on a timestamp could skip data.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.executor.extraJavaOptions": _JIT,
}


def local_session(cores: int | str = "*", app: str = "strata", **extra: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; on a cluster pass ``SETTINGS`` to submit."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = SETTINGS | {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.driver.extraJavaOptions": _JIT,
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared folder that ``spark.checkpoint.dir`` names.

    Executors write and read it, so a machine-local folder is only acceptable in local mode.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="strata-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/strata/{name}-{uuid.uuid4().hex}"


@contextmanager
def partitions_for(spark: SparkSession, rows: int, rows_per_partition: int) -> Iterator[None]:
    """Raise the number of shuffle partitions to what ``rows`` need, for the work inside.

    Adaptive execution merges small partitions but does not split those of an aggregate, so the
    number has to be large enough from the start for a partition to fit in a task's memory.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), math.ceil(rows / rows_per_partition))))
    try:
        yield
    finally:
        spark.conf.set(key, before)
