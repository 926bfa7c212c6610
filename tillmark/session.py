"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
RELEASE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A task that writes few parts keeps their files open at once, instead of sorting its whole rows by
# part and spilling them when memory is short.
#
# The Java runtime never compiles methods above this many bytes of bytecode. A long chain of
# text expressions fused into one such method runs interpreted, many times slower than the
# same chain in smaller methods, which Spark generates once the fused one passes the limit.
TUNING = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str | int = "*", app: str = "tillmark", **settings) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (TUNING | settings).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the text-heavy jobs want; results do not depend on them."""
    for key, value in TUNING.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Statements that run inside delete the files of their shuffles when they end, which otherwise
    stay on disk until the driver happens to collect its garbage."""
    if not spark.conf.isModifiable(RELEASE_SETTING):
        yield
        return
    before = spark.conf.get(RELEASE_SETTING)
    spark.conf.set(RELEASE_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE_SETTING, before)


def spread(df: DataFrame) -> DataFrame:
    """Give an input of few partitions to all cores; larger inputs are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints and intermediate tables of one run.

    It lies under the shared folder the session names. Only a local session, whose
    executors share this machine's disk, may fall back to a temporary folder.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tillmark-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
