"""Session helpers: a local session for tests and benchmarks, and durable stage tables.

Library code never sets a master.  Work that must cut its lineage writes a Parquet table under the
shared folder named by ``spark.checkpoint.dir``, so the result outlives any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "corpusloom", shuffle: int = 8) -> SparkSession:
    """A local session; on a cluster the submit command configures the session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="corpusloom-"))
        .getOrCreate()
    )


def durable_dir(spark: SparkSession) -> str:
    """The folder for stage tables, as the session names it in ``spark.checkpoint.dir``.

    Where that is unset, a local session is given a fresh folder of its own, which it names from then on; on a
    cluster, whose tasks would not see such a folder, it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one stage table."""
    return f"{durable_dir(spark)}/{label}-{uuid.uuid4().hex}"


# Lets Spark delete the shuffle files of a job as soon as the job has ended; else they stay until the driver happens to
# collect the garbage of its plan, and a query's stages add up on disk.
SHUFFLE_CLEANUP = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.shuffleDependency.fileCleanup.enabled")


@contextmanager
def shuffles_end_with_their_job(spark: SparkSession) -> Iterator[None]:
    """Jobs planned inside delete their shuffle files when they end; other jobs of the session keep its settings."""
    before = {key: spark.conf.get(key, None) for key in SHUFFLE_CLEANUP}
    for key in SHUFFLE_CLEANUP:
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: lineage is cut and every reader sees the same rows.

    The write is planned by itself, so nothing else can ask for its shuffle files, and they go with it.  ``codec`` zstd
    makes smaller files than the session's; Spark sizes a table by its files, so hint the joins of such a table.
    """
    path = stage_path(df.sparkSession, label)
    with shuffles_end_with_their_job(df.sparkSession):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Bytes of one Arrow batch between Spark and Python; both sides hold it outside of the heap.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold about BATCH_BYTES, unless it has a size of its own.

    Documents differ by orders of magnitude in size, so a number of rows does not bound a batch.
    """
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, str(BATCH_BYTES))
