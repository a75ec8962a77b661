"""Session settings and the written tables that cut long lineages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000  # texts that stand in an Arrow batch, in the executor and in its Python worker


def build_session(app_name: str = "fraudspark", **settings: str) -> SparkSession:
    """A session with UTC clocks and adaptive execution; cluster settings come from outside."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a local run without one gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fraudspark-"))
    return context.getCheckpointDir().rstrip("/")


@contextmanager
def with_setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A session setting for what is run inside; the former value afterwards."""
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """At most ``BATCH_ROWS`` rows in an Arrow batch for what is run inside; a smaller bound of the session holds."""
    rows = int(spark.conf.get(ARROW_ROWS))  # 0 or less: no bound
    with with_setting(spark, ARROW_ROWS, min(BATCH_ROWS, rows) if rows > 0 else BATCH_ROWS):
        yield


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later passes read only the columns they need, and a lost executor costs a
    re-read instead of a replay of everything upstream.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
