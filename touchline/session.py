"""Session settings and tables that outlive executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution chooses partition counts, broadcasts by measured size and
# splits hot partitions of a join, so none of them is fixed in the plans.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "touchline", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def durable_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Without that setting a temporary folder is used
    in local mode only: on a cluster the executors would not share it."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="touchline-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of what runs inside go when it ends, and not when the driver next collects its garbage."""
    return _set(spark, SHUFFLE_CLEANUP, "true")


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def arrow_batches(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """What runs inside sends rows to Python in batches of about ``size`` bytes at most, for a batch is held by the
    executor and by its Python worker. A larger row goes alone."""
    return _set(spark, ARROW_BYTES, str(size))


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the durable folder and read it back. Later plans start from the files: they
    see one fixed result, with known sizes, whatever happens to the executors that made it."""
    spark = df.sparkSession
    path = f"{durable_dir(spark)}/tables/{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
