"""Session settings the operators rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.files import hadoop_path

_LOCAL_ROOTS: dict[str, str] = {}
#: Scratch folders of the innermost ``temporary`` block of this thread; jobs of one session
#: in several threads each have their own.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options results depend on; all can be set on a live session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A repeated key inside one JSON object is legal input: the last one wins.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Many small files are listed by some tasks for each core, not by one for each path.
    tasks = max(32, 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))
    # Rows and bytes of one Arrow batch: bound the memory of a Python task.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime options for the actions inside the block; then as they were."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def work_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOTS[context.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root; nothing is ever reused."""
    path = f"{work_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders that a job makes when it ends, also when it fails.

    For jobs that write their result: a DataFrame that still reads a pinned part must
    not leave the block.
    """
    made: list[str] = []
    outer = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(outer)
        for name in made:
            fs, path = hadoop_path(spark, name)
            fs.delete(path, True)


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Use it before a DataFrame with run-dependent values (line positions) feeds
    several passes.  Unlike a cached or locally checkpointed plan, the files
    survive the loss of any executor.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
