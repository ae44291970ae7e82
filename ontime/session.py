"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# The JVM compiles methods of up to 8000 bytes; longer generated ones run interpreted.
METHOD_CONF, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one below the warehouse.

    Both are shared by all executors; no machine's own folder is used, whatever
    the master.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder (survives lost executors)."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def compiled_methods(spark: SparkSession) -> AbstractContextManager[None]:
    """For the actions inside, a stage whose generated method is too long for the JVM to
    compile is run operator by operator, in methods that are not."""
    return _setting(spark, METHOD_CONF, str(COMPILED_BYTES))


def blocks_per_batch(spark: SparkSession, blocks: int) -> AbstractContextManager[None]:
    """For the actions inside, a Python task is handed at most that many rows at a time,
    which are large ones."""
    return _setting(spark, BATCH_CONF, str(blocks))
