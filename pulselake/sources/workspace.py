"""The shared working folder of a session.

Executors may be lost at any time, so intermediate results that several
plans read are written to reliable storage, never to executor disks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from pulselake.sources.files import delete

# Codec of documents in the log and in Bronze, where they take less than half the space that the default one leaves.
COMPRESSION = "zstd"

_FOLDER_SETTING = "spark.checkpoint.dir"
_FREEING_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get(_FOLDER_SETTING, None) or context.getConf().get(_FOLDER_SETTING)
    named = named or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_FOLDER_SETTING} to a folder all executors share")
        named = tempfile.mkdtemp(prefix="pulselake-", dir="/tmp")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder, or in the present scratch folder, that nothing has used before."""
    return f"{_SCRATCH.get() or shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder in the shared folder for all that is settled inside, deleted at the end.

    Only what does not outlive the block may be settled in it: its results must
    have been stored elsewhere by then.
    """
    folder = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    before = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(before)
        delete(spark, folder)


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every write inside when it ends.

    Otherwise they stay until the driver happens to collect its garbage, beside
    all that later writes shuffle. A write plans anew, so none is asked for again.
    """
    before = spark.conf.get(_FREEING_SETTING, None)
    spark.conf.set(_FREEING_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREEING_SETTING) if before is None else spark.conf.set(_FREEING_SETTING, before)


def settle(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``rows`` to the shared folder, or to ``path``, and read them from there on.

    A Parquet table rather than a checkpoint: it is compressed, later reads
    take only the columns they need, and its size is known to the planner.
    """
    spark = rows.sparkSession
    path = path or fresh_folder(spark, "settled")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
