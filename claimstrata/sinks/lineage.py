"""Cutting lineage and holding frames that are read more than once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it in ``spark.checkpoint.dir``.

    Only a local master without the setting gets a temporary folder, one per
    application. On a cluster a missing setting is an error, since a
    machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get(_SETTING, None)
    context = spark.sparkContext
    if folder:
        if folder.startswith("file:") and not context.master.startswith("local"):
            raise RuntimeError(f"{_SETTING} names a machine's own folder: {folder}")
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="claimstrata-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no one has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame after an eager, reliable checkpoint in the shared folder.

    Filters and column choice stop at a checkpoint. Where a later step reads
    only part of the data, ``write_layer`` is the better cut.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Hold a frame in memory, spilling to disk, for the length of a ``with`` block."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()
