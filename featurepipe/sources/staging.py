"""Tables written between steps, so a lost executor re-reads a file instead of re-running the lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Folders of single-process applications that name none.
_OWN_FOLDERS: dict[str, str] = {}

# The tables of the open ``temporary_tables`` blocks of this thread or task, innermost last.
_OPEN_BLOCKS: ContextVar[tuple[list[str], ...]] = ContextVar("open_blocks", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session's ``spark.checkpoint.dir`` names it.

    A cluster must set it. A single-process session that has none, as in tests, is given one here.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="featurepipe-")
    return _OWN_FOLDERS[application]


def staging_uri(spark: SparkSession, name: str) -> str:
    """A fresh place under the shared folder; all places of one application have one parent."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/featurepipe/{application}/{name}-{uuid.uuid4().hex}"


def materialize(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame as a Parquet table in the shared folder and read it back.

    Unlike a row checkpoint the table stays columnar, so later passes read only the columns they need.
    The innermost open block of this thread owns the table; without one it belongs to the caller.
    """
    spark = frame.sparkSession
    uri = own_staging(staging_uri(spark, name))
    frame.write.parquet(uri)
    return spark.read.schema(frame.schema).parquet(uri)


def own_staging(uri: str) -> str:
    """Leave a table written at a place to the innermost open block of this thread, if there is one."""
    if blocks := _OPEN_BLOCKS.get():
        blocks[-1].append(uri)
    return uri


def delete(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let the files of shuffles go that no query needs any more; Spark deletes them once the driver's garbage is collected."""
    # The last query of a session is held until the next one.
    spark.range(1).count()
    spark._jvm.System.gc()


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialize`` writes inside the block when it ends.

    Frames built on them cannot be read afterwards, so write the results before leaving. Blocks of other
    threads have their own lists.
    """
    written: list[str] = []
    token = _OPEN_BLOCKS.set((*_OPEN_BLOCKS.get(), written))
    try:
        yield
    finally:
        _OPEN_BLOCKS.reset(token)
        for uri in written:
            delete(spark, uri)
