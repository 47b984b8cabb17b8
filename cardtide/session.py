"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every job here relies on; the caller owns the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Snapshots written by pandas carry nanosecond timestamps, which Spark refuses to read otherwise.
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Set SQL settings for the block. A streaming query keeps the values it was started under."""
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


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    What is written there belongs to whoever set that folder, who also clears it when the session has ended; tables that
    a returned DataFrame still reads must not go before. A job that writes its results itself may clear it earlier (``scratch_made``).
    Only a local master may fall back to a folder of this machine: on a cluster the executors
    could not see it, and it would be lost with its host.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        shared = given.get() if given.isDefined() else None
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        shared = tempfile.mkdtemp(prefix="cardtide-")
    path = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    for made in _MADE:
        made.append(path)
    return path


_MADE: list[list[str]] = []


@contextmanager
def scratch_made() -> Iterator[list[str]]:
    """The folders that ``scratch_dir`` names within the block, so that whoever knows that nothing reads them any more can ``discard`` them."""
    made: list[str] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE[:] = [m for m in _MADE if m is not made]


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders of ``scratch_dir`` by the file system they lie in; those that were never written are passed over."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
