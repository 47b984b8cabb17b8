"""Reading Gold back: the sink folder, or a snapshot of it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cardtide.operators.snapshot import one_per_window
from cardtide.schema import GOLD


def _scan(reader: DataFrameReader, path: str) -> DataFrame | None:
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        # Missing altogether, or (when the schema comes from the files) nothing readable in it.
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def scan_gold(spark: SparkSession, gold_dir: str, *, skip_unreadable: bool = False) -> DataFrame | None:
    """All rows of a Gold folder, or None when it is missing or holds no data files.

    The folder itself is read, never a file pattern: that way Spark follows the sink's commit log
    and leaves out files of a failed batch.
    """
    reader = spark.read.schema(GOLD).option("ignoreCorruptFiles", str(skip_unreadable).lower())
    rows = _scan(reader, gold_dir)
    if rows is None or (rows.isEmpty() and not rows.inputFiles()):
        return None
    return rows


def _any_readable(spark: SparkSession, gold_dir: str) -> bool:
    """Whether at least one file has a readable footer; the footers are read by a Spark job."""
    reader = spark.read.options(mergeSchema="true", ignoreCorruptFiles="true")
    return _scan(reader, gold_dir) is not None


def scan_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """A snapshot file or folder written by Spark or by pandas, or None when there is none."""
    rows = _scan(spark.read, path)
    if rows is None:
        return None
    columns = []
    for wanted in GOLD:
        if wanted.name not in rows.columns:
            column = F.lit(None)
        elif wanted.name.startswith("window_") and isinstance(rows.schema[wanted.name].dataType, LongType):
            # pandas writes nanoseconds, which arrive as integers (see session.configure).
            column = F.timestamp_micros(F.expr(f"{wanted.name} DIV 1000"))
        else:
            column = F.col(wanted.name)
        columns.append(column.cast(wanted.dataType).alias(wanted.name))
    return rows.select(*columns)


def load_gold(spark: SparkSession, gold_dir: str, sample_path: str | None = None) -> DataFrame:
    """Gold for monitoring: the live folder, else the snapshot, else an empty table.

    Unreadable files are left out. The snapshot takes over only when no file of the folder can be
    read; a folder that merely has no windows yet is an empty Gold. One row per window, in no order: who needs
    one sorts, and figures that do not are spared it.
    """
    live = scan_gold(spark, gold_dir, skip_unreadable=True)
    if live is not None and (not live.isEmpty() or _any_readable(spark, gold_dir)):
        return one_per_window(live)
    sample = None if sample_path is None else scan_snapshot(spark, sample_path)
    if sample is not None:
        return one_per_window(sample)
    return spark.createDataFrame([], GOLD)
