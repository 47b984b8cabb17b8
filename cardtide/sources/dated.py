"""Tables of windows laid out by date: one folder per date, so that what concerns few dates reads and writes few folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardtide.session import scratch_dir

DATE = "window_date"


def with_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DATE, F.to_date("window_start"))


def write_by_date(rows: DataFrame, path: str, *, replace: bool = False) -> None:
    """Append windows to their dates' folders; with ``replace``, put them in the place of all that those dates hold.

    Files are ranges of windows in order. Replacing dates is one commit for all of them, and may be repeated after a
    failure; rows that come from the same table are written elsewhere first (``landed``).
    """
    ranged = with_date(rows).repartitionByRange(DATE, "window_start").sortWithinPartitions(DATE, "window_start")
    writer = ranged.write.partitionBy(DATE)
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def landed(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written to the shared folder and read back."""
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def dates_of(spark: SparkSession, path: str) -> list[str]:
    """The dates of a table in order, from the names of its folders: neither files nor their footers are looked at."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()]
    return sorted(name.removeprefix(f"{DATE}=") for name in names if name.startswith(f"{DATE}=") and name[len(DATE) + 1 :][:1].isdigit())


def read_dates(spark: SparkSession, path: str, schema: StructType, dates: Sequence[str] | None = None) -> DataFrame:
    """The windows of some dates, or of all. Only the folders of those dates are listed."""
    known = dates_of(spark, path)
    wanted = known if dates is None else sorted(set(dates) & set(known))
    if not wanted:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(StructType([*schema.fields]).add(DATE, "date")).option("basePath", path)
    if wanted == known:
        return reader.parquet(path).select(*schema.fieldNames())
    return reader.parquet(*[f"{path}/{DATE}={d}" for d in wanted]).select(*schema.fieldNames())


def latest(spark: SparkSession, path: str, schema: StructType, n: int) -> DataFrame:
    """The rows of the newest dates that together hold at least ``n`` different windows, or of all dates.

    Folders are tried from the newest on, twice as many each time, so what is read depends on ``n`` and on how full a
    date is, and not on the age of the table.
    """
    known, take = dates_of(spark, path)[::-1], 1
    while True:
        rows = read_dates(spark, path, schema, known[:take])
        if take >= len(known) or rows.select("window_start").distinct().limit(n).count() >= n:
            return rows
        take *= 2


def drop_dates(spark: SparkSession, path: str, dates: Sequence[str]) -> None:
    """Delete the folders of some dates."""
    for date in dates:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DATE}={date}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
