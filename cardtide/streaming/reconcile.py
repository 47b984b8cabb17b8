"""Putting stored windows right with rows that came too late for the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardtide.operators.statistics import STATISTICS, differences, merged, window_statistics
from cardtide.schema import BRONZE, WINDOW
from cardtide.sources.dated import DATE, landed, read_dates, with_date, write_by_date


def _dated(schema: StructType, name: str) -> StructType:
    return StructType([*schema.fields]).add(name, "date")


def stored_statistics(spark: SparkSession, streamed_dir: str, corrections_dir: str, dates: list[str] | None = None) -> DataFrame:
    """Statistics the stream has written, with all corrections added: one row per window."""
    streamed = spark.read.schema(_dated(STATISTICS, DATE)).parquet(streamed_dir)
    if dates is not None:
        streamed = streamed.where(F.col(DATE).isin([*dates]))
    corrections = read_dates(spark, corrections_dir, STATISTICS, dates)
    return merged(streamed.select(*STATISTICS.fieldNames()).unionAll(corrections))


def reconcile(
    spark: SparkSession,
    bronze_dir: str,
    streamed_dir: str,
    corrections_dir: str,
    *,
    duration: str = WINDOW,
    closed_before: Column | None = None,
) -> list[str]:
    """Append to ``corrections_dir`` what Bronze holds more of than the stored windows; returns the dates touched.

    The stream leaves out rows behind its watermark, while Bronze (landed ``by_date``) keeps them. A date is touched
    if Bronze has more rows of it than the windows count, which the row counts of Bronze's files tell; only touched
    dates are then read. Their windows are added up again, and the differences to what is stored, sums and counts
    alike, become new rows: stored rows are never rewritten, and a run without anything late writes nothing. A run
    that failed is simply repeated.

    Windows still open in the stream would be given out by it once more: where it goes on, pass ``closed_before``, its
    watermark. Bronze has to have landed what the stream has read; windows that it has fewer rows of are left alone.
    """
    bronze = spark.read.schema(_dated(BRONZE, "event_date")).parquet(bronze_dir)
    landed_rows = bronze.where("event_date is not null").groupBy(F.col("event_date").alias(DATE)).agg(F.count(F.lit(1)).alias("rows"))
    counted = with_date(stored_statistics(spark, streamed_dir, corrections_dir)).groupBy(DATE).agg(F.sum("tx_count").alias("counted"))
    lacking = landed_rows.join(counted, DATE, "left").where(F.col("rows") > F.coalesce("counted", F.lit(0)))
    # One value per date at most.
    dates = sorted(r[0] for r in lacking.select(F.col(DATE).cast("string")).collect())
    if not dates:
        return []
    fresh = window_statistics(bronze.where(F.col("event_date").isin(dates)), duration)
    if closed_before is not None:
        fresh = fresh.where(F.col("window_end") <= closed_before)
    missing = differences(fresh, stored_statistics(spark, streamed_dir, corrections_dir, dates))
    write_by_date(landed(missing, "corrections"), corrections_dir)
    return dates
