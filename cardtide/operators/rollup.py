"""Coarser windows from stored finer ones, and keeping them up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardtide.operators.statistics import STATISTICS, merged
from cardtide.sources.dated import landed, read_dates, write_by_date


def roll_up(spark: SparkSession, fine_dir: str, coarse_dir: str, duration: str) -> None:
    """All windows of ``duration`` (a day at most) from the stored statistics of finer ones."""
    write_by_date(merged(read_dates(spark, fine_dir, STATISTICS), duration), coarse_dir)


def refresh(spark: SparkSession, fine_dir: str, coarse_dir: str, duration: str, changed: DataFrame) -> list[str]:
    """Bring coarse windows up to date after finer windows (``window_start`` of ``changed``) have changed; returns the dates touched.

    Only dates of changed windows are read and written, and of those only changed coarse windows are added up again;
    the others of a touched date are taken over as they are. Rows behind the windows are never read. It may be
    repeated after a failure.
    """
    stale = landed(changed.select(F.window("window_start", duration)["start"].alias("window_start")).distinct(), "stale-windows")
    # One value per date of the table at most.
    dates = [r[0] for r in stale.select(F.to_date("window_start").cast("string")).distinct().collect()]
    fine = read_dates(spark, fine_dir, STATISTICS, dates)
    parent = F.window("window_start", duration)["start"]
    again = fine.withColumn("_parent", parent).join(stale.withColumnRenamed("window_start", "_parent"), "_parent", "left_semi").drop("_parent")
    kept = read_dates(spark, coarse_dir, STATISTICS, dates).join(stale, "window_start", "left_anti").select(*STATISTICS.fieldNames())
    write_by_date(landed(merged(again, duration).unionAll(kept), "refreshed-windows"), coarse_dir, replace=True)
    return sorted(dates)
