"""The data under each monitoring panel. Every function takes and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardtide.functions.money import (
    as_count,
    as_dollars,
    as_percent,
    money_sum,
    round_half_even,
)
from cardtide.schema import AMBER_AT, RECENT_HEADINGS, RECENT_WINDOWS, RED_AT, STACKED


def kpi_summary(gold: DataFrame, *, minor_units: int | None = None) -> DataFrame:
    """One row of headline figures; all zero when there are no windows."""
    sums = gold.agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.coalesce(F.sum("tx_count"), F.lit(0)).cast("bigint").alias("total_tx"),
        F.coalesce(F.sum("fraud_total"), F.lit(0)).cast("bigint").alias("total_fraud"),
        F.coalesce(money_sum("total_amount", minor_units), F.lit(0.0)).alias("total_amount"),
    )
    rate = F.when(
        F.col("total_tx") > 0, F.col("total_fraud") / F.col("total_tx") * F.lit(100.0)
    ).otherwise(F.lit(0.0))
    return sums.select(
        "n_windows", "total_tx", "total_fraud", rate.alias("fraud_rate_pct"), "total_amount"
    )


def display_kpis(kpis: DataFrame) -> DataFrame:
    """The headline figures as text."""
    return kpis.select(
        as_count("total_tx").alias("Transactions"),
        as_count("total_fraud").alias("Frauds detected"),
        as_percent("fraud_rate_pct").alias("Fraud rate"),
        as_dollars("total_amount", 0).alias("Volume processed"),
    )


def throughput_series(gold: DataFrame) -> DataFrame:
    """Transactions per window, oldest first; windows without transactions have no point."""
    return gold.select("window_start", "tx_count").orderBy("window_start")


def fraud_by_type(gold: DataFrame) -> DataFrame:
    """Long form of the per-pattern counts: one row per window and pattern.

    A consumer that needs an order sorts for itself; the rows of one window stay together.
    """
    series = gold.select(
        "window_start", *[F.col(f"fraud_{label}").alias(label) for label in STACKED]
    )
    return series.unpivot("window_start", list(STACKED), "fraud_type", "n")


def recent_windows(gold: DataFrame, n: int = RECENT_WINDOWS) -> DataFrame:
    """The latest windows, newest first, amounts rounded to cents."""
    return (
        gold.orderBy(F.desc("window_start"))
        .limit(n)
        .select(
            "window_start",
            "tx_count",
            round_half_even("total_amount").alias("total_amount"),
            round_half_even("avg_amount").alias("avg_amount"),
            "fraud_card_testing",
            "fraud_high_amount",
            "fraud_impossible_travel",
            "fraud_total",
        )
    )


def display_recent(recent: DataFrame) -> DataFrame:
    """The latest windows under their display headings, counts and amounts as text."""
    return recent.withColumns(
        {
            "tx_count": as_count("tx_count"),
            "total_amount": as_dollars("total_amount", 0),
            "avg_amount": as_dollars("avg_amount", 2),
        }
    ).withColumnsRenamed(RECENT_HEADINGS)


def window_alerts(gold: DataFrame, red_at: int = RED_AT, amber_at: int = AMBER_AT) -> DataFrame:
    """Severity of each window by its fraud count."""
    frauds = F.col("fraud_total")
    severity = F.when(frauds >= red_at, "red").when(frauds >= amber_at, "amber").otherwise("")
    return gold.select("window_start", "fraud_total", severity.alias("severity"))
