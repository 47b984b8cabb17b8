"""Gold: one row per event-time window. The same function serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardtide.functions.money import money_sum
from cardtide.schema import FRAUD_TYPES, GOLD, WATERMARK, WINDOW

# The payload fields that Gold is made of.
GOLD_INPUT = ("amount", "timestamp", "is_fraud", "fraud_type")


def with_watermark(transactions: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return transactions.withWatermark("event_time", delay)


def windowed_gold(
    transactions: DataFrame, duration: str = WINDOW, *, minor_units: int | None = None
) -> DataFrame:
    """Counts, amounts and label counts per tumbling window ``[start, end)``.

    Rows without an event time are in no window. Rows without an amount count as transactions but
    not in the total or the mean. ``fraud_total`` follows ``is_fraud`` alone, the per-pattern
    counts follow ``fraud_type`` alone. Every aggregate combines map-side, so what is shuffled is
    one row per task and window however many rows one window holds.
    """
    total = money_sum("amount", minor_units)
    # A window whose amounts are all NULL has a NULL mean; the guard keeps ANSI from dividing by zero.
    priced = F.count("amount")
    mean = F.avg("amount") if minor_units is None else F.when(priced > 0, total / priced)
    per_type = [
        F.count_if(F.col("fraud_type") == label).alias(f"fraud_{label}") for label in FRAUD_TYPES
    ]
    return (
        transactions.groupBy(F.window("event_time", duration).alias("span"))
        .agg(
            F.count(F.lit(1)).alias("tx_count"),
            total.alias("total_amount"),
            mean.alias("avg_amount"),
            *per_type,
            F.count_if("is_fraud").alias("fraud_total"),
        )
        .withColumns({"window_start": F.col("span.start"), "window_end": F.col("span.end")})
        .select(*GOLD.fieldNames())
    )
