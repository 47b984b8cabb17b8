"""Sufficient statistics of windows: additive, so that windows merge upwards and corrections are differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, LongType, StructType, TimestampType

from cardtide.functions.money import EXACT_BELOW
from cardtide.schema import FRAUD_TYPES, GOLD, WINDOW

CENTS = 100

_COUNTS = ["tx_count", "priced", *[f"fraud_{label}" for label in FRAUD_TYPES], "fraud_total"]

#: Per window: rows, rows with an amount, whole minor units of the amounts that fit, the sum of the others, and label counts.
STATISTICS = StructType().add("window_start", TimestampType()).add("window_end", TimestampType())
for _name in _COUNTS:
    STATISTICS = STATISTICS.add(_name, LongType())
STATISTICS = STATISTICS.add("units", DecimalType(38, 0)).add("rest", DoubleType())

_KEY = ["window_start", "window_end"]


def window_statistics(transactions: DataFrame, duration: str = WINDOW, minor_units: int = CENTS) -> DataFrame:
    """The statistics of transactions per tumbling window, in batch or on a stream."""
    amount = F.col("amount")
    fits = F.abs(amount) < EXACT_BELOW
    aggregates = {
        "tx_count": F.count(F.lit(1)),
        "priced": F.count(amount),
        **{f"fraud_{label}": F.count_if(F.col("fraud_type") == label) for label in FRAUD_TYPES},
        "fraud_total": F.count_if("is_fraud"),
        "units": F.sum(F.when(fits, F.rint(amount * F.lit(float(minor_units)))).cast("decimal(18,0)")).cast("decimal(38,0)"),
        "rest": F.sum(F.when(~fits, amount)),
    }
    sums = transactions.groupBy(F.window("event_time", duration).alias("span")).agg(*[c.alias(n) for n, c in aggregates.items()])
    return sums.withColumns({"window_start": F.col("span.start"), "window_end": F.col("span.end")}).select(*STATISTICS.fieldNames())


def merged(statistics: DataFrame, duration: str | None = None) -> DataFrame:
    """Statistics of the same windows added up, or of windows of ``duration`` that hold whole finer ones."""
    sums = [F.sum(name).alias(name) for name in _COUNTS]
    sums += [F.sum("units").cast("decimal(38,0)").alias("units"), F.sum("rest").alias("rest")]
    if duration is None:
        return statistics.groupBy(*_KEY).agg(*sums).select(*STATISTICS.fieldNames())
    coarse = statistics.groupBy(F.window("window_start", duration).alias("span")).agg(*sums)
    return coarse.withColumns({"window_start": F.col("span.start"), "window_end": F.col("span.end")}).select(*STATISTICS.fieldNames())


def as_gold(statistics: DataFrame, minor_units: int = CENTS) -> DataFrame:
    """Gold of statistics that have one row per window."""
    exact = F.col("units").cast("double") / F.lit(float(minor_units))
    total = F.coalesce(exact + F.col("rest"), exact, F.col("rest"))
    rows = statistics.withColumns({"total_amount": total, "avg_amount": F.when(F.col("priced") > 0, total / F.col("priced"))})
    return rows.select(*GOLD.fieldNames())


def differences(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """What has to be added to ``stored`` so that its windows are those of ``fresh``; windows without a difference are left out.

    Only windows that ``fresh`` counts more rows in are put right: rows are added to a log and never taken away.
    Amounts that do not fit are compared as they were added, as doubles.
    """
    old = stored.select(*_KEY, *[F.col(f.name).alias(f"_{f.name}") for f in STATISTICS if f.name not in _KEY])
    both = fresh.join(old, _KEY, "left").where(F.col("tx_count") > F.coalesce("_tx_count", F.lit(0)))

    def less(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) - F.coalesce(F.col(f"_{name}"), F.lit(0))

    units = F.when(F.col("units").isNotNull() | F.col("_units").isNotNull(), less("units").cast("decimal(38,0)"))
    rest = F.when(~F.col("rest").eqNullSafe(F.col("_rest")), less("rest"))
    return both.select(*_KEY, *[less(name).alias(name) for name in _COUNTS], units.alias("units"), rest.alias("rest"))
