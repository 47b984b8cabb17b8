"""What is far above the usual, by quantiles: sketches per category and day that merge over any period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Width of a sketch; its error is stated for this one.
SKETCH_K = 1024
#: How far the rank of an estimated quantile may be from the asked one, as a share of all rows, in nearly all cases.
RANK_ERROR = 0.005


def quantile_sketches(transactions: DataFrame, min_amount: float = 5.0, k: int = SKETCH_K) -> DataFrame:
    """(category, day, n, sketch) of the amounts above ``min_amount``: a few kilobytes however many rows a day has.

    Sketches are made before the shuffle and merged behind it, so a hot category costs one sketch per task. Amounts
    that are no numbers, or infinite, stay out, as do rows without a time.
    """
    amount = F.col("amount")
    usual = transactions.where((amount > min_amount) & (amount < float("inf")) & F.col("event_time").isNotNull())
    return usual.groupBy("category", F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("amount", F.lit(k)).alias("sketch")
    )


def quantile_norms(sketches: DataFrame, quantiles: Sequence[float], k: int = SKETCH_K) -> DataFrame:
    """(category, n, quantile, amount) over all days given: select days first for a period."""
    merged = sketches.groupBy("category").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))

    def found(q: float) -> Column:
        share = F.lit(float(q))
        return F.struct(share.alias("quantile"), F.kll_sketch_get_quantile_double("sketch", share).alias("amount"))

    return merged.select("category", "n", F.inline(F.array(*map(found, quantiles))))


def rank_errors(transactions: DataFrame, norms: DataFrame, min_amount: float = 5.0) -> DataFrame:
    """(category, n, quantile, error): how far the true rank of each estimate is from the asked one, as a share of the rows."""
    amount = F.col("amount")
    usual = transactions.where((amount > min_amount) & (amount < float("inf")) & F.col("event_time").isNotNull()).select("category", "amount")
    # A few estimates per category, so their table is a few rows for each.
    estimates = norms.select("category", "n", "quantile", F.col("amount").alias("estimate"))
    ranks = usual.join(estimates, "category").groupBy("category", "n", "quantile").agg(
        F.count_if(F.col("amount") < F.col("estimate")).alias("below"), F.count_if(F.col("amount") <= F.col("estimate")).alias("upto")
    )
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    error = F.greatest(F.lit(0.0), low - F.col("quantile"), F.col("quantile") - high)
    return ranks.select("category", "n", "quantile", error.alias("error"))
