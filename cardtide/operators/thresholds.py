"""Precision and recall of a score at every threshold, by distributed prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardtide.session import scratch_dir


def prefix_sums(rows: DataFrame, order: Sequence[Column], sums: Sequence[str]) -> DataFrame:
    """``rows`` with ``upto_<name>`` for each of ``sums``: the sum over all rows up to and including theirs in a total ``order``.

    Rows are dealt into ranges of the order, each range adds up its own, and only one row per range takes part in the
    sums over ranges. So no window covers the table: its widest one holds one range, whose size adaptive execution
    bounds.
    """
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, "ranges")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path).withColumn("_range", F.shiftright("_at", 33))
    totals = ranged.groupBy("_range").agg(*[F.sum(name).alias(f"_{name}") for name in sums])
    # As many rows as ranges.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_range", *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}") for name in sums])
    inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({f"upto_{name}": F.sum(name).over(inside) for name in sums}).join(before, "_range")
    return summed.select(*rows.columns, *[(F.col(f"upto_{name}") + F.col(f"_{name}")).alias(f"upto_{name}") for name in sums])


def scores_by_threshold(scored: DataFrame, score: str, positive: str) -> DataFrame:
    """For every different ``score``, the verdicts of a detector that flags rows of that score and above.

    ``n_flagged`` and ``n_hits`` of them, ``precision`` and ``recall`` (null without any positive row). Rows without a
    score are never flagged, but count as missed where they are positive.
    """
    truth = F.coalesce(F.col(positive), F.lit(False))
    by_score = scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("flagged"), F.count_if(truth).alias("hits")
    )
    positives = scored.agg(F.count_if(truth)).first()[0]
    found = prefix_sums(by_score, [F.desc("score")], ["flagged", "hits"])
    return found.select(
        "score",
        F.col("upto_flagged").alias("n_flagged"),
        F.col("upto_hits").alias("n_hits"),
        (F.col("upto_hits") / F.col("upto_flagged")).alias("precision"),
        (F.col("upto_hits") / F.lit(float(positives)) if positives else F.lit(None).cast("double")).alias("recall"),
    )
