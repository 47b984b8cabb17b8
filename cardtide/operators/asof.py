"""As-of join: each row with the version that is in force at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICE, _FROM, _UNTIL = "_slice", "_from", "_until"


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    *,
    time: str = "event_time",
    valid_from: str = "valid_from",
    slice_seconds: int = 86_400,
) -> DataFrame:
    """All rows and columns of ``rows`` with the columns of the version of their ``keys`` that is the last at or before their time.

    Rows before the first version, without a time, or with a null key have nulls there. Of several versions of one key
    and instant the greatest (column by column) counts.

    A version is in force until the next one of its key. It is sent to each time slice in which that is so, and rows
    meet the versions of their key and slice in a plain join, with the exact times as its condition. So no key is a
    task: a key's rows are dealt by slice, and adaptive execution splits what is still large, as both sides are
    exchanged for the join alone. Choose slices no shorter than versions last, else each is sent many times.
    """
    values = [c for c in versions.columns if c not in keys and c != valid_from]

    def number(instant: Column) -> Column:
        return F.floor(F.unix_seconds(instant.cast("timestamp")) / slice_seconds)

    one = versions.where(F.col(valid_from).isNotNull()).groupBy(*keys, valid_from).agg(F.max(F.struct(*values)).alias("_version"))
    # Versions only: as many rows as a key has versions.
    following = F.lead(valid_from).over(Window.partitionBy(*keys).orderBy(valid_from))
    end = rows.agg(F.max(time)).first()[0]
    lasting = one.withColumn(_UNTIL, following).withColumnRenamed(valid_from, _FROM).where(F.col(_FROM) <= F.lit(end))
    slices = F.sequence(number(F.col(_FROM)), number(F.least(F.coalesce(_UNTIL, F.lit(end)), F.lit(end))))
    sent = lasting.withColumn(_SLICE, F.explode(slices)).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col(_SLICE).alias("_at"), _FROM, _UNTIL, "_version"
    )
    placed = rows.withColumn(_SLICE, number(F.col(time)))
    met = (F.col(_SLICE) == F.col("_at")) & (F.col(time) >= F.col(_FROM)) & (F.col(_UNTIL).isNull() | (F.col(time) < F.col(_UNTIL)))
    for k in keys:
        met = met & (F.col(k) == F.col(f"_key_{k}"))
    found = placed.join(sent, met, "left")
    # A version of nulls alone is a version too; where there is none, the struct itself is null.
    return found.select(*rows.columns, *[F.col("_version")[c].alias(c) for c in values], F.col(_FROM).alias(valid_from))
