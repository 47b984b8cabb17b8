"""Union, deduplication and ordering of Gold copies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardtide.schema import GOLD

_KEY = ["window_start", "window_end"]


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, matched by column name; a column an input lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def one_per_window(gold: DataFrame) -> DataFrame:
    """One row per window. Where copies differ, the fullest one stays.

    Fullest means most transactions, then the largest total, then the remaining columns in order,
    so the choice never depends on the order of files. The maximum of a struct combines map-side:
    any number of copies of one window shrinks to one row per task before the shuffle.
    """
    rest = [name for name in GOLD.fieldNames() if name not in _KEY]
    best = gold.groupBy(*_KEY).agg(F.max(F.struct(*rest)).alias("best"))
    return best.select(*_KEY, "best.*")


def snapshot(gold: DataFrame) -> DataFrame:
    """Gold without duplicate windows, oldest first."""
    return one_per_window(gold).orderBy("window_start")
