"""Work that stays balanced when one key holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUB_KEY = "__cardtide_sub_key"


def join_spread(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    copies: int = 4,
    how: str = "inner",
) -> DataFrame:
    """Join (``inner`` or ``left``) of many ``rows`` per key with at most one ``lookup`` row per key.

    Rows of one key are spread over ``copies`` sub-keys, and each lookup row is repeated for every
    one of them. In batch that also gives both sides an exchange of their own right below the join,
    which is what adaptive execution needs to split whatever sub-key is still too large; without it,
    a lookup that is itself an aggregate on the keys would switch that splitting off.
    """
    part = F.pmod(F.xxhash64(*spread_by), F.lit(copies)).cast("int")
    repeated = lookup.withColumn(_SUB_KEY, F.explode(F.array(*[F.lit(i) for i in range(copies)])))
    return rows.withColumn(_SUB_KEY, part).join(repeated, [*keys, _SUB_KEY], how).drop(_SUB_KEY)
