"""Connected components of an edge list, without gathering any component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardtide.llm.common import landed
from cardtide.operators.skew import join_spread

EDGE = "a long, b long"


def _least(directed: DataFrame) -> DataFrame:
    return directed.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))


def components(edges: DataFrame, copies: int = 8) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b: long) with the least node of its component.

    Alternating large-star and small-star rounds: each round is two aggregations that combine
    map-side and two joins spread over ``copies`` sub-keys, so that a hub with very many
    neighbours is nobody's single task. Each round is written to the shared folder; the loop ends
    when a round changes nothing. Null ends and loops are ignored; no edges give no rows.
    """
    ends = [f("a", "b").alias(name) for f, name in ((F.least, "a"), (F.greatest, "b"))]
    now = landed(edges.where("a is not null and b is not null and a <> b").select(*ends).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                now.select(F.col("a"), F.col("a"))
            ).distinct()
        before = state
        both = now.select(F.col("a").alias("x"), F.col("b").alias("y")).union(now.select("b", "a"))
        large = join_spread(both, _least(both), ["x"], ["y"], copies).where("y > x").select(
            F.col("m").alias("y"), F.col("y").alias("x")
        ).where("x <> y").distinct()
        # Every edge of ``large`` points from x down to y, so the neighbours of x up to x are its y.
        small = join_spread(large, _least(large), ["x"], ["y"], copies)
        now = landed(
            small.select(F.col("m").alias("a"), F.explode(F.array("x", "y")).alias("b")).where("a <> b").distinct(),
            "edges",
        )
