"""One card, one slice and one window holding a third of all rows, derived from the events table."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from cardtide.operators import detectors
from cardtide.operators.gold import windowed_gold
from cardtide.operators.skew import join_spread
from cardtide.session import settings
from cardtide.sources.events import as_transactions, read_events
from tests.conftest import TESTDATA

SF = f"{TESTDATA}/sf0.01"
N_COPIES = 12

# Small thresholds make these few rows look to the planner as terabytes do to the default ones.
AS_IF_LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "8k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Every row twelve times over; every third copy goes to one card, within one hour, half of it small."""
    copies = read_events(spark, SF).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(N_COPIES - 1))))
    is_hot = F.col("copy") % 3 == 0
    number = F.col("event_id") * N_COPIES + F.col("copy")
    hot_time = F.timestamp_micros(F.lit(1705708800000000) + (number * 7919) % F.lit(3600000000))
    rows = copies.select(
        number.alias("event_id"),
        F.when(is_hot, hot_time).otherwise(F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("ts"),
        F.when(is_hot, F.lit(7)).otherwise(F.col("user_id") + F.col("copy") * 1500).cast("bigint").alias("user_id"),
        "event_type",
        F.when(is_hot & (number % 2 == 0), F.lit(1.25)).otherwise(F.col("value")).alias("value"),
        "props",
    )
    folder = str(tmp_path_factory.mktemp("hot"))
    rows.repartition(8).write.parquet(f"{folder}/events.parquet")
    return folder


def as_written(frame, path):
    frame.write.parquet(path)
    return f"SELECT transaction_id FROM '{path}/*.parquet'"


def joins_on_parts(frame):
    """The joins of rows with summaries in the plan that ran; it is final after an action."""
    summed = frame.agg(F.sum(F.xxhash64(*frame.columns).cast("decimal(38,0)")))
    summed.collect()
    final = summed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "_sub_key" in line and "Join" in line]


def assert_balanced(frame):
    """No task has to read all rows of the hot card: split, or read where they lie."""
    (join,) = joins_on_parts(frame)
    assert "SortMergeJoin(skew=true)" in join or "BroadcastHashJoin" in join


def test_hot_key_of_a_spread_join_is_split(spark, hot):
    rows = as_transactions(read_events(spark, hot))
    lookup = rows.groupBy("card_id").agg(F.max("amount").alias("most"))
    with settings(spark, {**AS_IF_LARGE, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = join_spread(rows, lookup, ["card_id"], ["transaction_id"])
        assert joined.count() == 10_000 * N_COPIES
        (join,) = joins_on_parts(joined)
        assert "SortMergeJoin(skew=true)" in join


def test_hot_card_in_card_testing(spark, hot, tmp_path):
    with settings(spark, AS_IF_LARGE):
        found = detectors.card_testing(
            as_transactions(read_events(spark, hot)), min_count=3, within_seconds=3600
        )
        out = as_written(found, str(tmp_path / "o"))
        assert_balanced(found)
    wanted = f"""
        SELECT transaction_id FROM (
            SELECT CAST(event_id AS VARCHAR) AS transaction_id, COUNT(*) OVER (
                PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW
            ) AS n
            FROM '{hot}/events.parquet/*.parquet' WHERE value <= 5
        ) WHERE n >= 3"""
    compare(out, wanted)


def test_hot_card_in_impossible_travel(spark, hot, tmp_path):
    tx = as_transactions(read_events(spark, hot))
    with settings(spark, AS_IF_LARGE):
        found = detectors.impossible_travel(tx, within_seconds=600)
        out = as_written(found, str(tmp_path / "o"))
        assert_balanced(found)
    places = str(tmp_path / "places")
    tx.select("transaction_id", "card_id", "city", "event_time").write.parquet(places)
    # Latest earlier instant in another city, by one ordered pass per city.
    wanted = f"""
        WITH tx AS (FROM '{places}/*.parquet'),
        cities AS (SELECT DISTINCT city FROM tx),
        before AS (
            SELECT b.transaction_id, b.event_time, MAX(a.event_time) AS latest
            FROM tx b CROSS JOIN cities c
            ASOF JOIN tx a ON a.card_id = b.card_id AND a.city = c.city AND b.event_time > a.event_time
            WHERE c.city <> b.city
            GROUP BY ALL
        )
        SELECT transaction_id FROM before WHERE latest >= event_time - INTERVAL 10 MINUTE"""
    compare(out, wanted)


def compare(found, wanted):
    counts = f"""
        SELECT (SELECT COUNT(*) FROM ({found})), (SELECT COUNT(*) FROM ({wanted})),
               (SELECT COUNT(*) FROM (({found}) EXCEPT ALL ({wanted})))"""
    with duckdb.connect() as connection:
        n_found, n_wanted, extra = connection.execute(counts).fetchone()
    assert n_found == n_wanted > 0 and extra == 0


def test_hot_window_is_combined_before_the_shuffle(spark, hot):
    """However many rows a window holds, a task sends one row per window."""
    gold = windowed_gold(as_transactions(read_events(spark, hot)), "1 hour", minor_units=100)
    rows = gold.collect()
    assert sum(r.tx_count for r in rows) == 10_000 * N_COPIES
    assert max(r.tx_count for r in rows) >= 10_000 * N_COPIES / 3
