from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardtide.functions.money import money_sum
from cardtide.operators.gold import windowed_gold
from cardtide.schema import GOLD
from cardtide.sources.events import as_transactions, read_events
from tests.conftest import TESTDATA
from tests.helpers import at, transactions, utc


def gold_of(spark, rows, **options):
    return sorted(windowed_gold(transactions(spark, rows), **options).collect())


def test_schema(spark):
    produced = windowed_gold(transactions(spark, []))
    assert [(f.name, f.dataType) for f in produced.schema] == [(f.name, f.dataType) for f in GOLD]


def test_window_edges(spark):
    rows = gold_of(spark, [{"event_time": at(t)} for t in ("00:00:00", "00:00:59.999", "00:01:00")])
    assert [(utc(r.window_start), utc(r.window_end), r.tx_count) for r in rows] == [
        (at("00:00:00"), at("00:01:00"), 2),
        (at("00:01:00"), at("00:02:00"), 1),
    ]


def test_empty_minutes_have_no_row(spark):
    rows = gold_of(spark, [{"event_time": at(t)} for t in ("00:00:10", "00:05:10")])
    assert len(rows) == 2


@pytest.mark.parametrize("minor_units", [None, 100])
def test_missing_amounts(spark, minor_units):
    rows = gold_of(
        spark,
        [
            {"event_time": at("00:00:01"), "amount": 10.0},
            {"event_time": at("00:00:02"), "amount": None},
            {"event_time": at("00:00:03"), "amount": 20.0},
            {"event_time": at("00:01:01"), "amount": None},
        ],
        minor_units=minor_units,
    )
    assert [(r.tx_count, r.total_amount, r.avg_amount) for r in rows] == [(3, 30.0, 15.0), (1, None, None)]


def test_labels_are_counted_independently(spark):
    (row,) = gold_of(
        spark,
        [
            {"event_time": at("00:00:01"), "is_fraud": True, "fraud_type": None},
            {"event_time": at("00:00:02"), "is_fraud": False, "fraud_type": "high_amount"},
            {"event_time": at("00:00:03"), "is_fraud": True, "fraud_type": "something new"},
            {"event_time": at("00:00:04"), "is_fraud": None, "fraud_type": "card_testing"},
            {"event_time": at("00:00:05"), "is_fraud": True, "fraud_type": "impossible_travel"},
        ],
    )
    assert (row.fraud_high_amount, row.fraud_card_testing, row.fraud_impossible_travel, row.fraud_total) == (1, 1, 1, 3)


def test_exact_sums_do_not_depend_on_order_or_partitioning(spark):
    amounts = [0.1, 0.2, 0.3, 1e9, 0.7, 123456.78, 0.01] * 300
    random.Random(1).shuffle(amounts)
    frame = transactions(spark, [{"event_time": at("00:00:01"), "amount": a} for a in amounts])
    exact = sum(round(a * 100) for a in amounts) / 100
    totals = {
        windowed_gold(frame.repartition(n), minor_units=100).first().total_amount for n in (1, 3, 7)
    }
    assert totals == {exact}


def test_absurd_amounts_do_not_stop_the_job(spark):
    rows = [{"event_time": at("00:00:01"), "amount": a} for a in (1e300, 1.0)]
    (row,) = gold_of(spark, rows, minor_units=100)
    assert row.tx_count == 2 and row.total_amount == pytest.approx(1e300)


def test_permuted_input_gives_the_same_gold(spark):
    tx = as_transactions(read_events(spark, f"{TESTDATA}/sf0.001"))
    straight = windowed_gold(tx, minor_units=100)
    shuffled = windowed_gold(tx.orderBy(F.rand(3)), minor_units=100)
    assert straight.exceptAll(shuffled).isEmpty() and shuffled.exceptAll(straight).isEmpty()


def test_counts_add_up(spark):
    tx = as_transactions(read_events(spark, f"{TESTDATA}/sf0.01"))
    for duration, windows in (("1 minute", 8961), ("1 hour", 720), ("1 day", 30)):
        row = windowed_gold(tx, duration).agg(F.sum("tx_count").alias("n"), F.count("*").alias("w")).first()
        assert (row.n, row.w) == (10_000, windows)


@pytest.mark.parametrize("big", [1e12, 9.1e13])
def test_exact_sums_do_not_depend_on_the_order(spark, big):
    """Beyond 2^53 cents in all, and with an amount that does not fit the exact form."""
    amounts = [big + i / 100 for i in range(1000)] + [0.01] * 1000
    exact = float(sum(Decimal(str(round(a, 2))) for a in amounts))
    for order in (amounts, amounts[::-1], sorted(amounts, key=lambda a: a % 7)):
        rows = spark.createDataFrame([(a,) for a in order], "amount double").repartition(7)
        assert rows.agg(money_sum("amount", 100)).first()[0] == exact
    with_absurd = spark.createDataFrame([(1e300,), (1.25,), (None,)], "amount double")
    assert with_absurd.agg(money_sum("amount", 100)).first()[0] == 1e300
    assert spark.createDataFrame([(None,)], "amount double").agg(money_sum("amount", 100)).first()[0] is None
    odd = spark.createDataFrame([(float("inf"),), (1.0,)], "amount double")
    assert odd.agg(money_sum("amount", 100)).first()[0] == float("inf")
