from __future__ import annotations

from datetime import timedelta

import numpy as np
import pytest

from cardtide.functions.money import as_count, as_dollars, as_percent, round_half_even
from cardtide.operators import panels
from cardtide.schema import GOLD, RECENT_HEADINGS
from tests.helpers import at, gold_rows, utc


def with_frauds(spark, counts):
    rows = [
        (at("00:00:00") + timedelta(minutes=i), at("00:01:00") + timedelta(minutes=i), 100, 5.0, 0.05, n, 0, 0, n)
        for i, n in enumerate(counts)
    ]
    return spark.createDataFrame(rows, GOLD)


def test_kpis(spark):
    row = panels.kpi_summary(with_frauds(spark, [5, 10])).first()
    assert row.asDict() == {
        "n_windows": 2, "total_tx": 200, "total_fraud": 15, "fraud_rate_pct": 7.5, "total_amount": 10.0,
    }


@pytest.mark.parametrize("rows", [[], [("00:00:00", 0, 0.0)]])
def test_kpis_without_transactions(spark, rows):
    row = panels.kpi_summary(gold_rows(spark, rows)).first()
    assert (row.total_tx, row.total_fraud, row.fraud_rate_pct, row.total_amount) == (0, 0, 0.0, 0.0)


def test_kpi_text(spark):
    kpis = spark.createDataFrame(
        [(3, 1234567, 1000, 6.25, 496306.57)],
        "n_windows BIGINT, total_tx BIGINT, total_fraud BIGINT, fraud_rate_pct DOUBLE, total_amount DOUBLE",
    )
    assert tuple(panels.display_kpis(kpis).first()) == ("1,234,567", "1,000", "6.2%", "$496,307")


def test_number_text_equals_python(spark):
    values = [0.0, 0.5, 1.5, 2.5, 0.25, 0.35, 6.07, 999.995, 1234567.125, -5.5, 0.125]
    frame = spark.createDataFrame([(v,) for v in values], "x DOUBLE").select(
        "x", as_dollars("x", 0).alias("d0"), as_dollars("x", 2).alias("d2")
    )
    for row in frame.collect():
        assert row.d0 == f"${row.x:,.0f}" and row.d2 == f"${row.x:,.2f}"
    rates = spark.createDataFrame([(v,) for v in values if 0 <= v <= 100], "x DOUBLE")
    for row in rates.select("x", as_percent("x").alias("p")).collect():
        assert row.p == f"{row.x:.1f}%"
    counts = spark.createDataFrame([(n,) for n in (0, 999, 1000, 12345678)], "x BIGINT")
    for row in counts.select("x", as_count("x").alias("c")).collect():
        assert row.c == f"{row.x:,}"


def test_rounding_equals_numpy(spark):
    values = [float(v) for v in np.random.default_rng(5).uniform(0, 1000, 2000)]
    values += [0.125, 0.375, 2.675, 1.005, -0.125]
    frame = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    for row in frame.select("x", round_half_even("x").alias("r")).collect():
        assert row.r == np.round(row.x, 2)


def test_recent_windows_are_the_last_twelve_newest_first(spark):
    gold = with_frauds(spark, range(20)).orderBy("fraud_total", ascending=True)
    rows = panels.recent_windows(gold).collect()
    assert [utc(r.window_start) for r in rows] == [at("00:00:00") + timedelta(minutes=i) for i in range(19, 7, -1)]


def test_recent_display(spark):
    shown = panels.display_recent(panels.recent_windows(gold_rows(spark, [("00:00:00", 1500, 123456.785)])))
    assert shown.columns == list(RECENT_HEADINGS.values())
    row = shown.first()
    assert (row["Tx"], row["Total $"], row["Avg $"]) == ("1,500", "$123,457", "$82.30")


def test_severity_limits(spark):
    rows = panels.window_alerts(with_frauds(spark, [19, 20, 39, 40])).orderBy("window_start").collect()
    assert [r.severity for r in rows] == ["", "amber", "amber", "red"]
    raised = panels.window_alerts(with_frauds(spark, [19, 40]), red_at=50, amber_at=10).orderBy("window_start")
    assert [r.severity for r in raised.collect()] == ["amber", "amber"]


def test_fraud_series(spark):
    gold = spark.createDataFrame([(at("00:00:00"), at("00:01:00"), 9, 1.0, 1.0, 1, 2, 3, 6)], GOLD)
    rows = [(r.fraud_type, r.n) for r in panels.fraud_by_type(gold).collect()]
    assert rows == [("card_testing", 2), ("high_amount", 1), ("impossible_travel", 3)]


def test_throughput_is_in_time_order(spark):
    gold = gold_rows(spark, [("00:03:00", 3, 1.0), ("00:01:00", 1, 1.0), ("00:02:00", 2, 1.0)])
    assert [r.tx_count for r in panels.throughput_series(gold).collect()] == [1, 2, 3]
