"""Every registered query against its SQL, and the plans of those that matter at scale."""

from __future__ import annotations

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from cardtide.operators import detectors
from cardtide.operators.gold import windowed_gold
from cardtide.plans.catalog import QUERIES
from cardtide.plans.oracle import ORACLE
from cardtide.session import settings
from cardtide.sources.events import as_transactions, read_events
from tests.conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("key", QUERIES)
def test_query_equals_sql(spark, oracle, key):
    frame = entry.queries()[key](spark, SF)
    columns = sorted(frame.columns)
    cursor = oracle.execute(entry.oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    wanted = [tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall()]
    found = [tuple(plain(row[c]) for c in columns) for row in frame.collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_ordered_results(spark):
    starts = [r.window_start for r in entry.queries()["throughput_series"](spark, SF).collect()]
    assert starts == sorted(starts)
    recent = [r.window_start for r in entry.queries()["recent_windows"](spark, SF).collect()]
    assert recent == sorted(recent, reverse=True) and len(recent) == 12


def test_flagship(spark):
    assert entry.entry(spark).count() == 988


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# The ones that need only build a plan; the others run streams or write tables first.
PLANNED = ["decode_payload", "encode_payload", "gold_1m", "kpi_summary", "fraud_by_type", "recent_windows",
           "window_alerts", "category_norms", "detect_high_amount", "detect_card_testing",
           "detect_impossible_travel", "card_home_city", "detector_confusion"]


@pytest.mark.parametrize("key", PLANNED)
def test_no_python_and_no_cross_join(spark, key):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(entry.queries()[key](spark, SF))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_gold_scans_what_it_needs_and_combines_before_the_shuffle(spark):
    text = plan(entry.queries()["gold_1m"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts)]" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "partial_sum" in text.split("Exchange")[1]


def test_counting_only_reads_the_time_column(spark):
    counted = windowed_gold(as_transactions(read_events(spark, SF))).select("window_start", "tx_count")
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan(counted)


def test_latest_windows_need_no_full_sort(spark):
    text = plan(entry.queries()["recent_windows"](spark, SF))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_small_norms_are_broadcast_by_their_known_size(spark):
    assert "BroadcastHashJoin" in plan(entry.queries()["detect_high_amount"](spark, SF))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert "SortMergeJoin" in plan(entry.queries()["detect_high_amount"](spark, SF))


SLICED = {
    "card_testing": lambda tx: detectors.card_testing(tx, min_count=2),
    "impossible_travel": lambda tx: detectors.impossible_travel(tx),
}


@pytest.mark.parametrize("name", SLICED)
def test_detectors_scan_twice_and_run_no_job_while_built(spark, name):
    tx = as_transactions(read_events(spark, SF))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"built-{name}", "nothing runs while a detector is built")
    found = SLICED[name](tx)
    assert not tracker.getJobIdsForGroup(f"built-{name}")
    assert plan(found).count("FileScan") <= 2


def test_confusion_reads_the_rows_three_times(spark):
    """For themselves and for two summaries; the norms are a small table of their own by then."""
    text = plan(entry.queries()["detector_confusion"](spark, SF))
    assert len(re.findall(r"FileScan.*events", text)) == 3


def test_headlines_need_no_sort(spark):
    assert "rangepartitioning" not in plan(entry.queries()["kpi_summary"](spark, SF))


def test_card_testing_limits_groups_before_the_shuffle(spark):
    text = plan(SLICED["card_testing"](as_transactions(read_events(spark, SF))))
    assert text.count("row_number(), 2, Partial") == 1
    assert "LessThanOrEqual(value,5.0)" in text


@pytest.mark.parametrize("name", SLICED)
def test_a_hot_key_can_be_split_by_adaptive_execution(spark, name):
    """Both sides of the join must be an exchange and a sort, nothing else."""
    tx = as_transactions(read_events(spark, SF))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        lines = plan(SLICED[name](tx)).splitlines()
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line and "_sub_key" in line]
    assert len(joins) == 1
    depth = lines[joins[0]].index("SortMergeJoin")
    children = [i for i in range(joins[0] + 1, len(lines)) if lines[i][depth : depth + 3] in (":- ", "+- ")][:2]
    for child in children:
        assert "Sort [card_id" in lines[child]
        assert "Exchange hashpartitioning(card_id" in lines[child + 1] and "_sub_key" in lines[child + 1]
