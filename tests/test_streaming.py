from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from cardtide.functions.codec import decode_payload
from cardtide.operators import detectors
from cardtide.operators.gold import windowed_gold, with_watermark
from cardtide.plans import catalog
from cardtide.schema import BRONZE, GOLD, EVENTS_TABLE
from cardtide.session import settings
from cardtide.sources.events import as_transactions, read_events, stage_batches, stream_batches, stream_events
from cardtide.sources.gold import load_gold
from cardtide.sources.transactions import FolderSource, KafkaSource, read_transactions
from cardtide.streaming.pipeline import run_pipeline
from cardtide.streaming.accounts import accounts, counting_in, counting_out
from cardtide.streaming.sinks import append_to_table, finish, publish, start_console, start_gold
from tests.conftest import TESTDATA
from tests.helpers import at, drop_file, event, utc

ONE_FILE = {"maxFilesPerTrigger": "1"}


def pipeline(spark, log, data, **options):
    return run_pipeline(
        spark, FolderSource(str(log), "text", ONE_FILE), str(data), available_now=True, state_partitions=2, **options
    )


def windows(spark, data):
    rows = load_gold(spark, f"{data}/gold").collect()
    return {utc(r.window_start): r.tx_count for r in rows}


def test_late_rows_and_window_closing(spark, tmp_path):
    log, data = tmp_path / "log", tmp_path / "data"
    batches = [
        ["00:00:10", "00:03:00"],
        ["00:00:30", "00:05:00"],  # 00:00:30 is late, but not by the watermark of the batch before
        ["00:00:40", "00:02:10", "00:05:10"],  # 00:00:40 is dropped
        ["00:02:20", "00:10:00", "00:05:00"],  # 00:02:20 is dropped
    ]
    for number, clocks in enumerate(batches):
        drop_file(log, number, [event(c) for c in clocks])
    bronze, gold = pipeline(spark, log, data)
    finish(bronze, gold)

    assert windows(spark, data) == {
        at("00:00:00"): 2, at("00:02:00"): 1, at("00:03:00"): 1, at("00:05:00"): 3,
    }
    dropped = sum(
        state["numRowsDroppedByWatermark"] for p in gold.recentProgress for state in p["stateOperators"]
    )
    assert dropped > 0
    # Bronze keeps every row, late ones too.
    assert spark.read.schema(BRONZE).parquet(f"{data}/bronze").count() == 10


def test_a_window_ending_at_the_watermark_is_given_out(spark, tmp_path):
    log, data = tmp_path / "log", tmp_path / "data"
    drop_file(log, 0, [event("00:00:30")])
    drop_file(log, 1, [event("00:02:59.999999")])
    finish(*pipeline(spark, log, data))
    assert windows(spark, data) == {}
    drop_file(log, 2, [event("00:03:00")])
    finish(*pipeline(spark, log, data))
    assert windows(spark, data) == {at("00:00:00"): 1}


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    log, data = tmp_path / "log", tmp_path / "data"
    drop_file(log, 0, [event("00:00:10"), "not json", event("00:05:00")])
    finish(*pipeline(spark, log, data))
    bronze = spark.read.schema(BRONZE).parquet(f"{data}/bronze")
    assert bronze.count() == 3 and len(windows(spark, data)) == 1

    finish(*pipeline(spark, log, data))  # nothing new
    assert spark.read.schema(BRONZE).parquet(f"{data}/bronze").count() == 3

    drop_file(log, 1, [event("00:09:00")])
    finish(*pipeline(spark, log, data))
    assert spark.read.schema(BRONZE).parquet(f"{data}/bronze").count() == 4
    assert windows(spark, data) == {at("00:00:00"): 1, at("00:05:00"): 1}


def given_out(query):
    return sum(progress["sink"]["numOutputRows"] for progress in query.recentProgress)


def test_queries_are_named_and_independent(spark, tmp_path):
    log, data = tmp_path / "log", tmp_path / "data"
    drop_file(log, 0, [event("00:00:10"), event("00:05:00")])
    queries = pipeline(spark, log, data, console=True)
    finish(*queries)
    assert [q.name for q in queries] == ["bronze_raw", "gold_windows", "gold_console"]
    assert sorted(os.listdir(data / "_checkpoints")) == ["bronze", "gold"]
    assert given_out(queries[2]) == 1


def test_the_job_ends_when_any_query_ends(spark, tmp_path):
    log = tmp_path / "log"
    drop_file(log, 0, [event("00:00:10")])
    queries = run_pipeline(spark, FolderSource(str(log), "text"), str(tmp_path / "data"))
    try:
        assert all(q.isActive for q in queries)
        queries[0].stop()
        assert spark.streams.awaitAnyTermination(30)
        assert queries[1].isActive
    finally:
        for query in queries:
            query.stop()
        spark.streams.resetTerminated()


def test_a_failure_is_raised(spark, tmp_path):
    log = tmp_path / "log"
    drop_file(log, 0, [event("00:00:10")])
    rows = decode_payload(read_transactions(spark, FolderSource(str(log), "text")))
    broken = rows.withColumn("amount", F.raise_error(F.lit("broken on purpose")).cast("double"))
    query = append_to_table(
        broken, str(tmp_path / "t"), str(tmp_path / "cp"), "broken", available_now=True
    )
    with pytest.raises(StreamingQueryException, match="broken on purpose"):
        finish(query)
    spark.streams.resetTerminated()


def test_bronze_by_date(spark, tmp_path):
    log, data = tmp_path / "log", tmp_path / "data"
    drop_file(log, 0, [event("00:00:10"), event("30:00:10"), "not json"])
    finish(*pipeline(spark, log, data, bronze_by_date=True))
    bronze = spark.read.parquet(f"{data}/bronze")
    assert bronze.count() == 3
    assert bronze.where("event_date = '2024-01-02'").count() == 1


def test_rocksdb_state_gives_the_same(spark, tmp_path):
    log = tmp_path / "log"
    drop_file(log, 0, [event("00:00:10"), event("00:01:10"), event("00:05:00")])
    for name, rocksdb in (("a", False), ("b", True)):
        finish(*pipeline(spark, log, tmp_path / name, rocksdb=rocksdb))
    assert windows(spark, tmp_path / "a") == windows(spark, tmp_path / "b") != {}


def test_session_settings_are_put_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    drop_file(tmp_path / "log", 0, [event("00:00:10")])
    finish(*pipeline(spark, tmp_path / "log", tmp_path / "data"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def closed(rows, delay="2 minutes"):
    newest = rows.agg(F.max("event_time")).first()[0]
    return F.lit(newest) - F.expr(f"INTERVAL {delay}")


@pytest.mark.parametrize("files", [1, 7])
def test_stream_equals_batch_on_closed_windows(spark, tmp_path, files):
    """However an in-order table is cut into files, one file per batch gives the batch result."""
    table = read_events(spark, f"{TESTDATA}/sf0.001").orderBy("ts").toPandas()
    step = -(-len(table) // files)
    for number in range(files):
        path = tmp_path / "in" / f"{number:03d}.parquet"
        os.makedirs(path.parent, exist_ok=True)
        table[number * step : (number + 1) * step].to_parquet(path, index=False, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + 10 * number,) * 2)
    events = read_events(spark, f"{TESTDATA}/sf0.001").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = as_transactions(events)
    reader = spark.readStream.schema(events.schema).options(**ONE_FILE)
    stream = with_watermark(as_transactions(reader.parquet(str(tmp_path / "in"))))

    finish(
        start_gold(
            windowed_gold(stream, minor_units=100), str(tmp_path / "gold"), str(tmp_path / "gold-cp"),
            available_now=True, state_partitions=2,
        )
    )
    streamed = spark.read.schema(GOLD).parquet(str(tmp_path / "gold"))
    wanted = windowed_gold(batch, minor_units=100).where(F.col("window_end") <= closed(batch))
    assert streamed.count() == wanted.count() == 987
    assert streamed.exceptAll(wanted).isEmpty()

    travel = {"within_seconds": 7200}
    finish(
        append_to_table(
            detectors.impossible_travel(stream, **travel), str(tmp_path / "travel"), str(tmp_path / "travel-cp"),
            "travel", available_now=True, state_partitions=2,
        )
    )
    flagged = detectors.impossible_travel(batch, **travel)
    streamed = spark.read.schema(flagged.schema).parquet(str(tmp_path / "travel"))
    slice_end = F.window("event_time", "2 hours")["end"]
    wanted = flagged.withColumn("slice_end", slice_end).where(F.col("slice_end") <= closed(batch)).drop("slice_end")
    assert streamed.count() == wanted.count() > 0
    assert streamed.exceptAll(wanted).isEmpty()


def test_a_backlog_in_batches_keeps_little_state(spark, tmp_path):
    """Twelve batches in the order of time: no state operator ever holds more than a part of the rows."""
    table = read_events(spark, f"{TESTDATA}/sf0.001")
    folder = str(tmp_path / "backlog")
    files = stage_batches(table, folder, batches=12)
    stream = with_watermark(as_transactions(stream_batches(spark, folder, files)))
    flagged = detectors.impossible_travel(stream, within_seconds=7200)
    query = append_to_table(
        flagged, str(tmp_path / "t"), str(tmp_path / "cp"), "bounded", available_now=True, state_partitions=2, rocksdb=True
    )
    finish(query)
    progress = query.recentProgress
    assert sum(p["numInputRows"] > 0 for p in progress) == 12
    held = [max((int(o["numRowsTotal"]) for o in p["stateOperators"]), default=0) for p in progress]
    assert 0 < max(held) < 0.4 * table.count()
    batch = as_transactions(table).withColumn("event_time", F.col("event_time").cast("timestamp"))
    wanted = detectors.impossible_travel(batch, within_seconds=7200)
    wanted = wanted.where(F.window("event_time", "2 hours")["end"] <= closed(batch))
    assert spark.read.schema(flagged.schema).parquet(str(tmp_path / "t")).count() == wanted.count()


def test_batches_hold_every_row_in_the_order_of_time(spark, tmp_path):
    table = read_events(spark, f"{TESTDATA}/sf0.001").withColumn("ts", F.when(F.col("event_id") != 7, F.col("ts")))
    files = stage_batches(table, str(tmp_path / "b"), batches=3, files=2, late=F.col("event_id") % 50 == 0)
    stored = spark.read.schema(EVENTS_TABLE).parquet(str(tmp_path / "b/backlog"))
    assert files == 2 and sorted(map(str, stored.collect())) == sorted(map(str, table.collect()))
    listed = stored.select("_metadata.file_path", "_metadata.file_modification_time", "ts", "event_id")
    last = {r.event_id for r in listed.collect() if r.event_id % 50 == 0}
    parts = listed.where("event_id % 50 <> 0").groupBy("file_path", "file_modification_time").agg(F.min("ts"), F.max("ts")).collect()
    by_age = sorted(parts, key=lambda r: r[1])
    assert len(last) == 20 and len(parts) == 6
    for i in (2, 4):
        assert max(r[3] for r in by_age[:i]) <= min(r[2] for r in by_age[i:])


def test_events_stream_from_a_folder_of_part_files(spark, tmp_path):
    table = read_events(spark, f"{TESTDATA}/sf0.001")
    table.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    rows = as_transactions(stream_events(spark, str(tmp_path), 1 << 30))
    finish(append_to_table(rows, str(tmp_path / "t"), str(tmp_path / "cp"), "copy", available_now=True))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_folder_of_keyed_parquet(spark, tmp_path):
    frame = spark.createDataFrame([(b"card_0001", event("00:00:10").encode())], "key BINARY, value BINARY")
    frame.write.parquet(str(tmp_path / "log"))
    rows = decode_payload(read_transactions(spark, FolderSource(str(tmp_path / "log"))))
    finish(append_to_table(rows, str(tmp_path / "t"), str(tmp_path / "cp"), "keyed", available_now=True))
    assert spark.read.schema(BRONZE).parquet(str(tmp_path / "t")).first().card_id == "card_0001"


def test_unknown_folder_format(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown folder format"):
        read_transactions(spark, FolderSource(str(tmp_path), "csv"))


def test_kafka_options():
    source = KafkaSource("host:9092", options={"maxOffsetsPerTrigger": "1000000"})
    assert source.reader_options() == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "transactions",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000000",
    }


def test_publishing_goes_to_the_broker_connector(spark):
    """The connector is not installed here, so this only shows that it is what is asked for."""
    with pytest.raises(AnalysisException, match="kafka"):
        publish(as_transactions(read_events(spark, f"{TESTDATA}/sf0.001")), "host:9092")
    with pytest.raises(AnalysisException, match="kafka"):
        read_transactions(spark, KafkaSource("host:9092"))


def test_console_needs_no_checkpoint(spark, tmp_path):
    drop_file(tmp_path / "log", 0, [event("00:00:10"), event("00:05:00")])
    rows = decode_payload(read_transactions(spark, FolderSource(str(tmp_path / "log"), "text")))
    for _ in range(2):  # it starts over each time
        query = start_console(windowed_gold(with_watermark(rows)), available_now=True, state_partitions=2)
        finish(query)
        assert given_out(query) == 1


def test_a_card_with_thousands_of_cities(spark, tmp_path):
    """No list of cities: what is held of a card and slice has the same size for 20,000 cities as for two."""
    begin = 1_704_067_200
    for name, cities in (("few", 2), ("many", 20_000)):
        rows = spark.range(20_000, numPartitions=1).select(
            F.col("id").cast("string").alias("transaction_id"), F.lit("card_0001").alias("card_id"),
            F.concat(F.lit("c"), (F.col("id") % cities).cast("string")).alias("city"),
            F.timestamp_micros(F.lit(begin * 10**6) + F.col("id") * 20_000).alias("event_time"),
        )
        rows.unionAll(rows.limit(1).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 DAY"))).write.parquet(str(tmp_path / name))
        stream = with_watermark(spark.readStream.schema(rows.schema).parquet(str(tmp_path / name)))
        found = detectors.impossible_travel(stream, within_seconds=600)
        finish(append_to_table(found, str(tmp_path / f"{name}-t"), str(tmp_path / f"{name}-cp"), name, available_now=True, state_partitions=2))
        out = spark.read.schema(found.schema).parquet(str(tmp_path / f"{name}-t"))
        assert out.count() == detectors.impossible_travel(rows, within_seconds=600).count() == 19_999
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "collect" not in plan and plan.count("Aggregate [card_id") == 2


def test_accounts_of_batches(spark, tmp_path):
    for i, lines in enumerate([["00:00:10", "00:05:00"], ["00:09:00"], ["00:00:30", "00:20:00"]]):
        drop_file(tmp_path / "log", i, [event(t) for t in lines] + [event("00:00:00", timestamp="?"), "{"][: i])
    rows = counting_in(decode_payload(read_transactions(spark, FolderSource(str(tmp_path / "log"), "text", {"maxFilesPerTrigger": "1"}))))
    gold = counting_out(windowed_gold(with_watermark(rows)))
    query = append_to_table(gold, str(tmp_path / "t"), str(tmp_path / "cp"), "told", available_now=True, state_partitions=2)
    finish(query)
    told = accounts(spark, query).orderBy("batch_id")
    found = [(r.rows_in, r.rejected) for r in told.where("rows_in > 0").collect()]
    assert found == [(2, 0), (2, 1), (4, 2)]
    total = told.agg(F.sum("windows_out"), F.sum("rows_out"), F.max("state_rows")).first()
    stored = spark.read.schema(gold.schema).parquet(str(tmp_path / "t"))
    assert (total[0], total[1]) == (stored.count(), stored.agg(F.sum("tx_count")).first()[0]) == (3, 3) and total[2] >= 2
    assert {r.query for r in told.collect()} == {"told"} and told.where("watermark is not null").count() > 0


def test_staged_files_follow_time(spark, tmp_path):
    """Written once, as many files as cores would take, each a stretch of time."""
    table = read_events(spark, f"{TESTDATA}/sf0.001")
    assert stage_batches(table, str(tmp_path / "a"), rows_per_file=100) == min(4, spark.sparkContext.defaultParallelism, 1000 // 4 // 100)
    assert stage_batches(table, str(tmp_path / "b"), rows_per_batch=100, rows_per_file=10) == 4
    for folder, n in (("a", 8), ("b", 40)):
        stored = spark.read.schema(EVENTS_TABLE).parquet(str(tmp_path / folder / "backlog"))
        by_age = stored.groupBy("_metadata.file_path", "_metadata.file_modification_time").agg(F.min("ts"), F.max("ts")).collect()
        by_age = sorted(by_age, key=lambda r: r[1])
        assert stored.count() == 1000 and len(by_age) == n
        assert all(a[3] <= b[2] for a, b in zip(by_age, by_age[1:]))
    assert stage_batches(table.limit(0), str(tmp_path / "c")) == 1


def test_state_has_no_more_partitions_than_cores_can_use(spark):
    cores = spark.sparkContext.defaultParallelism
    for asked, given in (("200", 2 * cores), ("3", 3)):
        with settings(spark, {"spark.sql.shuffle.partitions": asked}):
            assert catalog._state_partitions(spark) == given


def test_the_travel_stream_leaves_the_heap_only_where_slices_outgrow_batches(spark, monkeypatch):
    sf_dir, started = f"{TESTDATA}/sf0.001", []
    landing = catalog.append_to_table
    monkeypatch.setattr(catalog, "append_to_table", lambda *a, **k: started.append(k["rocksdb"]) or landing(*a, **k))
    found = [sorted(map(str, catalog.stream_impossible_travel(spark, sf_dir).collect()))]
    monkeypatch.setattr(catalog, "_slices_fit", lambda *a: False)
    found.append(sorted(map(str, catalog.stream_impossible_travel(spark, sf_dir).collect())))
    assert started == [False, True] and found[0] == found[1]


def test_crowded_slices_are_told(spark):
    times = [at("00:10:00"), at("01:20:00"), at("01:59:59"), at("02:00:00"), None]
    events = spark.createDataFrame([(t,) for t in times], "ts timestamp")
    assert catalog._slices_fit(events, 7200, 6) and not catalog._slices_fit(events, 7200, 5)
    assert catalog._slices_fit(events.limit(0), 7200, 0)
