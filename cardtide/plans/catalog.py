"""Every operator as a named query over the ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardtide.functions.codec import decode_payload, encode_payload
from cardtide.operators import detectors, panels, quantiles, thresholds
from cardtide.operators.gold import GOLD_INPUT, windowed_gold, with_watermark
from cardtide.operators.rollup import refresh, roll_up
from cardtide.operators.snapshot import one_per_window, union_by_name
from cardtide.operators.statistics import STATISTICS, as_gold, window_statistics
from cardtide.schema import BRONZE, FRAUD_TYPES, GOLD, GOLD_DIR, PAYLOAD, RECENT_WINDOWS
from cardtide.session import configure, scratch_dir
from cardtide.sources.dated import DATE, landed, latest, read_dates, with_date, write_by_date
from cardtide.sources.events import as_transactions, read_events, stage_batches, stream_batches
from cardtide.sources.gold import load_gold
from cardtide.sources.transactions import FolderSource
from cardtide.streaming.accounts import accounts, counting_in, counting_out
from cardtide.streaming.pipeline import run_pipeline
from cardtide.streaming.reconcile import reconcile, stored_statistics
from cardtide.streaming.sinks import append_to_table, export_changed, export_snapshot, finish, start_bronze, start_gold

CENTS = 100

# Parameters chosen for the density of the table: about one row per card every five hours.
HIGH_AMOUNT = {"min_amount": 0.0, "factor": 5.0}
CARD_TESTING = {"min_count": 2, "within_seconds": 86_400}
TRAVEL = {"within_seconds": 7_200}
# A row is held three times, in some 600 bytes each, and in two versions: 400 MB a core with the rows of open slices.
TRAVEL_ROWS_PER_CORE = 100_000
QUANTILES = (0.5, 0.9, 0.99)

DETECTED = ("transaction_id", "card_id", "event_time", "amount", "category", "city")


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(read_events(configure(spark), sf_dir))


def _stream(spark: SparkSession, sf_dir: str, late: Column | None = None, **staging: int) -> DataFrame:
    """The table as a stream of several micro-batches, each of a stretch of time (see ``stage_batches``, which takes ``staging``).

    With late rows there are 4 batches and the late one, on which what is too late depends.
    """
    configure(spark)
    folder = scratch_dir(spark, "batches")
    files = stage_batches(read_events(spark, sf_dir), folder, late=late, batches=None if late is None else 4, **staging)
    return as_transactions(stream_batches(spark, folder, files))


def _gold(spark: SparkSession, sf_dir: str, duration: str) -> DataFrame:
    return windowed_gold(_transactions(spark, sf_dir), duration, minor_units=CENTS)


def _plain(rows: DataFrame) -> DataFrame:
    """Instants without a zone, as the table has them."""
    return rows.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in rows.schema if f.dataType.typeName() == "timestamp"}
    )


def _state_partitions(spark: SparkSession) -> int:
    """State of the registered streams is fixed for their one run: as many partitions as the session shuffles to.

    But no more than two for each core, as every batch opens and commits all stores of every partition.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def _slices_fit(events: DataFrame, seconds: int, rows: int) -> bool:
    """Whether two slices, as many as can be open behind a batch, hold no more than ``rows`` rows wherever they lie."""
    busiest = events.groupBy(F.window("ts", f"{seconds} seconds")).count().agg(F.max("count")).first()[0]
    return 2 * (busiest or 0) <= rows


def _streamed(spark: SparkSession, rows: DataFrame, name: str, rocksdb: bool = False) -> DataFrame:
    """Run a bounded stream into a table of its own and read the table."""
    root = scratch_dir(spark, name)
    finish(
        append_to_table(
            rows,
            f"{root}/table",
            f"{root}/checkpoint",
            name,
            available_now=True,
            state_partitions=_state_partitions(spark),
            rocksdb=rocksdb,
        )
    )
    return _plain(spark.read.schema(rows.schema).parquet(f"{root}/table"))


# -- decoding and landing ----------------------------------------------------------------------


def decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(decode_payload(encode_payload(_transactions(spark, sf_dir))))


def encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = encode_payload(_transactions(spark, sf_dir))
    names = PAYLOAD.fieldNames()
    fields = F.json_tuple(F.col("value").cast("string"), *names).alias(*names)
    # Text of a DOUBLE is not portable, its value is.
    return events.select(F.col("key").cast("string").alias("key"), fields).withColumn(
        "amount", F.col("amount").cast("double")
    )


def bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "bronze")
    transactions = decode_payload(encode_payload(_stream(spark, sf_dir)))
    finish(start_bronze(transactions, f"{root}/table", f"{root}/checkpoint", available_now=True))
    return _plain(spark.read.schema(BRONZE).parquet(f"{root}/table"))


def stream_gold_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "gold")
    transactions = decode_payload(encode_payload(_stream(spark, sf_dir)), GOLD_INPUT)
    finish(
        start_gold(
            windowed_gold(with_watermark(transactions), minor_units=CENTS),
            f"{root}/table",
            f"{root}/checkpoint",
            available_now=True,
            state_partitions=_state_partitions(spark),
        )
    )
    return _plain(spark.read.schema(GOLD).parquet(f"{root}/table"))


def replayed_gold_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table recorded as keyed events in a folder, then the whole job over that folder, some files at a time."""
    root = scratch_dir(spark, "replay")
    files = stage_batches(_transactions(spark, sf_dir), root, time="event_time", then=encode_payload)
    finish(
        *run_pipeline(
            spark,
            FolderSource(f"{root}/backlog", options={"maxFilesPerTrigger": str(files)}),
            f"{root}/data",
            available_now=True,
            state_partitions=_state_partitions(spark),
            minor_units=CENTS,
        )
    )
    return _plain(load_gold(spark, f"{root}/data/{GOLD_DIR}"))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of a stream whose last batch brings every 50th row, most of them behind the watermark by then."""
    transactions = _stream(spark, sf_dir, late=F.col("event_id") % 50 == 0)
    return _streamed(spark, windowed_gold(with_watermark(transactions), minor_units=CENTS), "stream_late_rows")


def late_rows_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same late rows, landed in Bronze, then put right: the stored windows with their corrections."""
    root = scratch_dir(spark, "corrected")
    configure(spark)
    files = stage_batches(read_events(spark, sf_dir), root, late=F.col("event_id") % 50 == 0, batches=4)
    transactions = decode_payload(encode_payload(as_transactions(stream_batches(spark, root, files))))
    finish(
        start_bronze(transactions, f"{root}/bronze", f"{root}/checkpoints/bronze", available_now=True, by_date=True),
        append_to_table(
            with_date(window_statistics(with_watermark(transactions))),
            f"{root}/windows",
            f"{root}/checkpoints/windows",
            "late_rows_corrected",
            available_now=True,
            state_partitions=_state_partitions(spark),
            partition_by=DATE,
        ),
    )
    reconcile(spark, f"{root}/bronze", f"{root}/windows", f"{root}/corrections")
    return _plain(as_gold(stored_statistics(spark, f"{root}/windows", f"{root}/corrections")))


def stream_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of ``stream_late_rows`` took in and gave out, added up."""
    root = scratch_dir(spark, "accounts")
    transactions = counting_in(_stream(spark, sf_dir, late=F.col("event_id") % 50 == 0))
    gold = counting_out(windowed_gold(with_watermark(transactions), minor_units=CENTS))
    query = append_to_table(
        gold, f"{root}/table", f"{root}/checkpoint", "stream_accounts", available_now=True, state_partitions=_state_partitions(spark)
    )
    finish(query)
    sums = landed(accounts(spark, query), "accounts").agg(*[F.sum(c).alias(c) for c in ("rows_in", "rejected", "windows_out", "rows_out")])
    return sums.withColumn("late_or_open", F.col("rows_in") - F.col("rejected") - F.col("rows_out"))


# -- Gold and what is read from it -------------------------------------------------------------


def gold_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "1 minute")


def gold_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "1 hour")


def gold_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "1 day")


def gold_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two disjoint parts that together are all of Gold; the earlier one lacks a column."""
    transactions = _transactions(spark, sf_dir)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")

    def part(rows: DataFrame) -> DataFrame:
        return windowed_gold(rows, minor_units=CENTS)

    earlier = part(transactions.where(F.col("event_time") < cut)).drop("avg_amount")
    later = part(transactions.where(F.col("event_time") >= cut))
    return union_by_name(later, earlier)


def gold_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Gold folder holding every window twice, consolidated and read back through the fallback."""
    root = scratch_dir(spark, "snapshot")
    gold = gold_1m(spark, sf_dir)
    stored = gold.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})
    stored.write.parquet(f"{root}/once")
    once = spark.read.schema(GOLD).parquet(f"{root}/once")
    once.unionByName(once).write.parquet(f"{root}/gold")
    export_snapshot(spark, f"{root}/gold", f"{root}/sample")
    return _plain(load_gold(spark, f"{root}/none", f"{root}/sample"))


def _instants(gold: DataFrame) -> DataFrame:
    return gold.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})


def gold_1h_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from stored minutes."""
    return _plain(as_gold(_rolled(spark, sf_dir, "1 hour")))


def gold_1d_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from stored hours, which are made from stored minutes."""
    return _plain(as_gold(_rolled(spark, sf_dir, "1 hour", "1 day")))


def _rolled(spark: SparkSession, sf_dir: str, *durations: str) -> DataFrame:
    root = scratch_dir(spark, "rolled")
    write_by_date(window_statistics(_instant_rows(spark, sf_dir)), f"{root}/0")
    for i, duration in enumerate(durations):
        roll_up(spark, f"{root}/{i}", f"{root}/{i + 1}", duration)
    return read_dates(spark, f"{root}/{len(durations)}", STATISTICS)


def _instant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transactions(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))


def gold_1h_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours rolled up without some rows of the first days, whose minutes are added then: only their hours are made again."""
    root = scratch_dir(spark, "refreshed")
    transactions = _instant_rows(spark, sf_dir)
    later = (F.col("transaction_id").cast("long") % 50 == 0) & (F.col("event_time") < F.lit("2024-01-05").cast("timestamp"))
    write_by_date(window_statistics(transactions.where(~later)), f"{root}/minutes")
    roll_up(spark, f"{root}/minutes", f"{root}/hours", "1 hour")
    added = landed(window_statistics(transactions.where(later)), "added")
    write_by_date(added, f"{root}/minutes")
    refresh(spark, f"{root}/minutes", f"{root}/hours", "1 hour", added)
    return _plain(as_gold(read_dates(spark, f"{root}/hours", STATISTICS)))


def gold_export_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot exported, and brought up to date after Gold has grown."""
    root = scratch_dir(spark, "export")
    gold = landed(_instants(gold_1m(spark, sf_dir)), "gold")
    recent = F.col("window_start") >= F.lit("2024-01-25").cast("timestamp")
    for part in (gold.where(~recent), gold.where(recent)):
        write_by_date(part, f"{root}/gold")
        export_changed(spark, f"{root}/gold", f"{root}/sample")
    return _plain(load_gold(spark, f"{root}/none", f"{root}/sample"))


def _stored_gold(spark: SparkSession, sf_dir: str, duration: str) -> DataFrame:
    """Gold as the panels meet it: stored, and loaded from its folder."""
    path = scratch_dir(spark, "stored-gold")
    _instants(_gold(spark, sf_dir, duration)).write.parquet(path)
    return _plain(load_gold(configure(spark), path))


def gold_1m_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default sums, of doubles, whose last digits depend on the order: rounded here, as in the SQL."""
    gold = windowed_gold(_transactions(spark, sf_dir))
    return gold.withColumns({c: F.round(F.col(c), 7) for c in ("total_amount", "avg_amount")})


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.kpi_summary(_stored_gold(spark, sf_dir, "1 minute"), minor_units=CENTS)


def kpi_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.display_kpis(kpi_summary(spark, sf_dir))


def throughput_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.throughput_series(_stored_gold(spark, sf_dir, "1 minute"))


def fraud_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.fraud_by_type(_stored_gold(spark, sf_dir, "1 hour"))


def recent_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold stored by date, of which only the newest folders are read."""
    path = scratch_dir(spark, "dated-gold")
    write_by_date(_instants(_gold(spark, sf_dir, "1 hour")), path)
    return _plain(panels.recent_windows(one_per_window(latest(spark, path, GOLD, RECENT_WINDOWS))))


def recent_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.display_recent(recent_windows(spark, sf_dir))


def window_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.window_alerts(_stored_gold(spark, sf_dir, "1 day"))


# -- detectors ---------------------------------------------------------------------------------


def _norms(spark: SparkSession, transactions: DataFrame) -> DataFrame:
    norms = detectors.category_norms(transactions, HIGH_AMOUNT["min_amount"])
    return detectors.save_norms(norms, scratch_dir(spark, "norms"))


def _high_amounts(spark: SparkSession, transactions: DataFrame, norms: DataFrame) -> DataFrame:
    return detectors.high_amounts(transactions, norms, HIGH_AMOUNT["factor"])


def category_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.category_norms(_transactions(spark, sf_dir), HIGH_AMOUNT["min_amount"])


def detect_high_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = _transactions(spark, sf_dir)
    return _high_amounts(spark, transactions, _norms(spark, transactions)).select(*DETECTED)


def detect_high_amount_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts judged by the norms that were known on their day: those of all days before it."""
    transactions = _transactions(spark, sf_dir)
    versions = landed(detectors.norm_versions(transactions, HIGH_AMOUNT["min_amount"]), "norm-versions")
    return detectors.high_amounts_in_force(transactions, versions, HIGH_AMOUNT["factor"]).select(*DETECTED)


def high_amount_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well each factor of the norm would find the rows that are labelled so."""
    transactions = _transactions(spark, sf_dir)
    scored = detectors.amount_factors(transactions, _norms(spark, transactions))
    return thresholds.scores_by_threshold(scored.withColumn("hit", F.col("fraud_type") == "high_amount"), "factor", "hit")


def category_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the amounts from sketches per category and day; and whether their ranks, counted exactly, are within the stated error."""
    transactions = _transactions(spark, sf_dir)
    sketches = landed(quantiles.quantile_sketches(transactions, HIGH_AMOUNT["min_amount"]), "sketches")
    norms = landed(quantiles.quantile_norms(sketches, QUANTILES), "quantile-norms")
    errors = quantiles.rank_errors(transactions, norms, HIGH_AMOUNT["min_amount"])
    return errors.select("category", "n", "quantile", (F.col("error") <= quantiles.RANK_ERROR).alias("within"))


def detect_card_testing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.card_testing(_transactions(spark, sf_dir), **CARD_TESTING).select(*DETECTED)


def detect_impossible_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.impossible_travel(_transactions(spark, sf_dir), **TRAVEL).select(*DETECTED)


def card_home_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.card_home_city(_transactions(spark, sf_dir))


def card_home_city_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.card_home_city_of_many(_transactions(spark, sf_dir))


def detector_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = _transactions(spark, sf_dir)
    flagged = detectors.detector_flags(
        transactions,
        _norms(spark, transactions),
        factor=HIGH_AMOUNT["factor"],
        min_count=CARD_TESTING["min_count"],
        testing_seconds=CARD_TESTING["within_seconds"],
        travel_seconds=TRAVEL["within_seconds"],
    )
    return detectors.detector_confusion(flagged, FRAUD_TYPES)


def stream_high_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    norms = _norms(spark, _transactions(spark, sf_dir))
    rows = _high_amounts(spark, _stream(spark, sf_dir), norms).select(*DETECTED)
    return _streamed(spark, rows, "stream_high_amount")


def stream_probe_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    charges = with_watermark(detectors.small_charges(_stream(spark, sf_dir)))
    sessions = detectors.probe_sessions(
        charges, min_count=CARD_TESTING["min_count"], gap_seconds=CARD_TESTING["within_seconds"]
    )
    return _streamed(spark, sessions, "stream_probe_sessions")


def stream_card_testing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows land in Bronze, the stream keeps the edges of slices alone, and closed slices meet their rows again."""
    root = scratch_dir(spark, "card-testing")
    configure(spark)
    files = stage_batches(read_events(spark, sf_dir), root)
    transactions = as_transactions(stream_batches(spark, root, files))
    charges = detectors.small_charges(with_watermark(transactions))
    edges = detectors.probe_edges(charges, **CARD_TESTING)
    finish(
        start_bronze(transactions, f"{root}/bronze", f"{root}/checkpoints/bronze", available_now=True, by_date=True),
        append_to_table(
            edges, f"{root}/edges", f"{root}/checkpoints/edges", "stream_card_testing", available_now=True, state_partitions=_state_partitions(spark)
        ),
    )
    landed_rows = spark.read.schema(transactions.schema).parquet(f"{root}/bronze")
    stored = spark.read.schema(edges.schema).parquet(f"{root}/edges")
    return _plain(detectors.card_testing_from(landed_rows, stored, **CARD_TESTING).select(*DETECTED))


def stream_impossible_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State holds the rows of a batch and of open slices. The first are limited here, so that they fit into the heap; the others need not."""
    in_batch = TRAVEL_ROWS_PER_CORE * spark.sparkContext.defaultParallelism
    stream = _stream(spark, sf_dir, rows_per_batch=in_batch)
    rows = detectors.impossible_travel(with_watermark(stream), **TRAVEL)
    # Where slices outgrow the batches, state has to be able to leave the heap, which costs several times as much a row.
    rocksdb = not _slices_fit(read_events(spark, sf_dir), TRAVEL["within_seconds"], in_batch)
    return _streamed(spark, rows.select(*DETECTED), "stream_impossible_travel", rocksdb=rocksdb)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "decode_payload": decode,
    "encode_payload": encode,
    "bronze_landing": bronze_landing,
    "gold_1m": gold_1m,
    "gold_1h": gold_1h,
    "gold_1d": gold_1d,
    "stream_gold_1m": stream_gold_1m,
    "replayed_gold_1m": replayed_gold_1m,
    "stream_late_rows": stream_late_rows,
    "late_rows_corrected": late_rows_corrected,
    "stream_accounts": stream_accounts,
    "gold_1h_rolled": gold_1h_rolled,
    "gold_1d_rolled": gold_1d_rolled,
    "gold_1h_refreshed": gold_1h_refreshed,
    "gold_1m_doubles": gold_1m_doubles,
    "gold_union": gold_union,
    "gold_snapshot": gold_snapshot,
    "gold_export_refreshed": gold_export_refreshed,
    "kpi_summary": kpi_summary,
    "kpi_display": kpi_display,
    "throughput_series": throughput_series,
    "fraud_by_type": fraud_by_type,
    "recent_windows": recent_windows,
    "recent_display": recent_display,
    "window_alerts": window_alerts,
    "category_norms": category_norms,
    "category_quantiles": category_quantiles,
    "detect_high_amount": detect_high_amount,
    "detect_high_amount_in_force": detect_high_amount_in_force,
    "high_amount_thresholds": high_amount_thresholds,
    "detect_card_testing": detect_card_testing,
    "stream_probe_sessions": stream_probe_sessions,
    "stream_card_testing": stream_card_testing,
    "detect_impossible_travel": detect_impossible_travel,
    "stream_impossible_travel": stream_impossible_travel,
    "stream_high_amount": stream_high_amount,
    "card_home_city": card_home_city,
    "card_home_city_of_many": card_home_city_of_many,
    "detector_confusion": detector_confusion,
}
