"""The whole stream job: Bronze and Gold as independent queries over one event log."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from cardtide.functions.codec import decode_payload
from cardtide.operators.gold import GOLD_INPUT, windowed_gold, with_watermark
from cardtide.operators.statistics import CENTS, window_statistics
from cardtide.schema import BRONZE_DIR, CHECKPOINTS_DIR, GOLD_DIR, WATERMARK, WINDOW, WINDOWS_DIR, WINDOWS_QUERY
from cardtide.session import configure
from cardtide.sources.dated import DATE, with_date
from cardtide.sources.transactions import FolderSource, KafkaSource, read_transactions
from cardtide.streaming.sinks import append_to_table, start_bronze, start_console, start_gold


def run_pipeline(
    spark: SparkSession,
    source: KafkaSource | FolderSource,
    data_dir: str,
    *,
    window: str = WINDOW,
    delay: str = WATERMARK,
    state_partitions: int | None = 4,
    console: bool = False,
    available_now: bool = False,
    minor_units: int | None = None,
    bronze_by_date: bool = False,
    windows_by_date: bool = False,
    rocksdb: bool = False,
) -> list[StreamingQuery]:
    """Start the queries and return them; ``spark.streams.awaitAnyTermination()`` waits for the first end.

    ``windows_by_date`` lands the additive statistics of the windows too, by date: what ``reconcile`` and ``roll_up``
    work on.

    Bronze and Gold have their own checkpoints, so each recovers on its own. Gold state is one row per open window,
    which is why few state partitions do; size them once, before the first start.
    """
    configure(spark)
    events = read_transactions(spark, source)
    timed = with_watermark(decode_payload(events, GOLD_INPUT), delay)
    gold = windowed_gold(timed, window, minor_units=minor_units)
    root = data_dir.rstrip("/")
    queries = [
        start_bronze(
            decode_payload(events),
            f"{root}/{BRONZE_DIR}",
            f"{root}/{CHECKPOINTS_DIR}/bronze",
            available_now=available_now,
            by_date=bronze_by_date,
        ),
        start_gold(
            gold,
            f"{root}/{GOLD_DIR}",
            f"{root}/{CHECKPOINTS_DIR}/gold",
            available_now=available_now,
            state_partitions=state_partitions,
            rocksdb=rocksdb,
        ),
    ]
    if windows_by_date:
        queries.append(
            append_to_table(
                with_date(window_statistics(timed, window, minor_units or CENTS)),
                f"{root}/{WINDOWS_DIR}",
                f"{root}/{CHECKPOINTS_DIR}/{WINDOWS_DIR}",
                WINDOWS_QUERY,
                available_now=available_now,
                state_partitions=state_partitions,
                rocksdb=rocksdb,
                partition_by=DATE,
            )
        )
    if console:
        queries.append(
            start_console(gold, available_now=available_now, state_partitions=state_partitions)
        )
    return queries
