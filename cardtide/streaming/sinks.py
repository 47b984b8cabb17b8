"""Landing streams in tables, publishing them, and consolidating Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from cardtide.functions.codec import encode_payload
from cardtide.operators.snapshot import one_per_window
from cardtide.schema import BRONZE_QUERY, CONSOLE_QUERY, GOLD, GOLD_QUERY, TOPIC
from cardtide.session import settings
from cardtide.sources.dated import DATE, dates_of, drop_dates, landed, read_dates, write_by_date
from cardtide.sources.gold import scan_gold

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _started(
    spark: SparkSession,
    writer: DataStreamWriter,
    available_now: bool,
    state_partitions: int | None,
    rocksdb: bool,
) -> StreamingQuery:
    """Start with the state settings a query keeps for life (they go into its checkpoint)."""
    # Sessions of one key are merged within each task before they are shuffled.
    values = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}
    if state_partitions is not None:
        values["spark.sql.shuffle.partitions"] = str(state_partitions)
    if rocksdb:
        values["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        # Write the changes of a batch, not a copy of the whole state.
        values["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
        # One store for a join and partition, not four.
        values["spark.sql.streaming.join.stateFormatVersion"] = "3"
    if available_now:
        writer = writer.trigger(availableNow=True)
    with settings(spark, values):
        return writer.start()


def append_to_table(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    *,
    available_now: bool = False,
    state_partitions: int | None = None,
    rocksdb: bool = False,
    partition_by: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once.

    ``checkpoint`` and ``path`` belong together: a new checkpoint on an old table would number its
    batches from 0 again, and the sink leaves out batch numbers it has already committed.
    ``state_partitions`` is fixed at the first start; None takes the session's shuffle partitions.
    """
    writer = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .queryName(name)
    )
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    return _started(rows.sparkSession, writer, available_now, state_partitions, rocksdb)


def start_bronze(
    transactions: DataFrame,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    by_date: bool = False,
) -> StreamingQuery:
    """Land each decoded event, rejected ones included.

    ``by_date`` adds a partition column ``event_date``, so that later reads of a period prune.
    """
    if by_date:
        transactions = transactions.withColumn("event_date", F.to_date("event_time"))
    return append_to_table(
        transactions,
        path,
        checkpoint,
        BRONZE_QUERY,
        available_now=available_now,
        partition_by="event_date" if by_date else None,
    )


def start_gold(
    gold: DataFrame,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    state_partitions: int | None = None,
    rocksdb: bool = False,
) -> StreamingQuery:
    """Append each window once, when the watermark has passed its end."""
    return append_to_table(
        gold,
        path,
        checkpoint,
        GOLD_QUERY,
        available_now=available_now,
        state_partitions=state_partitions,
        rocksdb=rocksdb,
    )


def start_console(
    gold: DataFrame, *, available_now: bool = False, state_partitions: int | None = None
) -> StreamingQuery:
    """Echo closed windows, untruncated. Without a checkpoint it replays from the start each time."""
    writer = (
        gold.writeStream.format("console")
        .option("truncate", "false")
        .outputMode("append")
        .queryName(CONSOLE_QUERY)
    )
    return _started(gold.sparkSession, writer, available_now, state_partitions, False)


def finish(*queries: StreamingQuery) -> None:
    """Wait for bounded queries; an error in any of them is raised here."""
    for query in queries:
        query.awaitTermination()


def publish(transactions: DataFrame, bootstrap_servers: str, topic: str = TOPIC) -> None:
    """Write a table of transactions to a topic, keyed by card; needs Spark's Kafka connector."""
    (
        encode_payload(transactions)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )


def export_snapshot(
    spark: SparkSession, gold_dir: str, out_dir: str, *, files: int | None = None
) -> dict[str, int]:
    """Consolidate Gold into compact sorted Parquet; returns ``windows`` and ``bytes``.

    An empty Gold or an unreadable file is an error here. The files are ranges of windows in order: one file for as
    long as adaptive execution holds that one task can take it all
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), then more. ``files`` asks for a number instead; 1 makes one
    task sort and write all of Gold.
    """
    gold = scan_gold(spark, gold_dir)
    if gold is None:
        raise ValueError(f"no Gold data files in {gold_dir}: run the stream first")
    written = Observation()
    ranged = one_per_window(gold).repartitionByRange(*([] if files is None else [files]), "window_start")
    # Counted behind the exchange, whose input is also sampled for its ranges.
    ranged = ranged.observe(written, F.count(F.lit(1)).alias("windows"))
    ranged.sortWithinPartitions("window_start").write.mode("overwrite").parquet(out_dir)
    # Only the listing is read here, never the content of the files.
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(out_dir)
    return {"windows": written.get["windows"], "bytes": listing.agg(F.sum("length")).first()[0]}


def export_changed(spark: SparkSession, gold_dir: str, out_dir: str) -> list[str]:
    """Bring a snapshot laid out by date up to date with a Gold folder laid out by date; returns the dates rewritten.

    Which dates have changed is told by the listing of Gold alone: the names, sizes and times of a date's files,
    against what the last export has noted of them. Only changed dates are read, consolidated and written, in the
    place of what the snapshot held of them; dates that Gold lost are emptied. What was seen is noted last, so an
    export that failed does its dates again. The first export writes all. An empty Gold is an error, as is an
    unreadable file of a date that is read.
    """
    if not dates_of(spark, gold_dir):
        raise ValueError(f"no Gold data files in {gold_dir}: run the stream first")
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(gold_dir)
    file = F.concat_ws("|", F.element_at(F.split("path", "/"), -1), "length", F.unix_micros("modificationTime"))
    dated = listing.select(F.regexp_extract("path", f"/{DATE}=([^/]+)/", 1).alias("date"), F.xxhash64(file).cast("decimal(38,0)").alias("mark"))
    # The sum does not depend on the order of files.
    marks = [F.count(F.lit(1)).alias("files"), F.sum("mark").cast("string").alias("mark")]
    seen = landed(dated.where("date <> ''").groupBy("date").agg(*marks), "listing")
    notes = f"{out_dir}{_NOTES}"
    before = spark.createDataFrame([], seen.schema)
    if dates_of(spark, out_dir):
        before = spark.read.schema(seen.schema).parquet(notes)
    same = seen.join(before.withColumnsRenamed({"files": "_files", "mark": "_mark"}), "date", "full")
    changed = same.where(~(F.col("files").eqNullSafe(F.col("_files")) & F.col("mark").eqNullSafe(F.col("_mark"))))
    # One value per date at most.
    dates = sorted(r[0] for r in changed.select("date").collect())
    if dates:
        write_by_date(one_per_window(read_dates(spark, gold_dir, GOLD, dates)), out_dir, replace=True)
        gone = sorted(set(dates) - set(dates_of(spark, gold_dir)))
        drop_dates(spark, out_dir, gone)
        landed(seen, "noted").write.mode("overwrite").parquet(notes)
    return dates


#: Beside the snapshot, what its last export saw.
_NOTES = "_exported"
