"""Canonical view of an ``events`` table as card transactions."""

from __future__ import annotations

import time as clock
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardtide.schema import CATEGORIES, CITIES, EVENTS_TABLE

_LABELLED = {"error": "high_amount", "signup": "card_testing", "purchase": "impossible_travel"}


def _nth(names: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def as_transactions(events: DataFrame) -> DataFrame:
    """Events -> transactions, by built-in expressions only, so a scan reads just what is used."""
    # props is always the flat object {"k": n}: a pattern finds n several times faster than a JSON
    # parser. It is read once, in its own projection; everything else is derived from it.
    digits = F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1)
    keyed = events.withColumn("k", digits.try_cast("int"))
    user, k, event_type = F.col("user_id"), F.col("k"), F.col("event_type")
    user_text = user.cast("string")
    label = F.lit(None).cast("string")
    for source, name in _LABELLED.items():
        label = F.when(event_type == source, F.lit(name)).otherwise(label)
    labelled = keyed.withColumn("fraud_type", F.when(k < 10, label))
    return labelled.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        # Pad to four digits but never cut: two users must not become one card.
        F.concat(
            F.lit("card_"), F.lpad(user_text, F.greatest(F.lit(4), F.length(user_text)), F.lit("0"))
        ).alias("card_id"),
        F.col("value").alias("amount"),
        F.concat(F.lit("merchant_"), k.cast("string")).alias("merchant"),
        _nth(CATEGORIES, k % len(CATEGORIES)).alias("category"),
        _nth(CITIES, (user + F.when(k < 15, k).otherwise(0)) % len(CITIES)).alias("city"),
        F.col("fraud_type").isNotNull().alias("is_fraud"),
        "fraud_type",
        F.col("ts").alias("event_time"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_TABLE).parquet(f"{sf_dir}/events.parquet")


def stage_batches(
    events: DataFrame,
    folder: str,
    *,
    time: str = "ts",
    batches: int | None = None,
    files: int | None = None,
    late: Column | None = None,
    then: Callable[[DataFrame], DataFrame] | None = None,
    rows_per_batch: int = 2_000_000,
    rows_per_file: int = 10_000,
) -> int:
    """Lay a table out as a stream's backlog in files that follow time, written once; returns files per batch.

    A file stream takes files by age and a watermark moves between batches only, so a backlog has to be read in
    batches that follow time: else all of it is one batch, and all its windows and rows are state at once. Every file
    is a stretch of time of its own and is dated by it, so files may be taken in any number at a time. By default
    there are 4 batches, and more from ``rows_per_batch`` rows each on, so the state of a batch does not grow with the
    table; and a batch has as many files as the session has cores, fewer where they would hold less than
    ``rows_per_file`` rows. All rows go out, those without a time in the first stretch; rows where ``late`` is true
    make one more batch at the end. ``then`` is applied to rows on their way into the files. The folder has to be on a
    file system that keeps modification times.
    """
    spark = events.sparkSession
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    first, last, n = events.agg(F.min(micros), F.max(micros), F.count(F.lit(1))).first()
    first, last = (0, 0) if first is None else (first, last)
    batches = batches or max(4, -(-n // rows_per_batch))
    files = files or max(1, min(spark.sparkContext.defaultParallelism, n // batches // rows_per_file))
    stretches = batches * files
    number = F.least(F.floor((micros - first) * F.lit(stretches).cast("decimal(20,0)") / max(last - first, 1)), F.lit(stretches - 1))
    number = F.coalesce(number, F.lit(0)).cast("int")
    backlog, dated = f"{folder}/backlog", []
    for part, place, parts in [
        (events if late is None else events.where(~F.coalesce(late, F.lit(False))), number, stretches),
        *([] if late is None else [(events.where(late), F.pmod(F.xxhash64(time), F.lit(files)).cast("int"), files)]),
    ]:
        placed = part.withColumn("_stretch", place).repartitionById(parts, "_stretch").drop("_stretch")
        (placed if then is None else then(placed)).write.mode("append").parquet(backlog)
        dated += sorted(set(_data_files(spark, backlog)) - set(dated))
    _date_files(spark, backlog, dated)
    return files


def _folder(spark: SparkSession, path: str):
    """A folder's file system and path, by which files are listed and dated; their content is never touched here."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _data_files(spark: SparkSession, path: str) -> list[str]:
    system, folder = _folder(spark, path)
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return [name for name in names if name.startswith("part-")]


def _date_files(spark: SparkSession, path: str, names: list[str]) -> None:
    """Give the files ages in the order of their names here, a second apart, the last one dated now."""
    system, folder = _folder(spark, path)
    newest = int(clock.time() * 1000)
    for i, name in enumerate(reversed(names)):
        system.setTimes(spark._jvm.org.apache.hadoop.fs.Path(folder, name), newest - 1000 * i, -1)


def stream_batches(spark: SparkSession, folder: str, files: int) -> DataFrame:
    """What ``stage_batches`` has laid out, a batch of files at a time."""
    reader = spark.readStream.schema(EVENTS_TABLE).option("maxFilesPerTrigger", files)
    # Only TIMESTAMP columns can carry a watermark.
    return reader.parquet(f"{folder}/backlog").withColumn("ts", F.col("ts").cast("timestamp"))


def stream_events(spark: SparkSession, sf_dir: str, max_bytes: int | None = None) -> DataFrame:
    """The same table as a stream, whether it is one file or a folder of part files.

    ``max_bytes`` limits one micro-batch. Files are taken by age, so set it only where that is the
    order of their events too; otherwise later files may count as late.
    """
    reader = spark.readStream.schema(EVENTS_TABLE)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    table = f"{sf_dir}/events.parquet"
    file = read_events(spark, sf_dir).select("_metadata.file_path").first()
    if file is not None and file[0].endswith("/events.parquet"):
        # A file stream watches folders, so a single file is picked out of its parent.
        events = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    else:
        events = reader.parquet(table)
    # Only TIMESTAMP columns can carry a watermark.
    return events.withColumn("ts", F.col("ts").cast("timestamp"))
