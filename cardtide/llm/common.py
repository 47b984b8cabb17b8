"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardtide.session import scratch_dir

#: Hidden columns of the operators start with this, so that they clash with no column of the caller.
HIDDEN = "__cardtide_"


def prepared(spark: SparkSession) -> SparkSession:
    """Set what the queries of this package rely on: Arrow batches small enough for whole texts.

    The default of 10,000 rows would hold that many texts several times over, in the JVM and in each Python worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def landed(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: cuts the lineage and fixes row numbers."""
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def not_held_out(doc_id: Column) -> Column:
    """Rows that models may learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 != 2, F.lit(True))


def hashed_sample(rows: DataFrame, order: Column, salt: str, n: int) -> DataFrame:
    """At most ``n`` rows, those with the least hashes of ``order``: the same rows on every run.

    Rows are counted first, so that each task only gives those below a hash that about 2 n rows are below of, and what reaches the
    driver does not grow with the number of tasks. Null keys have hashes too; rows of equal hash are taken as they come.
    """
    total = rows.count()
    place = F.pmod(F.xxhash64(order, F.lit(salt)), F.lit(1 << 40))
    below = int(min(1.0, (2 * n + 100) / max(total, 1)) * (1 << 40))
    return rows.withColumn(f"{HIDDEN}place", place).where(F.col(f"{HIDDEN}place") < below).orderBy(f"{HIDDEN}place").limit(n)


def packed_text(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column one after another, and n + 1 offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, body = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of a partition again, in order, in batches of about ``limit`` bytes of text and at least one row."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        _, offsets = packed_text(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            room = max(0, limit - size)
            end = int(np.searchsorted(offsets, offsets[begin] + room, "right")) - 1
            end = min(max(end, begin + (not held)), batch.num_rows)
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                size += int(offsets[end] - offsets[begin])
                begin = end
            if begin < batch.num_rows or size >= limit:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def laid_out(docs: DataFrame, text_col: str, shard_bytes: int, level: int) -> DataFrame:
    """Whole rows in shards: a number, bytes of text, and the rows as one compressed Arrow stream (``row_table`` reads it)."""

    def layer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        codec = pa.Codec("zstd", compression_level=level)
        for number, batch in enumerate(pieces(batches, text_col, shard_bytes)):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as out:
                out.write_batch(batch)
            size = int(packed_text(batch.column(text_col))[1][-1])
            payload = sink.getvalue().to_pybytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number]), pa.array([size]), pa.array([payload], pa.binary())],
                ["shard", "n_bytes", "payload"],
            )

    return docs.mapInArrow(releasing(layer), "shard long, n_bytes long, payload binary")


def row_table(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over a partition, and its memory given back when the partition is done."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return wrapped


def release_memory() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks, and share an executor's limit."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: nothing to call


def release_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of jobs that have ended go: they stay until the driver's JVM finds that nothing refers to them.

    What Python lets go reaches the JVM from a thread that looks for it now and then, and what the job that ended last has
    left goes only some collections after that.
    """
    gc.collect()
    gone, until = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None), time.monotonic() + 2
    while gone and time.monotonic() < until:
        time.sleep(0.05)
    for _ in range(3):
        time.sleep(0.4)
        spark.sparkContext._jvm.System.gc()


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]
