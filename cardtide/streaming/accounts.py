"""What each batch of a stream took in and gave out, as a table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardtide.functions.codec import is_rejected

#: One row per batch.
ACCOUNTS = (
    "query string, run_id string, batch_id long, rows_in long, rejected long, windows_out long, rows_out long, "
    "state_rows long, state_bytes long, watermark timestamp, batch_ms long"
)

_IN, _OUT = "rows_in", "windows_out"


def counting_in(transactions: DataFrame) -> DataFrame:
    """The rows of a stream as they are, counted on their way: all, and those that can belong to no window."""
    return transactions.observe(_IN, F.count(F.lit(1)).alias("rows"), F.count_if(is_rejected()).alias("rejected"))


def counting_out(gold: DataFrame) -> DataFrame:
    """Closed windows as they are, counted with the transactions in them."""
    return gold.observe(_OUT, F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("tx_count"), F.lit(0)).alias("rows"))


def accounts(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The batches that a query still reports, oldest first, as rows of ``ACCOUNTS``.

    The observations are made in the batches themselves, so they cost no second pass. Rows that came in, were not
    rejected and are in no window that went out are late, or in windows still open. A query reports its last
    ``spark.sql.streaming.numRecentProgressUpdates`` batches: append this table somewhere at least that often, and
    keep one row per ``run_id`` and ``batch_id`` on reading. A batch without data counts too (a watermark that moves
    closes windows); the observations of a batch that was repeated are those of its last run.
    """
    rows = []
    for progress in query.recentProgress:
        told = json.loads(progress.json)
        seen = told.get("observedMetrics") or {}
        into, out = seen.get(_IN) or {}, seen.get(_OUT) or {}
        state = told.get("stateOperators") or []
        rows.append(
            (
                told.get("name"), told["runId"], told["batchId"],
                into.get("rows", 0), into.get("rejected", 0), out.get("windows", 0), out.get("rows", 0),
                sum(s.get("numRowsTotal", 0) for s in state), sum(s.get("memoryUsedBytes", 0) for s in state),
                (told.get("eventTime") or {}).get("watermark"), (told.get("durationMs") or {}).get("triggerExecution"),
            )
        )
    last = {(row[1], row[2]): row for row in rows if row[3] or row[5] or row[6]} if rows else {}
    schema = ACCOUNTS.replace("watermark timestamp", "watermark string")
    return spark.createDataFrame([last[key] for key in sorted(last)], schema).withColumn("watermark", F.try_to_timestamp("watermark"))
