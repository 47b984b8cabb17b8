"""Keyed JSON events to typed transactions, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardtide.schema import PAYLOAD


def decode_payload(events: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """``value`` (bytes or text) -> the payload fields and ``event_time``.

    A malformed object becomes a row of NULLs and a malformed field a NULL, never an error.
    ``try_to_timestamp`` matters: under ANSI, the plain cast would stop a stream on bad text.

    The object is unpacked by a generator because filters are not pushed below one. Below a plain
    projection, the filter on ``event_time`` that every window adds would parse each object a
    second time. ``fields`` limits what is unpacked; ``timestamp`` must be among them.
    """
    wanted = StructType([f for f in PAYLOAD if fields is None or f.name in fields])
    payload = F.from_json(F.col("value").cast("string"), wanted)
    unpacked = events.select(F.inline(F.array(payload)))
    return unpacked.withColumn("event_time", F.try_to_timestamp("timestamp"))


def is_rejected() -> Column:
    return F.col("event_time").isNull()


def rejected(transactions: DataFrame) -> DataFrame:
    """Rows that Bronze keeps but that can belong to no window."""
    return transactions.where(is_rejected())


def iso_text(instant: str | Column) -> Column:
    """ISO-8601 text with offset; the fraction is left out when it is zero."""
    column = F.col(instant) if isinstance(instant, str) else instant
    whole = F.date_trunc("second", column) == column
    return F.when(whole, F.date_format(column, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def encode_payload(transactions: DataFrame) -> DataFrame:
    """Transactions -> ``key`` and ``value`` bytes, the shape a keyed event log takes.

    The card is the key, so one card stays in one log partition and keeps its order. A text
    ``timestamp`` that the rows carry is sent as it is, readable or not; only rows without one get theirs
    from ``event_time``. NULL fields are written as JSON nulls.
    """
    sent = F.lit(None).cast("string")
    if "timestamp" in transactions.columns:
        sent = F.col("timestamp")
    made = iso_text(F.col("event_time").cast("timestamp"))
    fields = [
        F.coalesce(sent, made).alias(name) if name == "timestamp" else F.col(name) for name in PAYLOAD.fieldNames()
    ]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return transactions.select(
        F.col("card_id").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
    )
