"""Schemas and fixed values. Nothing here is ever inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# ---- Fixed values: they must equal those of the pipeline being replaced ----

TOPIC = "transactions"

PAYLOAD = (
    StructType()
    .add("transaction_id", StringType())
    .add("card_id", StringType())
    .add("amount", DoubleType())
    .add("merchant", StringType())
    .add("category", StringType())
    .add("city", StringType())
    .add("timestamp", StringType())
    .add("is_fraud", BooleanType())
    .add("fraud_type", StringType())
)

GOLD = (
    StructType()
    .add("window_start", TimestampType())
    .add("window_end", TimestampType())
    .add("tx_count", LongType())
    .add("total_amount", DoubleType())
    .add("avg_amount", DoubleType())
    .add("fraud_high_amount", LongType())
    .add("fraud_card_testing", LongType())
    .add("fraud_impossible_travel", LongType())
    .add("fraud_total", LongType())
)

FRAUD_TYPES = ("high_amount", "card_testing", "impossible_travel")

CATEGORIES = (
    "groceries", "restaurant", "electronics", "fashion",
    "travel", "fuel", "pharmacy", "entertainment",
)

CITIES = (
    "Sao Paulo", "Rio de Janeiro", "Belo Horizonte", "Curitiba", "Porto Alegre",
    "Salvador", "Recife", "Fortaleza", "Brasilia", "Manaus",
)

WINDOW = "1 minute"
WATERMARK = "2 minutes"
RED_AT = 40
AMBER_AT = 20
RECENT_WINDOWS = 12

# Headings of the latest-windows table, in display order.
RECENT_HEADINGS = {
    "window_start": "Window",
    "tx_count": "Tx",
    "total_amount": "Total $",
    "avg_amount": "Avg $",
    "fraud_card_testing": "Card testing",
    "fraud_high_amount": "High amount",
    "fraud_impossible_travel": "Impossible travel",
    "fraud_total": "Frauds",
}

# Order of the stacked series.
STACKED = ("card_testing", "high_amount", "impossible_travel")

# Names of the running queries, and of the folders below the data folder.
BRONZE_QUERY = "bronze_raw"
GOLD_QUERY = "gold_windows"
CONSOLE_QUERY = "gold_console"
BRONZE_DIR = "bronze"
GOLD_DIR = "gold"
CHECKPOINTS_DIR = "_checkpoints"
SAMPLE_DIR = "gold_sample"

# ---- End of fixed values ----

# Statistics of windows by date, and the corrections to them.
WINDOWS_QUERY = "window_statistics"
WINDOWS_DIR = "windows"
CORRECTIONS_DIR = "corrections"

# Bronze keeps the payload as sent and adds the parsed instant.
BRONZE = StructType([*PAYLOAD.fields]).add("event_time", TimestampType())

# What a keyed event log delivers, as far as it is used here.
KEYED_EVENT = StructType().add("key", BinaryType()).add("value", BinaryType())

EVENTS_TABLE = (
    StructType()
    .add("event_id", LongType())
    .add("ts", TimestampNTZType())
    .add("user_id", LongType())
    .add("event_type", StringType())
    .add("value", DoubleType())
    .add("props", StringType())
)
