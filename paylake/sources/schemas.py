"""Declared schemas for every layer.

Bronze is all strings (CSV read with a header, no inference).  Silver is the
typed form.  Ids are widened to bigint: an int id overflows past 2^31 rows,
which a payments table reaches long before 100 TB.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Silver column types, in table order (DDL type names).
CUSTOMER_TYPES = [
    ("CUSTOMER_ID", "bigint"),
    ("x_customer_id", "double"),
    ("y_customer_id", "double"),
    ("mean_amount", "double"),
    ("std_amount", "double"),
    ("mean_nb_tx_per_day", "double"),
    ("available_terminals", "array<bigint>"),
    ("nb_terminals", "int"),
]

TERMINAL_TYPES = [
    ("TERMINAL_ID", "bigint"),
    ("x_terminal_id", "double"),
    ("y_terminal_id", "double"),
]

TRANSACTION_TYPES = [
    ("TRANSACTION_ID", "bigint"),
    ("TX_DATETIME", "timestamp_ntz"),
    ("CUSTOMER_ID", "bigint"),
    ("TERMINAL_ID", "bigint"),
    ("TX_AMOUNT", "double"),
    ("TX_TIME_SECONDS", "int"),
    ("TX_TIME_DAYS", "int"),
    ("TX_FRAUD", "int"),
    ("TX_FRAUD_SCENARIO", "int"),
]

# Timestamp text format of the raw and bronze layers.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

LAYOUTS = {
    "customers": CUSTOMER_TYPES,
    "terminals": TERMINAL_TYPES,
    "transactions": TRANSACTION_TYPES,
}


def string_schema(columns: list[tuple[str, str]]) -> T.StructType:
    """The bronze (raw text) schema: same names, every column a string."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c, _ in columns])
