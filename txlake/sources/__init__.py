"""Sources and sinks: CSV export, Parquet raw zone and lake tables, JDBC,
stream sources, and the raw inputs derived from the driver tables."""

from txlake.sources.files import (
    malformed_rows,
    materialize,
    read_raw_csv,
    read_raw_zone,
    read_table,
    write_csv,
    write_raw_zone,
    write_table,
)
from txlake.sources.fixtures import event_messages, event_payloads, raw_transactions, raw_transactions_dirty, table
from txlake.sources.jdbc import read_jdbc, write_jdbc
from txlake.sources.streams import kafka_stream, text_stream

__all__ = [
    "event_messages",
    "event_payloads",
    "kafka_stream",
    "malformed_rows",
    "materialize",
    "raw_transactions",
    "raw_transactions_dirty",
    "read_jdbc",
    "read_raw_csv",
    "read_raw_zone",
    "read_table",
    "table",
    "text_stream",
    "write_csv",
    "write_jdbc",
    "write_raw_zone",
    "write_table",
]
