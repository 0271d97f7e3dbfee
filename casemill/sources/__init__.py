"""Tables and streams in."""

from casemill.sources.streams import kafka_options, stream_source
from casemill.sources.tables import read_if_present, read_pages, read_table, rows_table, spread

__all__ = [
    "kafka_options",
    "read_if_present",
    "read_pages",
    "read_table",
    "rows_table",
    "spread",
    "stream_source",
]
