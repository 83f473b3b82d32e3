"""Sinks: text files (sharded, per window), appended tables, stream topics."""

from rillet.sinks.table import append_table, select_fields, stream_append
from rillet.sinks.text import write_per_window, write_text, write_windowed_text

__all__ = ["append_table", "select_fields", "stream_append", "write_per_window", "write_text",
           "write_windowed_text"]
