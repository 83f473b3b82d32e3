"""Readers: driver tables, inputs derived from them, text files and streams."""

from rillet.sources.tables import read_table
from rillet.sources.derived import echo_rows, game_lines, person_lines, text_lines, document_texts
from rillet.sources.text import read_lines, stage_lines, stream_lines

__all__ = ["read_table", "echo_rows", "game_lines", "person_lines", "text_lines",
           "document_texts", "read_lines", "stage_lines", "stream_lines"]
