"""Structured Streaming forms of the jobs (file streams stand in for topics)."""
