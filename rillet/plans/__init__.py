"""Whole jobs (one function per reference pipeline) and the keyed query registry."""
