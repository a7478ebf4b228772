"""Structured Streaming twins of the daily tables and the lag features."""
