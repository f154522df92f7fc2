"""Structured Streaming twins of the daily load."""
