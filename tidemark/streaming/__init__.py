"""Structured Streaming versions of the bar, SMA, run and record operators."""
