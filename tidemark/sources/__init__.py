"""Readers and writers: test-data views, CSV and JSON records."""
