"""Readers and writers around Spark's own data sources."""
