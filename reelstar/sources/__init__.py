"""Scans and sinks: bronze JSON, silver Parquet, the published tables and the sample bindings."""
