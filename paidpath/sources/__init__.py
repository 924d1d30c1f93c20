"""Scans (parquet tables), role bindings over the test tables, and sinks."""
