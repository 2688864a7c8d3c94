"""The engine's operators over the driver's test tables, with a DuckDB twin of each query."""
