"""DuckDB queries that the Spark results are compared with."""
