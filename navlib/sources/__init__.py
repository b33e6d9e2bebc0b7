"""Sources and sinks: feed text, Parquet tables, and test views over the driver tables."""
