"""Sources and sinks: typed CSV, Parquet staging, JDBC, driver-table adapters."""
