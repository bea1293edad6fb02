"""Table sources and sinks: parquet/table/JDBC loading with schema contracts,
the ACA-shaped stand-ins derived from the test tables, and the partitioned sink."""
