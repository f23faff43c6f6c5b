"""Writers: partitioned Parquet, CSV/JSON, JDBC, and the folder load ledger."""
