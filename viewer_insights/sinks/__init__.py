"""Writers: Parquet stage outputs, CSV exports, JDBC serving table, schema contract."""
