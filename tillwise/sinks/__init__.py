"""Writers: versioned parquet tables and JDBC."""
