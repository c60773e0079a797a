"""Sources and sinks: raw CSV ingest, Parquet tables, driver test tables."""
