"""Sources and sinks: folder discovery, Parquet footers, ingest, sanitising
rewrite, result sinks."""
