"""Incremental loading of raw order files into bronze (Structured Streaming).

The warehouse itself is batch: it has no windows, watermarks or state.  Its
first step -- raw order file(s) appended to the bronze table with a load
timestamp -- is the one step that naturally runs as new files arrive, so it
is offered here as a streaming job over a landing folder: the same header
normalisation and per-row candidate mapping as the batch loader
(``sources.csv_ingest``), one ``ingestion_time`` per micro-batch, appended to
the bronze Parquet table exactly once per file (file-source checkpoint).
"""

from kpiforge.streaming.bronze_stream import bronze_stream, start_bronze_ingest  # noqa: F401
