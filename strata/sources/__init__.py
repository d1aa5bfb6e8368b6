"""Sources and sinks: driver tables, derived test inputs, CSV ingest, catalog tables."""
