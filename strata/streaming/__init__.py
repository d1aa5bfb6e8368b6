"""Structured Streaming entry points.

The reference model is batch-only (a daily refresh of CSV drops into bronze
tables).  The one streaming piece here is that same bronze ingest run
incrementally: a file-source stream with ``availableNow`` processes only files
not yet seen (tracked in the checkpoint) and appends them exactly once.
"""

from .ingest import ingest_incremental  # noqa: F401
