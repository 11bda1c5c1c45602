"""Structured Streaming forms of the batch ingest.

The reference has no streaming operators; this package only re-expresses its
"process new input, skip unchanged input" step as a file stream whose
checkpoint remembers which files were already ingested.
"""
