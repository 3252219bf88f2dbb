"""File-at-a-time ingest as a stream."""
