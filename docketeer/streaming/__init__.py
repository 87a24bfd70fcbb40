"""The enrichment as an incremental file stream."""
