"""Readers: canonical tables, ingestion with quarantine, versioned tables."""
