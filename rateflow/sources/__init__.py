"""Scans and sinks: landed payloads, observation files, catalog tables."""
