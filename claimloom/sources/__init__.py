"""Scans and sinks: driver tables, HTTP snapshots, release catalogs, documents, artifacts."""
