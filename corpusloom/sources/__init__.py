"""Readers, connectors to the manifest schema, bounded scans and tar shards."""
