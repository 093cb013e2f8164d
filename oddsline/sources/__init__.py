"""Scans, sinks, manifest, JDBC and the adapter views over landed tables."""
