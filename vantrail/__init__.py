"""Telemetry analytics on PySpark: ingest, dedupe, state, rollups, lake, streams."""
